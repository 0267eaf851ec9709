import itertools
import random
import re

import numpy as np

from curbside.llm import quality_rules as qr


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = text.split("\n")
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines)),
        "n_repeat_words": len(covered),
    }


def test_counts_equal_plain_version():
    rng = random.Random(1)
    parts = ["a", "b", "é", " ", "\n", "\n\n", "\t", "\x0b", "#|", " ", "\x1c", " ", "c d e f g h", "𝒳"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(60)))
        assert qr.counts(text) == plain_counts(text)


def random_chains(rng, lengths):
    return [(rng.normal(size=(n, len(qr.FEATURES))), rng.integers(1, 50, n).astype(float)) for n in lengths]


def plain_marginals(x, weights, moves, extra=0.0):
    """Probabilities of boilerplate, and expected pairs of labels, over all labellings of one chain."""
    every = list(itertools.product((0, 1), repeat=len(x)))
    odds = np.array([np.exp(sum((x[t] @ weights + np.broadcast_to(extra, len(x))[t]) * z[t] for t in range(len(x)))
                            + sum(moves[a, b] for a, b in itertools.pairwise(z))) for z in every])
    odds /= odds.sum()
    pairs = np.zeros((2, 2))
    for z, p in zip(every, odds):
        for a, b in itertools.pairwise(z):
            pairs[a, b] += p
    return np.array([sum(p for z, p in zip(every, odds) if z[t]) for t in range(len(x))]), pairs


def test_viterbi_against_all_labellings():
    rng = np.random.default_rng(2)
    for n in range(1, 7):
        (x, _), = random_chains(rng, [n])
        weights, moves = rng.normal(size=x.shape[1]), rng.normal(size=(2, 2))
        every = itertools.product((0, 1), repeat=n)
        best = max(every, key=lambda z: sum((x[t] @ weights) * z[t] for t in range(n)) + sum(moves[a, b] for a, b in itertools.pairwise(z)))
        assert tuple(qr.viterbi(np.stack([np.zeros(n), x @ weights], axis=1), moves)) == best


def test_marginals_of_many_chains_against_all_labellings():
    rng = np.random.default_rng(3)
    parts = random_chains(rng, [1, 5, 2, 1, 6, 5])
    weights, moves = rng.normal(size=len(qr.FEATURES)), rng.normal(size=(2, 2))
    chains = qr.Chains(parts)
    one, pairs = chains.marginals(chains.scores(weights), moves)
    want = [plain_marginals(parts[i][0], weights, moves) for i in chains.order]
    for rank, (probabilities, _) in enumerate(want):
        assert np.allclose(one[chains.chain == rank], probabilities)
    assert np.allclose(pairs, sum(p for _, p in want))


def test_tilt_is_the_least_that_meets_the_bound():
    rng = np.random.default_rng(4)
    parts = random_chains(rng, [1, 4, 6, 3, 3, 2])
    weights, moves = rng.normal(size=len(qr.FEATURES)), rng.normal(size=(2, 2))
    chains = qr.Chains(parts)
    poor = np.array([True, False, True, False, True, False])
    free, _ = chains.marginals(chains.scores(weights), moves)
    one, _ = chains.constrained(weights, moves, poor, 0.9)
    for rank, i in enumerate(chains.order):
        size = parts[i][1] / parts[i][1].sum()
        own, tilted = free[chains.chain == rank], one[chains.chain == rank]
        share, before = ((1 - p) @ size if not poor[rank] else p @ size for p in (tilted, own))
        assert share >= 0.9 - 1e-9
        if before >= 0.9:
            assert np.allclose(own, tilted)
        else:
            assert share < 0.9 + 1e-3


def test_boilerplate_lines_in_good_documents_and_content_in_poor_ones(spark, sf):
    """Labels are given for documents alone; the field finds the planted lines."""
    rng = random.Random(5)
    words = "the river runs past old houses where people sold bread and cloth before any bridge stood there".split()
    prose = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(9, 30))).capitalize() + "."
    menu = lambda: " | ".join(rng.choice(words).title() for _ in range(rng.randrange(5, 9))) + " >> $$"
    train, planted = [], []
    for i in range(120):
        good = i % 2 == 0
        own, other = (prose, menu) if good else (menu, prose)
        lines = [own() for _ in range(rng.randrange(6, 14))]
        at = rng.randrange(len(lines) - 1)
        lines[at:at] = [other() for _ in range(rng.randrange(0, 3))]
        train.append((i, "\n".join(lines), int(good)))
    for i in range(60):
        lines = [(prose(), 0) for _ in range(8)]
        at = rng.randrange(9)
        lines[at:at] = [(menu(), 1), (menu(), 1)]
        planted.append((1000 + i, "\n".join(x for x, _ in lines), [y for _, y in lines]))
    weights, moves = qr.fit([(text, quality) for _, text, quality in train])
    found = [qr.line_labels(text, weights, moves)[0].tolist() for _, text, _ in planted]
    right = sum(a == b for x, (*_, y) in zip(found, planted) for a, b in zip(x, y))
    assert right >= 0.98 * sum(len(y) for *_, y in planted)

    docs = spark.createDataFrame([(i, t) for i, t, _ in train] + [(i, t) for i, t, _ in planted], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in train], "doc_id long, quality int")
    rows = {r.doc_id: r for r in qr.judged(docs, labels).collect()}
    assert all(0 < rows[i].content_share < 1 and rows[i].kept for i, *_ in planted)


def plain_features(lines):
    """The nine features of each line that has a word, by patterns."""
    out = []
    for i, line in enumerate(lines):
        words = re.findall(r"[^\x20\x09-\x0D]+", line)
        if not words:
            continue
        chars = sum(map(len, words))
        letters = max(1, len(re.findall("[A-Za-z]", line)))
        out.append((i, sum(len(w.encode()) for w in words), [
            1, len(re.findall(r"[#*$%&|<>]", line)) / chars, len(re.findall("[A-Z]", line)) / letters,
            len(re.findall(r"[!?;:_=~^/\\]", line)) / chars, len(re.findall("[0-9]", line)) / chars,
            sum(a == b for a, b in itertools.pairwise(words)) / max(1, len(words) - 1), len(words) < 3,
            min(1, 10 * (line.count("http") + line.count("www.")) / len(words)), line in lines[:i]]))
    return out


def test_whole_query_equals_a_plain_version(spark, sf):
    """Counts, features, best labelling, share and verdict, for the fitted weights; the fit has its own tests."""
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    weights, moves = qr.train(docs, labels)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = qr.judged(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = texts[r.doc_id]
        if len(text) > 5000:
            continue
        want = plain_counts(text)
        assert {k: r[k] for k in want} == want
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        steps = plain_features(text.split("\n"))
        best = [(0.0, [0]), (float(np.dot(steps[0][2], weights)), [1])] if steps else [(0.0, [])]
        for _, _, x in steps[1:]:
            own = (0.0, float(np.dot(x, weights)))
            best = [max(((s + moves[a[-1], k] + own[k], [*a, k]) for s, a in best), key=lambda c: c[0]) for k in (0, 1)]
        label = max(best, key=lambda c: c[0])[1]
        total = sum(n for _, n, _ in steps)
        share = sum(n for (_, n, _), z in zip(steps, label) if z == 0) / total if total else 0.0
        assert abs(r.content_share - share) < 1e-9
        assert r.kept == (not r.base_failed and share >= qr.MIN_SHARE)


def test_a_long_line_is_one_line():
    line = "words in one line " * 5000
    x, size = qr.steps_of(f"{line}\nshort one".encode())
    assert len(x) == 2 and size[0] == 5000 * 14


def test_labels_separate_quality(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = qr.judged(docs, labels).join(labels, "doc_id").collect()
    good = [r for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(r.kept for r in good) >= 0.97 * len(good)
    poor = [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in poor) <= 0.2 * len(poor)
    assert all(not r.kept for r in rows if r.base_failed)


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (None, "plain words " * 3 + "and a few more of them here now", 5), (3, "word " * 50, 5),
         (4, "x" * 100_000 + " " + " ".join(f"w{i}" for i in range(20)), 5), (4, "one", 5)],
        "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, 0), (1, 1), (None, 1), (9, 1)], "doc_id long, quality int")
    rows = qr.judged(docs, labels).collect()
    assert len(rows) == 6
    assert [r.kept for r in rows if r.doc_id in (1, 2, 3)] == [False] * 3
    assert [r.n_repeat_words for r in rows if r.doc_id == 3] == [50]
    assert qr.judged(docs.limit(0), labels.limit(0)).count() == 0
