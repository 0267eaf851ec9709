import random

import numpy as np
import pytest

from curbside.llm import line_dedup as ld


def patience(a, b, i=0, j=0):
    """The textbook form, recursive."""
    out = []
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        out.append((i + head, j + head))
        head += 1
    a, b, i, j = a[head:], b[head:], i + head, j + head
    tail = []
    while a and b and a[-1] == b[-1]:
        tail.append((i + len(a) - 1, j + len(b) - 1))
        a, b = a[:-1], b[:-1]
    both = [x for x in a if a.count(x) == 1 and b.count(x) == 1]
    length = {}
    for n, x in enumerate(both):
        length[x] = 1 + max((length[y] for y in both[:n] if b.index(y) < b.index(x)), default=0)
    # Of the longest chains, the one whose every line, from the last on, comes earliest in b.
    chain = []
    for n in range(max(length.values(), default=0), 0, -1):
        ends = [x for x in both if length[x] == n and (
            not chain or (a.index(x) < a.index(chain[0]) and b.index(x) < b.index(chain[0])))]
        chain.insert(0, min(ends, key=b.index))
    if chain:
        p = q = 0
        for x in [*chain, None]:
            r, s = (len(a), len(b)) if x is None else (a.index(x), b.index(x))
            out += patience(a[p:r], b[q:s], i + p, j + q)
            if x is not None:
                out.append((i + r, j + s))
            p, q = r + 1, s + 1
    return sorted(out + tail)


def plain(rows, min_line, rare, min_block):
    docs = sorted({(d is None, d or 0, t or "") for d, t in rows})
    order = {}
    for d in docs:
        order.setdefault(tuple(d[2].split("\n")), d)
    kinds = sorted(order.values())
    result = {}
    for d in docs:
        lines = d[2].split("\n")
        first = order[tuple(lines)]
        gone = set()
        if first != d:
            if sum(map(len, lines)) >= min_block:
                gone = set(range(len(lines)))
        else:
            for line in set(lines):
                holders = [k for k in kinds if line in k[2].split("\n")]
                if len(line) >= min_line and 2 <= len(holders) <= (rare or len(kinds)) and holders[0] != d:
                    pairs = patience(holders[0][2].split("\n"), lines)
                    block = []
                    for k, (i, j) in enumerate([*pairs, (-9, -9)]):
                        if k and (i - 1, j - 1) != pairs[k - 1]:
                            if sum(len(lines[x]) for x in block) >= min_block:
                                gone |= set(block)
                            block = []
                        block.append(j)
        result[d] = (len(lines), len(gone), "\n".join(x for n, x in enumerate(lines) if n not in gone))
    return sorted((repr(d), *result[d is None, d or 0, t or ""]) for d, t in rows)


def corpus(seed):
    rng = random.Random(seed)
    pool = [w * rng.randrange(1, 5) for w in ("alpha ", "bé", "", "g", "delta-delta ", "x y z ")] + [f"line {i} of pool" for i in range(25)]
    rows = [(0, None), (1, ""), (2, "\n"), (3, "short"), (4, "short"), (5, "long enough to go\n\nb"), (6, "long enough to go\n\nb"),
            (6, "long enough to go\n\nb"), (None, "long enough to go\n\nb"), (None, "own line of it here\nlong enough to go")]
    for i in range(10, 60):
        lines = [rng.choice(pool) for _ in range(rng.randrange(1, 6))]
        at = rng.randrange(20)
        lines += pool[6 + at : 6 + at + rng.randrange(0, 6)]
        lines += [f"own {i}"] * rng.randrange(2)
        rows.append((rng.choice([i, i, 100 - i]), "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed,rare", [(1, None), (2, 3)])
def test_equals_brute_force(spark, seed, rare):
    rows = corpus(seed)
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, removed int").repartition(3)
    got = ld.deduplicated(docs, min_line=8, rare=rare, min_block=12, fan=4).collect()
    lines = {(r.doc_id, r.text is None): r for r in got}
    assert lines[0, True].removed is None
    want = plain(rows, 8, rare, 12)
    assert sorted((repr(r.doc_id), len(r.removed or []), r.text or "") for r in got) == sorted((d, n, t) for d, _, n, t in want)


def test_alignment_against_textbook():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.randrange(12) for _ in range(rng.randrange(14))]
        b = [rng.randrange(12) for _ in range(rng.randrange(14))]
        got = ld.aligned(a, b)
        assert all(a[i] == b[j] for i, j in got) and got == sorted(set(got))
        assert got == patience(a, b)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ld.digests(docs).count() == 0


def plain_runs(rows, min_block):
    """Lines of each distinct text that lie in a run of min_block characters which any earlier one holds."""
    kinds = {}
    for d in sorted({(d is None, d or 0, t or "") for d, t in rows}):
        kinds.setdefault(tuple(d[2].split("\n")), d)
    gone = {}
    for b in kinds:
        gone[b] = set()
        for a in kinds:
            for i in range(len(a)) if kinds[a] < kinds[b] else ():
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                        n += 1
                    if sum(map(len, b[j : j + n])) >= min_block:
                        gone[b] |= set(range(j, j + n))
    return {"\n".join(k): sorted(x) for k, x in gone.items()}, {"\n".join(k): d for k, d in kinds.items()}


def removed_by(spark, rows, **how):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {(r.doc_id, r.text): r.removed for r in docs.join(ld.deduplicated(docs, every=True, **how).select(
        "doc_id", "removed"), "doc_id").collect()}


@pytest.mark.parametrize("seed", [1, 2, 5])
def test_every_earlier_holder(spark, seed):
    rows = [(d if d is not None else 999, t) for d, t in corpus(seed)]
    rows = list({d: (d, t) for d, t in rows}.values())
    gone, first = plain_runs(rows, 12)
    got = removed_by(spark, rows, min_line=8, min_block=12, fan=4)
    assert len(got) == len(rows)
    for (d, t), removed in got.items():
        text = t or ""
        if first[text][1] != d:
            want = list(range(text.count("\n") + 1)) if len(text.replace("\n", "")) >= 12 else []
        else:
            want = gone[text]
        assert sorted(removed or []) == want, (d, t)


def test_block_of_a_later_but_still_earlier_document(spark):
    x, y, z = (f"{c * 30} a line that several documents hold" for c in "xyz")
    rows = [(1, f"{x}\n{y}\nown line of the first document"), (2, f"other\n{y}\n{x}\n{z}"), (3, f"more\n{y}\n{x}\nlast")]
    assert removed_by(spark, rows)[3, rows[2][1]] == [1, 2]


def test_windows_of_several_documents():
    sizes, hs = [40, 0, 5, 0, 39, 1, 3, 40], np.array([7, -1, 5, -1, 39, 1, 3, 7])
    keys, first, after = ld.windows(hs, np.array(sizes), np.array([3, 3, 8]), 40)
    got = sorted(zip(first.tolist(), after.tolist(), strict=True))
    assert len(set(keys.tolist())) == len(got) - 1  # lines 0 and 7 are equal
    assert got == [(0, 1), (0, 2), (0, 3), (3, 6), (4, 6), (4, 7), (5, 8), (6, 8), (7, 8)]


def passage(rng):
    return "\n".join(" ".join(f"w{rng.randrange(10**6)}" for _ in range(16)) for _ in range(6))


def test_passage_that_one_of_two_documents_repeats(spark):
    p = passage(random.Random(9))
    assert ld.aligned([1, 2, 3, 2, 4], [5, 2, 6]) == []
    once, twice = f"head2\n{p}\ntail2", f"head\n{p}\nmiddle\n{p}\ntail"
    assert sorted(removed_by(spark, [(1, twice), (2, once), (3, f"x{once}")])[2, once]) == list(range(1, 7))
    got = removed_by(spark, [(1, once), (2, twice)])
    assert got[1, once] is None and sorted(got[2, twice]) == [*range(1, 7), *range(8, 14)]


def test_passage_of_short_lines_only(spark):
    lines = "\n".join(f"item {i} of it" for i in range(60))
    rows = [(1, f"first\n{lines}\nend of one"), (2, f"second\n{lines}\nend of two"), (3, "item 7 of it\nitem 9 of it")]
    got = removed_by(spark, rows)
    assert got[1, rows[0][1]] is None and got[3, rows[2][1]] is None
    assert sorted(got[2, rows[1][1]]) == list(range(1, 61))


def test_nothing_goes_without_alignment(spark, monkeypatch):
    """Shared runs only say which documents are aligned: with an alignment that pairs nothing, all lines stay."""
    p = passage(random.Random(4))
    rows = [(1, f"first\n{p}\nend of one"), (2, f"second\n{p}\nend of two")]
    assert sorted(removed_by(spark, rows)[2, rows[1][1]]) == list(range(1, 7))
    monkeypatch.setattr(ld, "aligned", lambda a, b: [])
    one = [{"i": 1, "j": 3, "p": 0}]
    assert ld.common_lines([5, 6, 7], [1, 5, 6, 7], [40] * 4, 40, one) == []


def test_runs_in_another_order():
    """The order of the blocks differs, so one alignment cannot hold them all; the runs it leaves are aligned again."""
    x, y, z = [1, 2, 3, 4], [5, 6, 7], [8, 9]
    a, b = [*x, 50, *y, 51, *z], [*z, 60, *y, 61, *x]
    sizes = [20] * len(b)
    runs = [{"i": j, "j": j + 2, "p": a.index(b[j])} for j in range(len(b) - 1) if b[j] < 50 and b[j + 1] < 50]
    once = ld.common_lines(a, b, sizes, 40)
    assert 0 < len(once) < 9
    assert sorted(ld.common_lines(a, b, sizes, 40, runs)) == [0, 1, 3, 4, 5, 7, 8, 9, 10]


def test_many_moved_lines_take_few_steps():
    n = 3000
    a, b = list(range(n)), list(range(n))[::-1]
    runs = [{"i": j, "j": j + 1, "p": a[b[j]]} for j in range(n)]
    assert sorted(ld.common_lines(a, b, [40] * n, 40, runs)) == list(range(n))
