import random
import re

import pytest
import xxhash

from curbside.llm import simhash


def plain_print(text, size=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None]
        out.append((d, f"{prints[i]:016x}", min(ids) if ids else None))
    return out


def corpus():
    rng = random.Random(5)
    words = ["Alpha", "bÉta", " ", "gamma x", "d", "e,", "F"]
    base = [" ".join(rng.choice(words) for _ in range(300)) for _ in range(6)]
    texts = [None, "", " \t\n\x0b", "one", "ONE two", "É é"]
    for b in base:
        w = b.split(" ")
        for _ in range(8):
            w = list(w)
            w[rng.randrange(len(w))] = rng.choice(words)
            texts.append(" ".join(w))
        texts.append(b)
        texts.append(b)
    return list(enumerate(texts)) + [(None, base[0]), (None, "alone in the world here"), (3, "one")]


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash.near_pairs, "__defaults__", (2, block))
    monkeypatch.setattr(simhash, "_SLICE", 64)
    rows = corpus()
    got = simhash.digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, plain_components(rows)))


def test_one_of_each_stays(spark):
    rows = corpus()
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, k1 string")
    kept = simhash.representatives(docs)
    want = {c for _, _, c in plain_components(rows) if c is not None}
    got = kept.collect()
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(want)
    assert [r.text for r in got if r.doc_id is None] == ["alone in the world here"]


def test_empty_table(spark):
    assert simhash.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
