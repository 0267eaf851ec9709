import hashlib
import math
import random
import re
import zlib

import pytest

from curbside.llm import resampling as rs


def features(text, longest):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return [zlib.crc32(r.encode()) % rs.BUCKETS for r in runs], len(words)


def plain(docs, target, longest=1, percent=rs.PERCENT):
    own, aim = [features(t, longest) for _, t in docs], [features(t, longest)[0] for t in target]
    s, t = [0] * rs.BUCKETS, [0] * rs.BUCKETS
    for f, _ in own:
        for b in f:
            s[b] += 1
    for f in aim:
        for b in f:
            t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + rs.BUCKETS) / ((x + 1) * (sum(t) + rs.BUCKETS)))) for x, y in zip(s, t, strict=True)]
    out, fit = [], []
    for i, ((doc_id, _), (f, n)) in enumerate(zip(docs, own, strict=True)):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        score = None
        if doc_id is not None:
            h = int(hashlib.sha256(f"2024:{doc_id}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= rs.LEAST_WORDS:
                fit.append((-score, doc_id, i))
        out.append([doc_id, len(f), weight, score, None])
    for rank, (_, _, i) in enumerate(sorted(fit)[: len(fit) * percent // 100], 1):
        out[i][4] = rank
    return sorted(map(tuple, out), key=repr)


def given(n=400):
    rng = random.Random(9)
    vocabulary = [f"W{i}" for i in range(300)] + ["Été", "日本", "x1", "ÀB"]
    text = lambda k: rng.choice([" ", "-", "\x00", "[", "\n"]).join(rng.choices(vocabulary, k=k))
    docs = [(i, text(rng.randrange(0, 80))) for i in rng.sample(range(10**6), n)]
    docs += [(10**7, None), (10**7 + 1, ""), (10**7 + 2, text(50) * 3000)]
    return docs, [text(30) for _ in range(20)] + [None, ""]


def tables(spark, docs, target):
    return (spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, score int, row string").repartition(6),
            spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"))


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("pivots,longest,percent", [(16, 1, 10), (1, 1, 50), (3, 2, 100)])
def test_equals_plain_version(spark, pivots, longest, percent):
    docs, target = given()
    df = rs.resampled(*tables(spark, docs, target), pivots=pivots, longest=longest, percent=percent)
    assert got(df) == plain(docs, target, longest, percent)


def test_copies_and_rows_without_an_id(spark):
    docs, target = given(60)
    docs = docs + [docs[3]] * 100 + [(None, d[1]) for d in docs[:5]] + [(docs[4][0], docs[5][1])]
    df = got(rs.resampled(*tables(spark, docs, target), percent=60))
    want = plain(docs, target, percent=60)
    assert [r[:4] for r in df] == [r[:4] for r in want]
    assert sorted((r[4], r[0], r[3]) for r in df if r[4]) == sorted((r[4], r[0], r[3]) for r in want if r[4])
    assert all(r[3] is None and r[4] is None for r in df if r[0] is None)


def test_selection_narrows(spark):
    rows = spark.range(5000).selectExpr("id % 7 AS score", "id % 5 AS doc_id", "id AS row")
    order = sorted((-(i % 7), i % 5, i) for i in range(5000))
    for k in (1, 2, 1234, 4999, 5000):
        last, passes = rs.kth(rows, k)
        assert (-last["score"], last["doc_id"], last["row"]) == order[k - 1]
        assert passes < 12


def test_empty_tables(spark):
    docs, target = given(30)
    assert got(rs.resampled(*tables(spark, [], target))) == []
    assert got(rs.resampled(*tables(spark, docs, []))) == plain(docs, [])
    assert got(rs.resampled(*tables(spark, docs[:5], target))) == plain(docs[:5], target)
