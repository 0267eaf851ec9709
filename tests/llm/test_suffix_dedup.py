import hashlib
import random
from collections import Counter

import pytest

from curbside.llm import suffix_dedup as sd


def brute(texts, span):
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                gone[i : i + span] = [True] * span
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    base = "".join(rng.choice("abé ") for _ in range(400))
    texts = [None, "", "ab", "x" * 90, "ab" * 60, base, base, base[:200] + "Q" + base[201:]]
    for _ in range(40):
        a = rng.randrange(350)
        own = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(60)))
        texts.append(own + base[a : a + rng.randrange(10, 50)] + "".join(rng.choice("stuvw") for _ in range(rng.randrange(40))))
    return texts


@pytest.mark.parametrize("seed,hot,piece", [(1, 4096, 1 << 20), (2, 1, 1 << 20), (3, 4096, 17)])
def test_equals_brute_force(spark, monkeypatch, seed, hot, piece):
    monkeypatch.setattr(sd, "PIECE", piece)
    texts = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    rows = sd.digests(docs, span=24, anchor=6, batches=3, hot_prefix=hot).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == brute([(t or "").encode() for t in texts], 24)


def test_kept_and_extra_columns(spark):
    docs = spark.createDataFrame(
        [(1, "p" + "0123456789" * 3, "a", 1, "z"), (1, "q" + "0123456789" * 3, None, 2, "z"), (None, None, "k", 3, None)],
        "doc_id long, text string, kept string, k1 int, spans string")
    rows = {r.k1: r for r in sd.deduplicated(docs, span=20, anchor=5, batches=2).collect()}
    assert (rows[1].kept, rows[2].kept, rows[3].kept) == (b"p", b"q", b"")
    assert rows[1].removed[0].asDict() == {"start": 1, "stop": 31}
    assert rows[1].spans == "z" and rows[3].doc_id is None and rows[3].text is None


def test_empty_table(spark):
    assert sd.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
