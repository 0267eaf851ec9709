import math
import random

import numpy as np
import pytest

from curbside.llm import topk


def plain(rows, k, every):
    good = [(i, [math.floor(64 * c) for c in v]) for i, v in rows
            if i is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    out, done = [], set()
    for n, (i, q) in enumerate(good):
        if i % every or (i, tuple(q)) in done:
            continue
        done.add((i, tuple(q)))
        scored = sorted((-sum(a * b for a, b in zip(q, x)), j) for m, (j, x) in enumerate(good) if m != n and len(x) == len(q))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def vectors(seed):
    rng = random.Random(seed)
    rows = [(i, [float(np.float32(rng.gauss(0, 1) * 0.5 ** (c / 3))) for c in range(8)]) for i in range(300)]
    rows += [(i, rows[5][1]) for i in range(300, 340)]
    rows += [(rows[0][0], rows[0][1]), (rows[1][0], rows[1][1]), (12, [0.0] * 8), (12, rows[3][1]), (None, rows[3][1]), (500, None),
             (520, [1.0, None]), (540, [float("nan")] * 8), (560, [float("inf")] * 8), (580, []), (600, [1.0, 2.0]), (601, [1.0, -1.0]), (-20, rows[7][1])]
    return rows


@pytest.mark.parametrize("blocks,walk", [((1 << 14, 512), 512), ((50, 7), 3)])
def test_equals_brute_force(spark, monkeypatch, blocks, walk):
    monkeypatch.setattr(topk, "WALK", walk)
    rows = vectors(1)
    found = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3))
    got = topk.nearest(found, found.filter("vec_id % 4 = 0"), 5, *blocks).collect()
    assert sorted(map(tuple, got)) == plain(rows, 5, 4)


def test_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(2)
    rows = rng.integers(-9, 10, (4000, 12)) * np.array([40, *[1] * 11])
    queries = rng.integers(-9, 10, (6, 12)) * np.array([40, *[1] * 11])
    best, scores, depth = topk.threshold_topk(rows, queries, [-1] * 6, 3)
    for i in range(6):
        want = sorted(range(4000), key=lambda r: (-int(rows[r] @ queries[i]), r))[:3]
        assert best[i].tolist() == want and scores[i].tolist() == [int(rows[r] @ queries[i]) for r in want]
    skewed = np.zeros((4000, 3), np.int64)
    skewed[:, 0] = np.arange(4000)
    assert topk.threshold_topk(skewed, np.array([[1, 0, 0]]), [-1], 3)[2] < 4000
    huge = np.array([[1 << 30, 1], [1 << 30, 2]])
    assert topk.threshold_topk(huge, huge, [-1, -1], 1)[1][0].tolist() == [(1 << 60) + 2]


def test_empty_table(spark):
    assert topk.every_nth(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
