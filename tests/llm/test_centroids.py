import hashlib
import math
import random

import duckdb
import pyarrow as pa
import pytest

from curbside.llm import centroids as ce


def plain(rows, clusters=ce.CLUSTERS, rounds=ce.ROUNDS):
    kept = [(i, [math.floor(64 * c) for c in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(c is not None and math.isfinite(c) for c in v)]
    key = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    cents = [v for _, v in sorted(kept, key=key)[:clusters]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(cents))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cents = [[sum(x) // len(groups[i]) for x in zip(*groups[i], strict=True)] if i in groups else c for i, c in enumerate(cents)]
    found = [(i, *near(v)) for i, v in kept]
    sums = {}
    for _, d, c in found:
        sums[c] = sums.get(c, 0) + d
    return sorted(((i, c, d, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, cents[c])).encode()).hexdigest())
                   for i, d, c in found), key=repr)


def given(n=300, seed=3):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % 7, 1.0) for _ in range(64)]) for i in range(n)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [None] + [1.0] * 63, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63]
    rows += list(enumerate(bad, n))
    return [*rows, (5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (n + 9, rows[8][1]), (n + 10, [-0.5 / 64] * 64)]


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 0) for r in rows], "vec_id long, embedding array<double>, cluster int, x int").repartition(5)


def got(df):
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


@pytest.mark.parametrize("rows", [given(), given()[:9], [(1, [0.25] * 64)] * 40, given()[300:307]])
def test_equals_plain_version(spark, rows):
    assert got(ce.digests(table(spark, rows))) == plain(rows)


def test_sql_equals_plain_version():
    con = duckdb.connect()
    own = given()
    data = pa.table({"vec_id": pa.array([r[0] for r in own], pa.int64()), "embedding": pa.array([r[1] for r in own], pa.list_(pa.float64()))})
    con.register("embeddings", data)
    cursor = con.execute(ce.oracle_sql())
    names = [d[0] for d in cursor.description]
    assert names == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(cursor.fetchall(), key=repr) == plain(own)


def test_too_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="exceeds"):
        ce.digests(table(spark, [(1, [1e30] * 64), (2, [0.0] * 64)])).collect()


def test_empty_table(spark):
    assert got(ce.digests(table(spark, []))) == []
