"""Clustering around centroids (k-means on integers) in DataFrame expressions.

A vector's squared distance to a centroid is zip_with and aggregate over its array and a literal one, array_min over
structs (distance, number) chooses the centroid, and a round's new centroids are plain column sums per cluster, which
partial aggregation keeps at one row a cluster and task. The driver sees one row a cluster and round, never a vector.

Components are scaled and rounded down to integers, so that sums are exact and do not depend on the order of rows.

Defined results: null vectors, vectors of another length and those with a null or non-finite component take no part; a
repeated row is a vector of its own; a null id sorts after all others when the first centroids are chosen, and equal
hashes are told apart by the vector itself (equal vectors are then the same centroid twice, of which the later one stays
empty); with fewer vectors than clusters there are fewer clusters; an empty table gives no rows. A component beyond
``LIMIT`` after scaling could overflow a 64-bit distance and is an error, not a wrong distance. Further columns of the
input are not read.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.common import discard, staged

WIDTH, SCALE, CLUSTERS, ROUNDS, SEED = 64, 64, 16, 3, 1
LIMIT = 1 << 27  # 64 squares of differences up to twice as much are below 2 ** 63


def integer_vectors(vectors: DataFrame, column: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """vec_id and ``x``, an array of longs: the vectors that take part, rounded down after scaling."""
    x = F.transform(column, lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = lambda c: F.floor(c * scale)
    checked = F.when(F.forall("x", lambda c: F.abs(c * scale) < LIMIT), F.transform("x", scaled)).otherwise(
        F.raise_error(F.lit(f"a component exceeds {LIMIT} after scaling")).cast("array<bigint>"))
    rows = vectors.select("vec_id", x.alias("x")).filter(F.size("x") == width).filter(finite)
    return rows.select("vec_id", checked.alias("x"))


def first_centroids(rows: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    """The vectors whose hashed ids are the smallest; at most ``clusters`` rows reach the driver."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.select(key.alias("key"), "x").orderBy(F.asc_nulls_last("key"), "x").limit(clusters)
    return [list(r["x"]) for r in chosen.collect()]


def nearest(centroids: list[list[int]], x: str = "x") -> Column:
    """Struct (distance, cluster) of the nearest centroid; of equally near ones the first."""
    each = (
        f"named_struct('distance', aggregate(zip_with({x}, array({', '.join(f'{c}L' for c in centroid)}), (a, b) -> (a - b) * (a - b)),"
        f" 0L, (s, d) -> s + d), 'cluster', {i})" for i, centroid in enumerate(centroids))
    return F.expr(f"array_min(array({', '.join(each)}))")


def moved(rows: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floored means of their vectors; those without vectors stay."""
    sums = [F.expr(f"sum(x[{j}])").alias(f"x{j}") for j in range(len(centroids[0]))]
    after = [list(c) for c in centroids]
    found = rows.select(nearest(centroids).alias("nearest"), "x").groupBy(F.col("nearest.cluster").alias("cluster"))
    for r in found.agg(F.count("*").alias("n"), *sums).collect():
        after[r["cluster"]] = [r[f"x{j}"] // r["n"] for j in range(len(centroids[0]))]
    return after


def clustered(vectors: DataFrame, column: str = "embedding", *, width: int = WIDTH, scale: int = SCALE, clusters: int = CLUSTERS,
              rounds: int = ROUNDS, seed: int = SEED) -> tuple[DataFrame, list[list[int]]]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids."""
    rows, path = staged(integer_vectors(vectors, column, width, scale), "centroids-vectors")
    centroids = first_centroids(rows, clusters, seed)
    if not centroids:
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    found = rows.select("vec_id", nearest(centroids).alias("nearest")).select(
        "vec_id", F.col("nearest.cluster").alias("cluster"), F.col("nearest.distance").alias("distance"))
    assigned, _ = staged(found, "centroids-assigned")
    discard(vectors.sparkSession, path)
    return assigned, centroids


def digests(vectors: DataFrame, **parameters) -> DataFrame:
    """Cluster and distance per vector, sums of distances per cluster and over all, hash of the final centroid."""
    assigned, centroids = clustered(vectors, **parameters)
    sums = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    per_cluster = [sums.get(i, 0) for i in range(len(centroids))]
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    pick = lambda values, kind: F.get(F.array(*[F.lit(v).cast(kind) for v in values]).cast(f"array<{kind}>"), F.col("cluster"))
    return assigned.select(
        "vec_id", "cluster", "distance", pick(per_cluster, "long").alias("cluster_inertia"),
        F.lit(sum(per_cluster)).cast("long").alias("inertia"), pick(hashes, "string").alias("centroid_sha256"))


def oracle_sql(width: int = WIDTH, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """The same in DuckDB, component by component."""
    steps = [f"""
        kept AS (
          SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS x
          FROM embeddings WHERE len(embedding) = {width}
            AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {width}),
        parts AS (SELECT row, unnest(range({width})) AS dim, unnest(x) AS v FROM kept),
        first AS (SELECT row, x, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id) NULLS LAST, x) - 1 AS cluster FROM kept),
        c0 AS (SELECT cluster, unnest(range({width})) AS dim, unnest(x) AS v FROM first WHERE cluster < {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS (
          SELECT row, min(struct_pack(d := distance, c := cluster)) AS m FROM (
            SELECT row, cluster, sum((p.v - c.v) * (p.v - c.v))::BIGINT AS distance FROM parts p JOIN c{i} c USING (dim) GROUP BY row, cluster)
          GROUP BY row)""")
        if i < rounds:
            steps.append(f"""
        m{i} AS (SELECT m.c AS cluster, dim, sum(v)::HUGEINT AS s, count(*) AS n FROM parts JOIN a{i} USING (row) GROUP BY m.c, dim),
        c{i + 1} AS (
          SELECT cluster, dim, CASE WHEN n IS NULL THEN v ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS v
          FROM c{i} LEFT JOIN m{i} USING (cluster, dim))""")
    return f"""
        WITH {', '.join(steps)},
        sums AS (SELECT m.c AS cluster, sum(m.d)::BIGINT AS cluster_inertia FROM a{rounds} GROUP BY m.c),
        hashes AS (SELECT cluster, sha256(string_agg(v::VARCHAR, ',' ORDER BY dim)) AS centroid_sha256 FROM c{rounds} GROUP BY cluster)
        SELECT vec_id, m.c::INTEGER AS cluster, m.d AS distance, cluster_inertia,
               (SELECT sum(m.d)::BIGINT FROM a{rounds}) AS inertia, centroid_sha256
        FROM a{rounds} JOIN kept USING (row) JOIN sums ON sums.cluster = m.c JOIN hashes ON hashes.cluster = m.c"""
