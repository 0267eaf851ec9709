"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Queries and candidates are dealt into blocks of bounded size, and every block of queries meets every block of candidates.
There, each dimension's list is sorted once. A query walks every list from the end that its sign favours; candidates met
for the first time are scored in full; the values at the walk's front bound the score of any candidate not yet met. The
walk ends when that bound is below the k-th best score so far (not when equal: an unmet candidate could tie with a
smaller id). A block's k best leave it, and the best of those are the result.

Vectors are scaled, and rounded down to integers; sums are exact, in floating point where it holds them exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from curbside.llm.common import staged

K, SCALE, EVERY = 20, 64, 20
CANDIDATES, QUERIES = 16_384, 4_096  # rows of a block, about; a candidate is sent once per block of queries
WALK = 512  # queries of a block that walk the lists together; bounds the table of scores
SPLIT = 64  # the first walk goes through this part of every list, each further one four times as far


def _exact(rows: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in the smallest type whose sums of products are exact."""
    most = int(np.abs(rows).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, rows.shape[1])
    if most >= 1 << 63:
        raise OverflowError("inner products exceed 64 bits")
    kind = np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64
    return rows.astype(kind), queries.astype(kind)


def sorted_lists(rows: np.ndarray) -> np.ndarray:
    """Row numbers in ascending order of each dimension."""
    return np.argsort(rows, axis=0, kind="stable")


def threshold_topk(rows: np.ndarray, queries: np.ndarray, barred: list[int], k: int,
                   order: np.ndarray | None = None) -> tuple[list[np.ndarray], list[np.ndarray], int]:
    """Per query the k best rows (ties: the first), their scores, and the depth reached; row ``barred`` (or -1) is out.

    ``order`` has the rows' sorted lists, if they are known.
    """
    n, width = rows.shape
    m = len(queries)
    order = sorted_lists(rows) if order is None else order
    rows, queries = _exact(rows, queries)
    values = np.take_along_axis(rows, order, axis=0)
    low = np.iinfo(np.int64).min if rows.dtype == np.int64 else -np.inf
    up = [np.flatnonzero(queries[:, j] > 0) for j in range(width)]
    down = [np.flatnonzero(queries[:, j] < 0) for j in range(width)]
    seen = np.zeros((m, n), bool)
    scores = np.full((m, n), low, rows.dtype)
    active = np.ones(m, bool)
    out = np.array(barred)
    depth, ahead = 0, max(1, -(-n // SPLIT))
    while active.any() and depth < n:
        ahead = min(ahead, n)
        fresh = np.zeros((m, n), bool)
        for j in range(width):
            for walkers, part in ((up[j], order[n - ahead : n - depth, j]), (down[j], order[depth:ahead, j])):
                walkers = walkers[active[walkers]]
                if len(walkers):
                    fresh[walkers[:, None], part] = True
        if ahead == n:
            fresh[active] = True  # a query of zeros walks no list
        fresh &= ~seen
        seen |= fresh
        met, live = np.flatnonzero(fresh.any(axis=0)), np.flatnonzero(active)
        if len(met):
            block = np.ix_(live, met)
            scores[block] = np.where(fresh[block], queries[live] @ rows[met].T, scores[block])
        mine = out >= 0
        scores[np.flatnonzero(mine), out[mine]] = low
        depth, ahead = ahead, ahead * 4
        front = np.maximum(queries[live], 0) @ values[n - depth] + np.minimum(queries[live], 0) @ values[depth - 1]
        if n > k:
            kth = np.partition(scores[live], n - k, axis=1)[:, n - k]
            active[live[(kth > low) & (kth > front)]] = False
        active[seen.all(axis=1)] = False
    if n > k:
        least = np.partition(scores, n - k, axis=1)[:, n - k]
    else:
        least = np.full(m, low, rows.dtype)
    best, best_scores = [], []
    for i in range(m):
        found = np.flatnonzero((scores[i] >= least[i]) & (scores[i] > low))
        found = found[np.lexsort((found, -scores[i, found]))][:k]
        best.append(found)
        best_scores.append(scores[i, found].astype(np.int64))
    return best, best_scores, depth


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)


def integer_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, x (rounded down to longs): rows with an id, and a vector whose components are all there and finite.

    Rows that repeat another are one row with their number ``copies``.
    """
    x = F.transform(column, lambda c: c.cast("double"))
    fit = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select("vec_id", x.alias("x")).filter("vec_id is not null and x is not null and size(x) > 0").filter(F.coalesce(fit, F.lit(False)))
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("x")).groupBy("vec_id", "x").agg(
        F.count("*").alias("copies"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, candidates_block: int = CANDIDATES,
            queries_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``queries`` (vec_id, x) its k best of ``vectors`` (vec_id, x, copies).

    A query's own row (same id and vector) does not count once; repeated queries have one result. Vectors of other
    lengths than the query's are no candidates.
    """
    blocks = -(-vectors.count() // candidates_block) or 1
    query_blocks = -(-queries.count() // queries_block) or 1
    part = lambda n, seed: F.pmod(F.xxhash64("vec_id", "x", F.lit(seed)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["width", "a", "b"]
    rows = vectors.select(F.size("x").alias("width"), part(blocks, 1).alias("a"), each(query_blocks).alias("b"), "vec_id", "x", "copies")
    asked = queries.select("vec_id", "x").distinct().select(
        F.size("x").alias("width"), each(blocks).alias("a"), part(query_blocks, 2).alias("b"), "vec_id", "x",
        F.xxhash64("x").alias("q"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("query_id", "q", "vec_id", "score", "copies")}
        if left.num_rows and right.num_rows:
            left = left.sort_by([("vec_id", "ascending")])
            x, q = _matrix(left.column("x")), _matrix(right.column("x"))
            ids, copies = left.column("vec_id").to_numpy(), left.column("copies").to_numpy()
            query_ids, marks = right.column("vec_id").to_pylist(), right.column("q").to_pylist()
            own = []
            for i, vec_id in enumerate(query_ids):
                a, b = np.searchsorted(ids, [vec_id, vec_id + 1])
                own.append(next((r for r in range(a, b) if (x[r] == q[i]).all()), -1))
            barred = [r if r >= 0 and copies[r] == 1 else -1 for r in own]
            order = sorted_lists(x)
            best, scores = [], []
            for at in range(0, len(q), WALK):
                found, points, _ = threshold_topk(x, q[at : at + WALK], barred[at : at + WALK], k, order)
                best += found
                scores += points
            for i, (found, points) in enumerate(zip(best, scores, strict=True)):
                left_over = copies[found] - (found == own[i])
                out["query_id"] += [query_ids[i]] * len(found)
                out["q"] += [marks[i]] * len(found)
                out["vec_id"] += ids[found].tolist()
                out["score"] += points.tolist()
                out["copies"] += np.minimum(left_over, k).tolist()
        return pa.table(out, schema=pa.schema([(c, pa.int64()) for c in out]))

    found = rows.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        search, "query_id long, q long, vec_id long, score long, copies long")
    order = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def every_nth(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """The search with all rows whose vec_id is divisible by ``every`` as queries."""
    rows, _ = staged(integer_vectors(vectors), "vectors")
    return nearest(rows, rows.filter(F.col("vec_id") % every == 0), k)


def oracle_sql() -> str:
    return f"""
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS x FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c::DOUBLE))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % {EVERY} = 0 AND q.vec_id <> c.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}"""
