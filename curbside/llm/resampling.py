"""Importance resampling towards a target distribution by hashed n-grams.

Features are runs of consecutive words, put into buckets by their CRC-32. What a bucket is worth is the log ratio of its
share among the target's features to its share among the documents' own; a document's weight is the mean worth of its
features, read from one array. With Gumbel noise from the document's id added, the best scores are a draw without
replacement in proportion to the weights.

The k best come from a distributed quickselect: pivots are random rows, one pass counts exactly how many rows come
before, at and after each, and only rows between the nearest pivots stay candidates, until a pivot is the k-th row itself.
Only winners are sorted, and ranked by their places in the sorted files. The composite key (score, id, number of the row)
is unique, so ties and copies of any number split like other rows.

Defined results: null texts have no words; a document without features has weight 0; repeated rows are documents of their
own (in which order they are drawn shows in no other column); documents without an id have no score and are never drawn
nor counted; empty tables are allowed on both sides. Further columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.common import discard, numbered, staged, texts

BUCKETS, LONGEST, SEED, PERCENT, LEAST_WORDS = 10_000, 1, 2024, 10, 20
PIVOTS = 16
_WORD = rb"[0-9a-z\x80-\xff]+"  # bytes: all of a character beyond ASCII belongs to its word
_FLUSH = 1 << 16


def _features(text: str, longest: int, word: re.Pattern, buckets: int) -> tuple[np.ndarray, int]:
    """Buckets of all features of a text, repeats included, and its number of words."""
    words = word.findall(text.encode("utf-8", "surrogatepass").lower())  # bytes lower A-Z alone
    runs = list(words)
    for n in range(2, longest + 1):
        runs += map(b" ".join, zip(*(words[i:] for i in range(n)), strict=False))
    return np.fromiter(map(zlib.crc32, runs), np.uint32, len(runs)) % np.uint32(buckets), len(words)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Features per bucket over all texts. Tasks sum their own; the driver gets one row a bucket."""
    pattern = _WORD

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, sums = re.compile(pattern), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in texts(batch):
                sums += np.bincount(_features(text, longest, word, buckets)[0], minlength=buckets)
        full = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(sums[full], pa.int64())], ["bucket", "n"])

    found = docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    sums = np.zeros(buckets, np.int64)
    for row in found.collect():
        sums[row["bucket"]] = row["n"]
    return sums


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    buckets, own_all, target_all = len(own), int(own.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((t + 1) * (own_all + buckets) / ((s + 1) * (target_all + buckets))))
        for s, t in zip(own.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, worth: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_features, n_words and weight: the floored mean of what a document's features are worth."""
    pattern, buckets, worth = _WORD, len(worth), worth.astype(np.int64)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word = re.compile(pattern)
        for batch in batches:
            features, words, weights = [], [], []
            for text in texts(batch):
                own, n = _features(text, longest, word, buckets)
                features.append(len(own))
                words.append(n)
                weights.append(int(worth[own].sum()) // len(own) if len(own) else 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in (features, words, weights))],
                ["doc_id", "n_features", "n_words", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        weigh, "doc_id long, n_features long, n_words long, weight long")


def noise(seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a hash of the document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))


def _key(row: dict | None = None) -> Column:
    """Composite key in the order of the draw: the greatest score, then the smallest id, then the row's number."""
    names = ("score", "doc_id", "row")
    values = [F.col(n) if row is None else F.lit(row[n]).cast("long") for n in names]
    return F.struct((-values[0]).alias("down"), values[1].alias("doc_id"), values[2].alias("row"))


def kth(rows: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[dict, int]:
    """The k-th row (from 1, k within the table) by composite key, and the passes it took.

    A pass counts rows before every pivot and at it; ``pivots`` rows reach the driver, whatever the table's size.
    """
    between, before, passes = rows, 0, 0
    while True:
        passes += 1
        drawn = between.select("score", "doc_id", "row").orderBy(F.xxhash64("row", F.lit(passes)), "row").limit(pivots).collect()
        order = sorted((r.asDict() for r in drawn), key=lambda r: (-r["score"], r["doc_id"], r["row"]))
        sides = between.agg(*[F.count_if(_key() < _key(p)).alias(f"b{i}") for i, p in enumerate(order)],
                            *[F.count_if(_key() == _key(p)).alias(f"e{i}") for i, p in enumerate(order)]).first()
        low = high = None
        for i, p in enumerate(order):
            less, equal = before + sides[f"b{i}"], sides[f"e{i}"]
            if less < k <= less + equal:
                return p, passes
            if less + equal < k:
                low = (p, less + equal)
            elif high is None:
                high = p
        if low:
            between, before = between.filter(_key() > _key(low[0])).filter(F.col("score") <= low[0]["score"]), low[1]
        if high:
            between = between.filter(_key() < _key(high)).filter(F.col("score") >= high["score"])


def resampled(docs: DataFrame, target: DataFrame, *, buckets: int = BUCKETS, longest: int = LONGEST, seed: int = SEED,
              percent: int = PERCENT, least_words: int = LEAST_WORDS, pivots: int = PIVOTS) -> DataFrame:
    """Every document's doc_id, n_features, weight, score and rank in the draw (null if not drawn)."""
    worth = gains(bucket_counts(docs, buckets, longest), bucket_counts(target, buckets, longest))
    scored = weighted(docs, worth, longest).withColumn("score", F.col("weight") + noise(seed))
    # The number that tells equal rows apart is written down, so every later read sees the same one.
    rows, path = staged(scored.withColumn("row", F.monotonically_increasing_id()), "resampling-scores")
    fit = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    kept = ["doc_id", "n_features", "weight", "score"]
    k = rows.filter(fit).count() * percent // 100
    if not k:
        return rows.select(*kept, F.lit(None).cast("long").alias("rank"))
    last, _ = kth(rows.filter(fit), k, pivots)
    won = F.coalesce(fit & (_key() <= _key(last)), F.lit(False))
    winners, _ = numbered(rows.filter(won), [F.col("score").desc(), F.col("doc_id"), F.col("row")], "resampling-winners")
    return winners.select(*kept, (F.col("position") + 1).alias("rank")).unionByName(
        rows.filter(~won).select(*kept, F.lit(None).cast("long").alias("rank")))


def oracle_sql(buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> str:
    """The same in DuckDB for features of one word; CRC-32 by its table, which follows from the polynomial."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    step = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""
        WITH own AS (SELECT row_number() OVER () AS row, doc_id, {words} AS words FROM documents),
        aim AS (SELECT unnest({words}) AS word FROM benchmark),
        crc AS (SELECT list(list_reduce(range(8), lambda c, j: {step}, i) ORDER BY i) AS tab FROM (SELECT unnest(range(256))::BIGINT AS i)),
        spread AS (SELECT row, unnest(words) AS word FROM own),
        vocabulary AS (SELECT DISTINCT word, hex(encode(word)) AS x FROM (SELECT word FROM spread UNION ALL SELECT word FROM aim)),
        hashed AS (
          SELECT word, xor(list_reduce(list_transform(range(1, len(x) + 1, 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT),
                   lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295::BIGINT) % {buckets} AS bucket
          FROM vocabulary, crc),
        s AS (SELECT bucket, count(*) AS s FROM spread JOIN hashed USING (word) GROUP BY bucket),
        t AS (SELECT bucket, count(*) AS t FROM aim JOIN hashed USING (word) GROUP BY bucket),
        sums AS (SELECT (SELECT count(*) FROM spread) AS all_s, (SELECT count(*) FROM aim) AS all_t),
        gain AS (
          SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (all_s + {buckets}))::DOUBLE
                   / ((coalesce(s, 0) + 1) * (all_t + {buckets}))::DOUBLE))::BIGINT AS gain
          FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
        mean AS (SELECT row, sum(gain)::BIGINT AS g, count(*) AS n FROM spread JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY row),
        scored AS (
          SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT AS weight,
                 ('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT AS h
          FROM own LEFT JOIN mean USING (row)),
        noisy AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM scored),
        ranked AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM noisy
                   WHERE n_features >= {least_words} AND doc_id IS NOT NULL)
        SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * {percent} // 100 THEN rank END AS rank
        FROM noisy LEFT JOIN ranked USING (row)"""
