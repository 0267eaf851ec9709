"""Language identification by rank-order profiles of character n-grams.

A profile is the most frequent n-grams, of one to three letters with a mark for word ends, in order. A document's profile
is compared with each language's by out-of-place distance: the sum over its n-grams of the difference of ranks, or of the
greatest difference where the language's profile lacks it. The nearest language wins; of equals the first by name.

Languages are learned from all given documents that name one, with counts from whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from curbside.llm.common import staged

PROFILE = 300
LANGUAGES = 8000  # more learned values than there are languages are an error in the labels
UNKNOWN = "und"
_EDGE = 1  # code of a word end; a letter's is its code point plus two
_BITS = 21
_SPREAD = 32
_SUMMED = 1 << 20  # n-grams that a task counts at a time, and counts it keeps before it hands them on
_LETTERS: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "table" not in _LETTERS:
        _LETTERS["table"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTERS["table"]


def ngrams(text: str) -> np.ndarray:
    """All n-grams of a text as integers, repeats included."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    codes = np.full(len(points) + 2, _EDGE, np.int64)
    codes[1:-1] = np.where(_letters()[points], points + 2, _EDGE)
    inner = codes != _EDGE
    one = codes[inner]
    two = (codes[:-1] << _BITS | codes[1:])[inner[:-1] | inner[1:]]
    three = (codes[:-2] << 2 * _BITS | codes[1:-1] << _BITS | codes[2:])[inner[1:-1]]
    return np.concatenate([one, two, three])


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    grams = np.sort(grams)
    first = np.flatnonzero(np.r_[True, grams[1:] != grams[:-1]][: len(grams)])
    return grams[first], np.diff(np.r_[first, len(grams)])


def ranked(text: str, size: int) -> np.ndarray:
    """A text's most frequent n-grams in order; of equals the smaller first."""
    grams, counts = _counted(ngrams(text))
    return grams[np.argsort(-counts, kind="stable")[:size]]


class Profiles:
    """Language profiles as a table of ranks."""

    def __init__(self, profiles: dict[str, list[int]], size: int) -> None:
        self.size, self.names = size, sorted(profiles)
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.names)), -1, np.int64)
        for j, name in enumerate(self.names):
            self.ranks[np.searchsorted(self.grams, profiles[name]), j] = np.arange(len(profiles[name]))

    def nearest(self, text: str | None) -> tuple[str, float]:
        """The language, and how near it is: 1 for the same profile, 0 for nothing in common."""
        own = ranked(text or "", self.size)
        if not len(own) or not self.names:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        if len(self.grams):
            at[self.grams[np.minimum(at, len(self.grams) - 1)] != own] = len(self.grams)
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.names[best], 1.0 - float(apart[best]) / (self.size * len(own))


def learned(docs: DataFrame, size: int = PROFILE) -> dict[str, list[int]]:
    """Profiles of the non-null values of ``lang``; rows without text teach nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            grams, which = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
            return grams, np.bincount(which, np.concatenate([c for _, c in parts])).astype(np.int64)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                grams, counts = summed(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(counts)], names=["lang", "gram", "n"])

        waiting: dict[str, list[np.ndarray]] = {}
        size = 0

        def count() -> None:
            for lang, found in waiting.items():
                held[lang] = [summed([*held.get(lang, []), _counted(np.concatenate(found))])]
            waiting.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                waiting.setdefault(lang, []).append(ngrams(text))
                size += len(waiting[lang][-1])
                if size > _SUMMED:
                    count()
                    size = 0
                    if sum(len(p[0][0]) for p in held.values()) > _SUMMED:
                        yield from flush()
                        held.clear()
        count()
        yield from flush()

    counts = docs.filter("lang is not null and text is not null").select("lang", "text").mapInArrow(
        run, "lang string, gram long, n long")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A language's n-grams are ranked in parts first, so none is in one task with all of its n-grams.
    order = [F.desc("n"), "gram"]
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    some = total.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(_SPREAD))).withColumn(
        "r", F.row_number().over(parts)).filter(F.col("r") <= size)
    whole = Window.partitionBy("lang").orderBy(*order)
    rows, _ = staged(some.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= size).select("lang", "gram", "rank"),
                     "language-profiles")
    if rows.select("lang").distinct().count() > LANGUAGES:
        raise ValueError(f"lang has more than {LANGUAGES} values")
    out: dict[str, list[int]] = {}
    for r in rows.orderBy("lang", "rank").collect():  # PROFILE rows a language
        out.setdefault(r.lang, []).append(r.gram)
    return out


def predicted(docs: DataFrame, profiles: dict[str, list[int]], size: int = PROFILE) -> DataFrame:
    """The documents with ``lang_pred`` and ``score``; texts that are null or have no letter are unknown, score 0."""
    columns = [c for c in docs.columns if c not in ("lang_pred", "score")]
    schema = docs.select(*columns, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles, size)
        for batch in batches:
            found = [known.nearest(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array([a for a, _ in found], pa.string()),
                 pa.array([b for _, b in found], pa.float64())], names=[*columns, "lang_pred", "score"])

    return docs.select(*columns).mapInArrow(run, schema)


def _held_out() -> Column:
    """One in four documents by a checksum of the id; rows without an id are neither held out nor learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, with languages learned from the documents that are not held out."""
    profiles = learned(docs.filter(~_held_out()))
    rows = docs.select("doc_id", "text", F.coalesce(_held_out(), F.lit(False)).alias("held_out"))
    return predicted(rows, profiles).select("doc_id", "held_out", "lang_pred", "score")
