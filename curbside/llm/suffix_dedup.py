"""Removal of long repeated byte strings with a logarithmic family of sampled suffix arrays.

A string of ``span`` bytes is repeated if it starts anywhere else in the corpus, the same document included.

* **Sampled suffixes.** Among the ``span - anchor + 1`` suffixes that start inside a span with at least ``anchor`` bytes
  left, the one whose first ``anchor`` bytes have the smallest fingerprint (leftmost of ties) stands for the span. The
  choice depends on the span's bytes only, so equal spans choose the same suffix, and about ``2 / (span - anchor)`` of all
  suffixes are ever chosen.
* **Runs and levels.** Documents come in batches. A batch's suffixes, sorted by the fingerprint of their first ``anchor``
  bytes, are its run. The run is merge-scanned (a sort-merge join) against every existing level; prefixes found on both
  sides, or twice in the run, are hits. Levels of equal size merge before the next run is added, so an entry is
  rewritten once per doubling.
* **Extension.** A suffix stands for a stretch of consecutive spans. Stretches that occur twice as a whole are repeated
  as a whole; where different stretches share a prefix, the spans in one stretch of each kind are compared one by one.

Order below the prefix does not matter for finding equal spans, so suffixes are ordered by fingerprints. Strings are
compared through 128 bits (prefix and stretch or span), texts through 96.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curbside.llm.common import discard, map_arrow, staged, text_key, text_of

SPAN, ANCHOR, BATCHES = 200, 32, 4
PIECE, CHUNK = 1 << 20, 1 << 21  # bytes of a long text and of a numpy pass; positions take 24 bits
# Kinds of stretches of one prefix that are compared in one task, some 10 MB; more are dealt out span by span.
HOT_PREFIX = 32_768
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}

ANCHOR_SCHEMA = "h long, g long, k1 long, k2 int, s0 int, s1 int, batch int"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2^64."""
    size = max(1 << 16, 1 << n.bit_length())
    if size not in _POWERS:
        one = np.ones(1, np.uint64)
        _POWERS[size] = tuple(
            np.cumprod(np.concatenate([one, np.full(size, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64))
        )
    return _POWERS[size]


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    """sums[j] - sums[i], times the inverse power of i, is the hash of data[i:j]."""
    table = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _powers(len(data))[0][: len(data)], out=sums[1:])
    return sums


def _hashes(sums: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    return (sums[stops] - sums[starts]) * _powers(len(sums))[1][starts]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    rest = width - step
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def stretches(pieces: list[bytes], span: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Per chosen suffix: piece, first and last span start it stands for, prefix hash, stretch hash.

    Pieces have ``span`` bytes or more.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    lengths = np.array([len(p) for p in pieces])
    stops = np.cumsum(lengths)
    sums = _prefix_sums(data)
    inverse = _powers(len(sums))[1]
    prefix = _mixed((sums[anchor:] - sums[:-anchor]) * inverse[: len(sums) - anchor])
    low = np.uint64(0xFFFFFF)
    ranked = (prefix & ~low) | np.arange(len(prefix), dtype=np.uint64)
    chosen = (_sliding_min(ranked, span - anchor + 1) & low).astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), lengths)[: len(chosen)]
    start = np.flatnonzero(np.arange(len(chosen)) + span <= stops[piece])
    chosen, piece = chosen[start], piece[start]
    new = np.flatnonzero(np.r_[True, (chosen[1:] != chosen[:-1]) | (piece[1:] != piece[:-1])])
    last = np.r_[new[1:], len(start)] - 1
    first, final, at = start[new], start[last], chosen[new]
    shape = (at - first).astype(np.uint64) * np.uint64(0x94D049BB133111EB) + (final - first).astype(np.uint64)
    whole = _mixed(_hashes(sums, first, final + span) + _mixed(shape))
    base = (stops - lengths)[piece[new]]
    return piece[new], first - base, final - base, prefix[at].view(np.int64), whole.view(np.int64)


def _cut(text: bytes, span: int) -> Iterator[tuple[int, bytes]]:
    for at in range(0, len(text) - span + 1, PIECE):
        yield at, text[at : at + PIECE + span - 1]


def suffixes(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR, batches: int = BATCHES) -> DataFrame:
    """Chosen suffixes of all texts: prefix hash h, stretch hash g, text key, span starts s0 to s1, batch."""

    def work(batch: pa.RecordBatch) -> dict | None:
        k1, k2 = (batch.column(c).to_numpy() for c in ("k1", "k2"))
        found: list[tuple] = []
        rows: list[int] = []
        offsets: list[int] = []
        pieces: list[bytes] = []
        size = 0

        def flush() -> None:
            piece, s0, s1, h, g = stretches(pieces, span, anchor)
            row, at = np.array(rows)[piece], np.array(offsets)[piece]
            found.append((h, g, k1[row], k2[row], s0 + at, s1 + at))
            for kept in (rows, offsets, pieces):
                kept.clear()

        for i, text in enumerate(batch.column("text").to_pylist()):
            for at, piece in _cut(text.encode(), span):
                rows.append(i)
                offsets.append(at)
                pieces.append(piece)
                size += len(piece)
                if size >= CHUNK:
                    flush()
                    size = 0
        if pieces:
            flush()
        if not found:
            return None
        h, g, a, b, s0, s1 = (np.concatenate(c) for c in zip(*found, strict=True))
        return {"h": h, "g": g, "k1": a, "k2": b, "s0": s0.astype(np.int32), "s1": s1.astype(np.int32),
                "batch": (a % batches).astype(np.int32)}

    return map_arrow(docs.select(*text_key(), text_of().alias("text")), work, ANCHOR_SCHEMA)


class SuffixLevels:
    """The index family: sorted runs of (prefix hash, count), of which no two have the same rank for long."""

    def __init__(self) -> None:
        self.levels: list[tuple[int, DataFrame, str]] = []

    def add(self, batch: DataFrame) -> tuple[DataFrame, str]:
        """Add a batch's suffixes; returns the prefixes that now occur twice or more because of it."""
        self._merge()
        run, path = staged(batch.groupBy("h").agg(F.count("*").alias("n")).sortWithinPartitions("h"), "run")
        hits = [run.filter("n > 1").select("h")]
        hits += [run.join(level.select("h").hint("merge"), "h").select("h") for _, level, _ in self.levels]
        found = staged(reduce(DataFrame.unionAll, hits), "hits")
        self.levels.append((0, run, path))
        return found

    def _merge(self) -> None:
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (rank, new, new_path), (_, old, old_path) = self.levels.pop(), self.levels.pop()
            merged = new.unionAll(old).groupBy("h").agg(F.sum("n").alias("n")).sortWithinPartitions("h")
            self.levels.append((rank + 1, *staged(merged, "level")))
            discard(new.sparkSession, new_path, old_path)

    def drop(self) -> None:
        for _, level, path in self.levels:
            discard(level.sparkSession, path)
        self.levels = []


def _span_hashes(bodies: list[bytes], prefix: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every span in the bodies: body, index in it, hash of the span with the body's prefix hash."""
    lengths = np.array([len(b) for b in bodies])
    counts = lengths - span + 1
    body = np.repeat(np.arange(len(bodies)), counts)
    index = np.arange(len(body)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = (np.cumsum(lengths) - lengths)[body] + index
    sums = _prefix_sums(np.frombuffer(b"".join(bodies), np.uint8))
    return body, index, _mixed(_hashes(sums, start, start + span) + _mixed(prefix.view(np.uint64))[body])


def _in_slices(bodies: list[bytes], h: np.ndarray, span: int) -> tuple[np.ndarray, ...]:
    parts, at = [], 0
    while at < len(bodies):
        end, size = at, 0
        while end < len(bodies) and (size < CHUNK or end == at):
            size += len(bodies[end])
            end += 1
        body, index, hashed = _span_hashes(bodies[at:end], h[at:end], span)
        parts.append((body + at, index, hashed))
        at = end
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _shared(table: pa.Table, span: int) -> dict:
    """Spans that two of the stretches share, as ranges of span indexes per stretch."""
    h, g, n = (table.column(c).to_numpy() for c in ("h", "g", "n"))
    body, index, hashed = _in_slices(table.column("body").to_pylist(), h, span)
    _, which, count = np.unique(hashed, return_inverse=True, return_counts=True)
    twice = np.flatnonzero((count[which] > 1) & (n[body] == 1))
    body, index = body[twice], index[twice]
    new = np.r_[True, (body[1:] != body[:-1]) | (index[1:] != index[:-1] + 1)][: len(body)]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(body)][: len(first)] - 1
    return {"h": h[body[first]], "g": g[body[first]], "lo": index[first].astype(np.int32), "hi": index[last].astype(np.int32)}


def _compare_stretches(bodies: DataFrame, span: int) -> DataFrame:
    """(h, g, lo, hi) of repeated spans within stretches that share a prefix; at most HOT_PREFIX kinds of each."""
    schema = "h long, g long, lo int, hi int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            h = table.column("h").to_numpy()
            # The last prefix may go on in the next batch.
            whole = int(np.searchsorted(h, h[-1])) if len(h) else 0
            if whole:
                yield pa.RecordBatch.from_pydict(_shared(table.slice(0, whole), span))
            rest = table.slice(whole)
        if rest is not None and rest.num_rows:
            yield pa.RecordBatch.from_pydict(_shared(rest, span))

    return bodies.repartition("h").sortWithinPartitions("h").mapInArrow(run, schema)


def _compare_spans(bodies: DataFrame, span: int) -> DataFrame:
    """The same for prefixes with any number of stretches: one row per span, dealt out by its hash."""

    def work(batch: pa.RecordBatch) -> dict:
        h, g, n = (batch.column(c).to_numpy() for c in ("h", "g", "n"))
        body, index, hashed = _in_slices(batch.column("body").to_pylist(), h, span)
        return {"h": h[body], "g": g[body], "n": n[body], "lo": index.astype(np.int32), "w": hashed.view(np.int64)}

    spans = map_arrow(bodies, work, "h long, g long, n long, lo int, w long")
    twice = spans.groupBy("h", "w").agg(F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds")
    return spans.filter("n = 1").join(twice, ["h", "w"], "left_semi").select("h", "g", "lo", F.col("lo").alias("hi"))


def repeated_spans(docs: DataFrame, span: int = SPAN, anchor: int = ANCHOR, batches: int = BATCHES,
                   hot_prefix: int = HOT_PREFIX) -> tuple[DataFrame, str]:
    """Per text key: ``spans``, byte ranges (start, stop) whose every byte lies in a repeated string.

    Returned with the path of the table, which the caller removes. Ranges may touch or overlap.
    """
    spark = docs.sparkSession
    anchors, anchors_path = staged(suffixes(docs, span, anchor, batches), "suffixes", ["batch"])
    family = SuffixLevels()
    found = [family.add(anchors.filter(F.col("batch") == b)) for b in range(batches)]
    # A written table, so that the join below is of two plain shuffles and a prefix with many places can be split.
    hits, hits_path = staged(reduce(DataFrame.unionAll, [h for h, _ in found]).distinct(), "all-hits")
    places, places_path = staged(
        anchors.drop("batch").join(hits.hint("merge"), "h", "left_semi"), "places")
    family.drop()
    discard(spark, anchors_path, hits_path, *[p for _, p in found])

    kinds, kinds_path = staged(
        places.groupBy("h", "g").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "s0", "s1")).alias("at")), "kinds")
    several = kinds.groupBy("h").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    wanted = (
        kinds.join(several, "h").select("h", "g", "n", "at.*", "kinds")
        .groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "g", "n", "s0", "s1", "kinds")).alias("wanted"))
    )
    once = docs.select(*text_key(), text_of().alias("text")).groupBy("k1", "k2").agg(F.first("text").alias("text"))

    def extract(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("h", "g", "n", "kinds", "body")}
        for text, items in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
            data = text.encode()
            for x in items:
                for c in ("h", "g", "n", "kinds"):
                    out[c].append(x[c])
                out["body"].append(data[x["s0"] : x["s1"] + span])
        return out

    bodies, bodies_path = staged(
        map_arrow(once.join(wanted, ["k1", "k2"]).select("text", "wanted"), extract,
                  "h long, g long, n long, kinds long, body binary"), "stretches")
    shared = _compare_stretches(bodies.filter(F.col("kinds") <= hot_prefix), span).unionByName(
        _compare_spans(bodies.filter(F.col("kinds") > hot_prefix), span))
    partly, partly_path = staged(shared, "shared")
    whole = places.join(kinds.filter("n > 1").select("h", "g"), ["h", "g"], "left_semi").select(
        "k1", "k2", F.col("s0").alias("start"), (F.col("s1") + span).alias("stop"))
    part = partly.join(kinds.filter("n = 1"), ["h", "g"]).select(
        "at.k1", "at.k2", (F.col("at.s0") + F.col("lo")).alias("start"), (F.col("at.s0") + F.col("hi") + span).alias("stop"))
    spans = (
        whole.unionByName(part).distinct()
        .groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    )
    result, path = staged(spans, "spans")
    discard(spark, places_path, kinds_path, bodies_path, partly_path)
    return result, path


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Sorted maximal ranges."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def kept_bytes(text: bytes, ranges: list[tuple[int, int]]) -> bytes:
    """What is left of a text without the ranges."""
    if not ranges:
        return text
    edges = [0, *[x for r in ranges for x in r], len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _with_spans(docs: DataFrame, columns: list[str], **options: int) -> DataFrame:
    spans, _ = repeated_spans(docs, **options)
    rows = docs.select(*columns, F.col("text").alias("_text"), *text_key(prefix="_"))
    return rows.join(
        spans.select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("spans").alias("_spans")),
        ["_k1", "_k2"], "left")


def deduplicated(docs: DataFrame, **options: int) -> DataFrame:
    """The documents with ``kept`` (binary, since a cut may part a character) and ``removed`` (byte ranges).

    Every copy loses a repeated string, the first one too. Null texts count as empty; all rows and other columns stay;
    columns that are called kept or removed are replaced.
    """
    columns = [c for c in docs.columns if c not in ("kept", "removed")]
    rows = _with_spans(docs, columns, **options)

    def cut(batch: pa.RecordBatch) -> dict:
        ranges = [merged(s) for s in batch.column("_spans").to_pylist()]
        data = [(t or "").encode() for t in batch.column("_text").to_pylist()]
        out = {c: batch.column(c) for c in columns}
        out["kept"] = [kept_bytes(t, r) for t, r in zip(data, ranges, strict=True)]
        out["removed"] = [[{"start": a, "stop": b} for a, b in r] for r in ranges]
        return out

    schema = rows.select(*columns, F.lit(b"").alias("kept"), F.array(F.struct(
        F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("stop"))).alias("removed")).schema
    return map_arrow(rows, cut, schema)


def digests(docs: DataFrame, **options: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the kept bytes, per row."""

    def work(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {c: [] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")}
        for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist(), strict=True):
            data, ranges = (text or "").encode(), merged(spans)
            kept = kept_bytes(data, ranges)
            out["n_bytes"].append(len(data))
            out["n_removed"].append(len(data) - len(kept))
            out["n_spans"].append(len(ranges))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        return out | {"doc_id": batch.column("doc_id")}

    return map_arrow(_with_spans(docs, ["doc_id"], **options), work,
                     "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
