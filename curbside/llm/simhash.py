"""Near-duplicate documents by exact comparison of SimHash fingerprints in tiles.

Distinct fingerprints are put into tiles by the population counts of their four 16-bit quarters. Two fingerprints differ
in at least as many bits as the counts of their quarters differ in sum, so a pair of tiles whose counts differ by more
than the radius is skipped; all other pairs of tiles are compared whole, with numpy's exclusive-or and bit counts. Tiles
beyond ``BLOCK`` fingerprints are split, so a task's work is bounded. Of the links in a pair of tiles only as many leave
the task as keep its members connected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from curbside.llm.common import discard, map_arrow, staged, text_key, text_of
from curbside.llm.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
BLOCK = 16_384
_SLICE = 1 << 18  # hashes counted, and 16 times as many pairs compared, by one numpy call


def shingle_hashes(text: str, size: int) -> list[int]:
    """Hashes of all shingles, repeats included; a shorter text is one shingle."""
    words = text.encode().lower().split()  # both touch ASCII only
    if len(words) > size:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    else:
        shingles = [b" ".join(words)] if words else []
    digest = xxhash.xxh64_intdigest
    return [digest(s, SEED) for s in shingles]


def majority(hashes: list[list[int]]) -> np.ndarray:
    """A fingerprint per list: bits set in over half of its hashes."""
    lengths = np.array([len(x) for x in hashes], np.int64)
    counts = np.zeros((len(hashes), 64), np.int64)
    flat = np.fromiter((h for x in hashes for h in x), np.uint64, int(lengths.sum()))
    stops = np.cumsum(lengths)
    for at in range(0, len(flat), _SLICE):
        part = flat[at : at + _SLICE]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first, last = np.searchsorted(stops, [at, at + len(part) - 1], side="right")
        edges = np.maximum(stops[first : last + 1] - lengths[first : last + 1], at) - at
        full = lengths[first : last + 1] > 0
        counts[first : last + 1][full] += np.add.reduceat(bits, edges[full], axis=0, dtype=np.int64)
    ones = counts * 2 > lengths[:, None]
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text key and fingerprint (as a signed long) of every whole text; no word: zero."""

    def work(batch: pa.RecordBatch) -> dict:
        found, waiting, size = [], [], 0
        for text in batch.column("text").to_pylist():
            waiting.append(shingle_hashes(text, shingle))
            size += len(waiting[-1])
            if size >= _SLICE:
                found.append(majority(waiting))
                waiting, size = [], 0
        found.append(majority(waiting) if waiting else np.empty(0, np.uint64))
        return {c: batch.column(c) for c in ("doc_id", "k1", "k2")} | {"fp": np.concatenate(found).view(np.int64)}

    return map_arrow(docs.select("doc_id", *text_key(), text_of().alias("text")), work,
                     "doc_id long, k1 long, k2 int, fp long")


def near_tiles(radius: int) -> list[list[int]]:
    """Half of the offsets between quarters' counts that sum to the radius at most; the other half mirrors them."""
    near = [v for v in product(range(-radius, radius + 1), repeat=4) if sum(map(abs, v)) <= radius]
    return [list(v) for v in near if v >= (0, 0, 0, 0)]


class _Tile:
    """The members of one block of a tile, and which of them are connected so far."""

    def __init__(self, key: tuple) -> None:
        self.key, self.members, self.root = key, np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, members: np.ndarray) -> None:
        self.members = np.concatenate([self.members, members])
        self.root = np.arange(len(self.members))

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def links(self, visitors: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
        """Links of visitors to members: one for each that has any, and those that connect further members."""
        if not len(self.members):
            return
        step = max(1, 16 * _SLICE // len(self.members))
        for at in range(0, len(visitors), step):
            part = visitors[at : at + step]
            differ = part[:, None] ^ self.members[None, :]
            v, m = np.nonzero((np.bitwise_count(differ) <= radius) & (differ != 0))
            first = None
            for i, j in zip(v.tolist(), m.tolist(), strict=True):
                if i != first:
                    first, start = i, j
                    yield int(part[i]), int(self.members[j])
                elif (a := self._find(j)) != (b := self._find(start)):
                    self.root[a] = b
                    yield int(part[i]), int(self.members[j])


def near_pairs(distinct: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """From distinct fingerprints ``fp``: links (u, v) that connect whatever differs by the radius at most."""
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]
    tiled = distinct.select("fp", F.array(*quarters).alias("tile"))
    sizes = tiled.groupBy("tile").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    members = tiled.join(sizes, "tile").select("tile", mine.alias("a"), each.alias("b"), F.lit(0).alias("side"), "fp")
    offsets = F.explode(F.array(*[F.array(*map(F.lit, v)) for v in near_tiles(radius)])).alias("by")
    visitors = (
        tiled.select("fp", "tile", offsets)
        .select("fp", F.zip_with("tile", "by", lambda x, y: x + y).alias("tile"))
        .join(sizes, "tile")
        .select("tile", each.alias("a"), mine.alias("b"), F.lit(1).alias("side"), "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = _Tile(())
        for batch in batches:
            keys = list(zip(batch.column("code").to_pylist(), batch.column("a").to_pylist(), batch.column("b").to_pylist(),
                            batch.column("side").to_pylist(), strict=True))
            fps = batch.column("fp").to_numpy().view(np.uint64)
            found: list[tuple[int, int]] = []
            at = 0
            while at < len(keys):
                end = at + 1
                while end < len(keys) and keys[end] == keys[at]:
                    end += 1
                if keys[at][:3] != tile.key:
                    tile = _Tile(keys[at][:3])
                if keys[at][3] == 0:
                    tile.add(fps[at:end])
                else:
                    found.extend(tile.links(fps[at:end], radius))
                at = end
            if found:
                u, v = np.array(found, np.uint64).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (u, v)], names=["u", "v"])

    code = F.expr("((tile[0] * 17 + tile[1]) * 17 + tile[2]) * 17 + tile[3]").alias("code")
    return (
        members.unionByName(visitors).select(code, "a", "b", "side", "fp")
        .repartition("code", "a", "b").sortWithinPartitions("code", "a", "b", "side")
        .mapInArrow(run, "u long, v long")
    )


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, text key, fingerprint, component_id (smallest id that links reach) and root (smallest fingerprint).

    Null texts count as empty; rows without an id take part, and get the smallest id of their component if it has any.
    """
    prints, _ = staged(fingerprints(docs, shingle), "fingerprints")
    classes, classes_path = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots, roots_path = components(near_pairs(classes.select("fp"), radius))
    rooted = classes.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named, _ = staged(rooted.join(least, "root").select("fp", "root", "component_id"), "components")
    discard(docs.sparkSession, classes_path, roots_path)
    return prints.join(named, "fp")


def representatives(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component: the smallest id, then text key; of repeated rows one. Columns stay."""
    found = near_duplicates(docs, shingle, radius)
    order = F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "k1", "k2")
    chosen = found.groupBy("root").agg(F.min(order).alias("r")).select(
        F.col("r.doc_id").alias("_id"), F.col("r.k1").alias("_k1"), F.col("r.k2").alias("_k2"))
    rows = docs.select("*", *text_key(prefix="_t"))
    kept = rows.join(chosen, (rows.doc_id.eqNullSafe(chosen["_id"])) & (rows["_tk1"] == chosen["_k1"]) & (
        rows["_tk2"] == chosen["_k2"]), "left_semi")
    copies = found.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("n")).filter("n > 1").select(
        F.col("doc_id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    repeated = (kept.doc_id.eqNullSafe(copies["_id"])) & (kept["_tk1"] == copies["_k1"]) & (kept["_tk2"] == copies["_k2"])
    single = kept.join(copies, repeated, "left_anti")
    once = kept.join(copies, repeated, "left_semi").dropDuplicates(["doc_id", "_tk1", "_tk2"])
    return single.unionByName(once).select(*docs.columns)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint in hexadecimal, component_id."""
    return near_duplicates(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
