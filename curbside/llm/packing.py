"""Packing of tokenized documents into sequences by bounded-space online best-fit.

A task keeps a fixed number of open sequences in a bitset keyed by free space: a piece goes to the open sequence with the
least space that still fits, found by one shift; if none fits a new one is opened, and if too many are open the fullest
closes first. Pieces are dealt by a hash into groups of about ``GROUP`` pieces, and arrive in hash order, so that long
and short ones mix; each group is packed on its own.

Tokenizing: a space between two characters that are no white space always begins a token of the byte-level pattern, so a
text's ids are those of its units, and units are kept. Latin units are looked up in the same vocabulary's rank table,
which is faster than the tokenizer itself and gives the same ids; all others go through the tokenizer. A text that is all
Latin-1 goes through the rank table at once, which is faster still than its units: most units of a corpus are seen once.
"""

from __future__ import annotations

import base64
import re
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from curbside.llm.common import staged, text_key, text_of, texts
from curbside.llm.units import UnitCache

LENGTH, OPEN, GROUP, END = 2048, 1024, 500_000, 0
#: Fixed value: how the byte-level tokenizer parts a text before merging bytes.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ODD = re.compile(r" \s|\s |\A | \Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")
_LATIN_END, _LONGEST = "ɐ", 256
_SPACES = [c for c in map(chr, range(256)) if c.isspace() and c != " "]


def plain(text: str) -> bool:
    """Whether the text is all Latin-1, of single spaces between units that begin and end with other than white space.

    Its units are short, so no token of the pattern is long, and merging takes no longer than the text.
    """
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return False
    if any(c in text and (" " + c in text or c + " " in text) for c in _SPACES):
        return False
    return max(map(len, text.split(" "))) < _LONGEST


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""

    def __init__(self, tokenizer: str, ranks: str | None = None) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.whole = Tokenizer.from_file(tokenizer)
        # A unit holds no special string, so it need not be searched for one.
        self.tokenizer.encode_special_tokens = True
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.spaced = UnitCache(lambda units: [self._ids(" " + u) for u in units])

    def _ids(self, text: str) -> bytes:
        if not text:
            return b""
        if self.ranked is not None and len(text) <= _LONGEST and max(text) < _LATIN_END:
            ids = self.ranked.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):  # what surrounds such a string may depend on it
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        if self.ranked is not None and plain(text):
            return array("I", self.ranked.encode_ordinary(text)).tobytes()
        units = _CUT.split(text) if _ODD.search(text) else text.split(" ")
        return self._ids(units[0]) + b"".join(self.spaced.get(units[1:]))


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; of a longer document the first piece takes the rest."""
    first = n % length or length
    return [(0, first), *((at, length) for at in range(first, n, length))]


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """doc_id, key, piece, start, length, ids_crc32 and, if asked for, ids of each document and the end id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer, ranks)
        end = array("I", [END]).tobytes()
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("doc_id", "key", "piece", "start", "length", "ids_crc32", "ids")}
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("key").to_pylist(), texts(batch), strict=True):
                ids = encoder.encode(text) + end
                for number, (start, size) in enumerate(cuts(len(ids) // 4, length)):
                    part = ids[4 * start : 4 * (start + size)]
                    row = (doc, key, number, start, size, zlib.crc32(part), part if with_ids else None)
                    for c, v in zip(out.values(), row, strict=True):
                        c.append(v)
            if out["key"]:
                yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in types], names=[n for n, _ in types])

    types = [("doc_id", pa.int64()), ("key", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
             ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
    return docs.select("doc_id", text_key()[0].alias("key"), text_of().alias("text")).mapInArrow(
        run, "doc_id long, key long, piece int, start long, length long, ids_crc32 long, ids binary")


class OpenBins:
    """Best-fit with a bounded number of open bins."""

    def __init__(self, capacity: int, bound: int) -> None:
        self.capacity, self.bound = capacity, bound
        self.bits, self.count, self.next = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        found = self.by_free[free].pop()
        if not self.by_free[free]:
            self.bits &= ~(1 << free)
        self.count -= 1
        return found

    def place(self, size: int) -> tuple[int, int]:
        """The bin and the offset in it."""
        fits = self.bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            if self.count >= self.bound:
                self._take((self.bits & -self.bits).bit_length() - 1)
            bin_id, free = self.next, self.capacity
            self.next += 1
        left = free - size
        if left:
            self.by_free[left].append(bin_id)
            self.bits |= 1 << left
            self.count += 1
        return bin_id, self.capacity - free


def packed(parts: DataFrame, length: int = LENGTH, open_bins: int = OPEN, group: int = GROUP) -> DataFrame:
    """The pieces with sequence_id and offset. ``parts`` should be a staged table: it is counted, then read."""
    groups = -(-parts.count() // group) or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(length, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([base + b for b, _ in placed], pa.int64()), pa.array([o for _, o in placed], pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"])

    order = F.xxhash64("key", "doc_id", "piece")
    dealt = parts.withColumn("o", order).repartition(groups, "o").sortWithinPartitions("o", "doc_id", "piece").drop("o")
    schema = parts.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")).schema
    return dealt.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, length: int = LENGTH, open_bins: int = OPEN,
         with_ids: bool = False) -> DataFrame:
    """Pieces of all documents and their places. Null texts count as empty, and are the end id alone."""
    parts, _ = staged(pieces(docs, tokenizer, ranks, length, with_ids), "pieces")
    out = packed(parts, length, open_bins)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return out.select(*columns, "ids") if with_ids else out.select(*columns)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary): the token sequences themselves, from pieces that hold their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda s, x: F.concat(s, x.ids)).alias("ids"))
