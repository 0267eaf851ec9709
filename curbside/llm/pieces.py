"""SentencePiece encoding with byte spans, and decoding.

The normaliser is our own: at every place the longest prefix in the model's compiled character map is replaced (else one
character is copied), white space is trimmed or escaped as the model says, and for every byte written the place it came
from is recorded. The library picks the pieces; their lengths in the normalised text, projected through that record, are
spans of the original bytes, and must cover the normalised text exactly.

Where no character map is set and no piece spans the start of a word, a text's pieces are those of its words, and words
are kept; any other text or model takes the general way, which gives the same.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from curbside.llm.common import text_of, texts
from curbside.llm.units import UnitCache

MARK = "▁"
_MARK = MARK.encode()


class CharacterMap:
    """The compiled character map: a double-array trie of prefixes, and their replacements."""

    def __init__(self, blob: bytes) -> None:
        self.units: tuple[int, ...] = ()
        self.texts = b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.texts = blob[4 + size :]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest mapped prefix of data[at:]."""
        if not self.units:
            return None
        found = None
        node = self._offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node] if node < len(self.units) else 0
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]


class Normalizer:
    def __init__(self, spec, suffix: bool = False) -> None:
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.trim, self.escape = spec.remove_extra_whitespaces, spec.escape_whitespaces
        self.prefix = spec.add_dummy_prefix and not suffix
        self.suffix = spec.add_dummy_prefix and suffix
        # An empty map writes every character as it is, so a run of them is one step of the record.
        self.runs = not spec.precompiled_charsmap and not self.trim

    def __call__(self, text: str) -> tuple[bytes, list[int]]:
        """Normalised bytes, and per byte (and for the end) the original byte it came from."""
        data = text.encode()
        steps: list[tuple[bytes, int, int]] = []  # what is written, from where to where
        at = 0
        while at < len(data):
            if self.runs:
                stop = data.find(b" ", at)
                stop = at + 1 if stop == at else len(data) if stop < 0 else stop
                steps.append((data[at:stop], at, stop))
                at = stop
                continue
            hit = self.map.longest(data, at)
            if hit is None:
                first = data[at]
                size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
                hit = size, data[at : at + size]
            steps.append((hit[1], at, at + hit[0]))
            at += hit[0]
        if self.trim:
            steps = self._trimmed(steps)
        if not steps:
            return b"", [len(data)]
        space = _MARK if self.escape else b" "
        out = bytearray()
        places: list[int] = []
        if self.prefix:
            out += space
            places += [steps[0][1]] * len(space)
        for written, start, stop in steps:
            copied = written == data[start:stop]  # byte by byte
            written = written.replace(b" ", space)
            out += written
            places += range(start, stop) if copied and written == data[start:stop] else [start] * len(written)
        if self.suffix:
            out += space
            places += [steps[-1][2]] * len(space)
        return bytes(out), [*places, steps[-1][2]]

    def _trimmed(self, steps: list[tuple[bytes, int, int]]) -> list[tuple[bytes, int, int]]:
        """Without spaces at the ends (and, where spaces become marks, marks at the end), and with one of each run."""
        out: list[tuple[bytes, int, int]] = []
        after_space = True
        for written, start, stop in steps:
            kept = bytearray()
            for c in written:
                if c != 0x20 or not after_space:
                    kept.append(c)
                after_space = c == 0x20
            if kept:
                out.append((bytes(kept), start, stop))
        marks = (b" ", _MARK) if self.escape else (b" ",)
        while out and out[-1][0].endswith(marks):
            written, start, stop = out.pop()
            while written.endswith(marks):
                written = written[:-1] if written.endswith(b" ") else written[: -len(_MARK)]
            if written:
                out.append((written, start, stop))
        return out


class Model:
    """A SentencePiece model: ids, byte spans and texts again."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            blob = f.read()
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(blob)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=blob)
        self.normalizer = Normalizer(proto.normalizer_spec, proto.trainer_spec.treat_whitespace_as_suffix)
        # Byte pieces stand for one byte, a piece of any other kind for its own text.
        self.sizes = np.array([1 if p.type == p.BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.byte_ids = {i for i, p in enumerate(proto.pieces) if p.type == p.BYTE}
        spec = proto.normalizer_spec
        self.by_word = bool(
            not spec.precompiled_charsmap and spec.add_dummy_prefix and spec.escape_whitespaces and self.byte_ids
            and not spec.remove_extra_whitespaces and not proto.trainer_spec.treat_whitespace_as_suffix
            and not any(MARK in p.piece.lstrip(MARK) for p in proto.pieces)
            and not any(p.type == p.USER_DEFINED for p in proto.pieces))
        self.words = UnitCache(self._of_words)
        self.edges = [np.array([i], "<u4").tobytes() if i >= 0 else b"" for i in (self.library.bos_id(), self.library.eos_id())]

    def _of_words(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids of words, and their pieces' ends projected through the record of each word's normalisation.

        Places count one space before the word.
        """
        lists = self.library.encode(words, num_threads=1)
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter((i for x in lists for i in x), np.int64, int(counts.sum()))
        ends = np.cumsum(self.sizes[ids])
        stops = np.cumsum(counts)
        before = np.concatenate([[0], ends])[stops - counts]
        records = [self.normalizer(w) for w in words]
        sizes = np.fromiter((len(normal) for normal, _ in records), np.int64, len(records))
        if (ends[stops - 1] - before != sizes).any():
            raise ValueError("pieces do not cover their normalised word")
        # The records lie one after the other, each with a place more than its word has bytes.
        places = np.fromiter((at for _, record in records for at in record), np.int64, int(sizes.sum()) + len(records))
        first = np.cumsum(sizes + 1) - sizes - 1
        # The word's mark is a space before it; what ends within the mark ends after that space.
        ends = places[ends - np.repeat(before - first, counts)] + 1
        id_bytes, end_bytes = ids.astype("<u4").tobytes(), ends.astype("<u4").tobytes()
        at = [0, *(stops * 4).tolist()]
        return [(id_bytes[a:b], end_bytes[a:b]) for a, b in zip(at, at[1:], strict=False)]

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """Ids with begin and end ids, little-endian; and where each piece between them ends in the text's bytes."""
        if not text:
            return b"".join(self.edges), np.empty(0, np.int64)
        if self.by_word and "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
            found = self.words.get(text.split(" "))
            ids = [x for x, _ in found]
            ends = np.frombuffer(b"".join([x for _, x in found]), "<u4").astype(np.int64)
            counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            last = ends[np.cumsum(counts) - 1]
            # The first word's space is the model's own and takes no byte.
            ends += np.repeat(np.cumsum(last) - last - 1, counts)
            return self.edges[0] + b"".join(ids) + self.edges[1], ends
        return self.encode_whole(text)

    def encode_whole(self, text: str) -> tuple[bytes, np.ndarray]:
        """The general way: the whole text normalised and aligned."""
        normal, places = self.normalizer(text)
        found = self.library.encode(text, return_type="proto").pieces
        ids = np.array([p.id for p in found], "<u4")
        sizes = [1 if p.id in self.byte_ids else len(p.piece.encode()) for p in found]
        ends = np.cumsum(np.array(sizes, np.int64))
        if (int(ends[-1]) if len(ends) else 0) != len(normal):
            raise ValueError("pieces do not cover the normalised text")
        return self.edges[0] + ids.tobytes() + self.edges[1], np.array(places, np.int64)[ends]

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


def encoded(docs: DataFrame, model: str, column: str = "text") -> DataFrame:
    """doc_id, ids, and start and end bytes of the pieces between the begin and end ids, of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(model)
        for batch in batches:
            found = [own.encode(t) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                pa.array([np.concatenate([[0], e[:-1]])[: len(e)].astype(np.int64) for _, e in found], pa.list_(pa.int64())),
                pa.array([e for _, e in found], pa.list_(pa.int64())),
            ], names=["doc_id", "ids", "starts", "ends"])

    return docs.select("doc_id", text_of(column).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>, starts array<long>, ends array<long>")


def decoded(ids: DataFrame, model: str) -> DataFrame:
    """doc_id and text of rows doc_id, ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(model)
        for batch in batches:
            out = [None if i is None else own.library.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, number and hash of the ids, hash of the decoded text, and hash of the spans' ends.

    Null texts count as empty. Ids and texts go no further than their task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(model)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for batch in batches:
            rows = []
            for text in texts(batch):
                ids, ends = own.encode(text)
                rows.append((len(ids) // 4, sha(ids), sha(own.decode(ids).encode()), sha(ends.astype("<u4").tobytes())))
            if rows:
                n, a, b, c = map(list, zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(c)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ends_sha256"])

    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ends_sha256 string")
