"""Line dedup by pairwise alignment of overlapping documents.

* Lines are compared by 64-bit hashes of their whole text. Short lines are the frequent ones, so a line of ``min_line``
  characters or more that two documents hold counts as rare. ``rare`` may bound its holders further; there is no bound
  unless asked for, since a passage must not stay because many documents share it.
* Documents with the same sequence of lines count once here: all but the earliest are later documents of that one.
* A document is aligned with the earliest holder of each of its rare lines, so a line makes as many pairs as it has
  holders, not their square. With ``every`` the shortest runs of lines of ``min_block`` characters are what documents
  share: a long line is a run of its own, short lines count together, and a document meets the earliest holder of each run.
  Documents are ordered by doc_id (null last), then text key. The documents that are aligned with the same holder are
  dealt into ``FAN`` parts, each of which gets a copy of it.
* Patience diff aligns the two: lines that are unique in both, in their longest common order, then again between them.
  With ``every`` the two are aligned again from each shared run on that this leaves, since it is in another order or has
  no unique line; so no run of ``min_block`` characters stays that an earlier document holds.
  Maximal aligned blocks of ``min_block`` characters or more are deleted from the later document. Lines that are not
  rare go with a block like any other. Nothing but copies of whole documents goes without having been aligned.

Rows with the same doc_id and text are one document, and share its result. Null texts stay null.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.common import discard, map_arrow, staged, text_key, text_of

MIN_LINE, RARE, MIN_BLOCK = 20, None, 40
FAN = 64
_STEP = 0x9E3779B97F4A7C15  # odd, so it has an inverse for 64-bit hashes of windows
_ORDER = "o struct<z:boolean,id:bigint,k1:bigint,k2:int>"


def aligned(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Positions of equal lines that patience diff pairs, in order."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i == m or j == n:
            continue
        counts_a, counts_b = Counter(a[i:m]), Counter(b[j:n])
        place = {x: y for y, x in enumerate(b[j:n], j) if counts_b[x] == 1}
        unique = [(x, place[v]) for x, v in enumerate(a[i:m], i) if counts_a[v] == 1 and v in place]
        anchors = _longest_rising(unique)
        out.extend(anchors)
        if anchors:
            edges = [(i - 1, j - 1), *anchors, (m, n)]
            todo.extend((p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False))
    return sorted(out)


def _longest_rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, sorted by the first, in which the second rises too."""
    tops: list[int] = []
    last: list[int] = []
    before: list[int] = []
    for k, (_, y) in enumerate(pairs):
        pile = bisect_left(tops, y)
        before.append(last[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(y)
            last.append(k)
        else:
            tops[pile], last[pile] = y, k
    out, k = [], last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


def blocks(pairs: list[tuple[int, int]], sizes: list[int], min_block: int) -> list[int]:
    """Positions in the later document of aligned blocks that have ``min_block`` characters or more there."""
    out: list[int] = []
    block: list[int] = []
    end = None
    for i, j in [*pairs, (-1, -1)]:
        if (i - 1, j - 1) != end:
            if sum(sizes[x] for x in block) >= min_block:
                out.extend(block)
            block = []
        block.append(j)
        end = (i, j)
    return out


def aligned_from(a: list[int], b: list[int], p: int, i: int, n: int) -> list[tuple[int, int]]:
    """The alignment of what follows a[p] and b[i], over twice as many lines as long as all of them are equal."""
    while True:
        pairs = aligned(a[p : p + n], b[i : i + n])
        if i + n >= len(b) or p + n >= len(a) or pairs != [(x, x) for x in range(n)]:
            return [(p + x, i + y) for x, y in pairs]
        n *= 2


def common_lines(a: list[int], b: list[int], sizes: list[int], min_block: int, runs: list[dict] | None = None) -> list[int]:
    """Positions in b of aligned blocks of ``min_block`` characters or more.

    ``runs`` are lines i to j of b that are known to start at line p of a. Where the alignment of the whole documents has
    left one, since it lies in another order or none of its lines is unique, the two are aligned again from its places on.
    """
    out = blocks(aligned(a, b), sizes, min_block)
    gone = set(out)
    for run in sorted(runs or (), key=lambda x: (x["i"], x["j"])):
        i, j, p = run["i"], run["j"], run["p"]
        if not gone.issuperset(range(i, j)):
            more = blocks(aligned_from(a, b, p, i, j - i), sizes, min_block)
            out.extend(x for x in more if x not in gone)
            gone.update(more)
    return out


def windows(hs: np.ndarray, sizes: np.ndarray, ends: np.ndarray, min_block: int) -> tuple[np.ndarray, ...]:
    """Hash, first line and line after the last of the shortest windows of ``min_block`` characters or more.

    Lines of several documents in a row; ``ends`` has where each document ends. There is a window from each line on and
    one up to each line, where the document has that many characters; equal ones count once.
    """
    at = np.arange(len(hs))
    document = np.searchsorted(ends, at, "right")
    starts = np.r_[0, ends][document]
    total = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    need = max(1, min_block)
    until = np.searchsorted(total, total[:-1] + need)
    since = np.searchsorted(total, total[1:] - need, "right") - 1
    on = until <= ends[document]
    up = since >= starts
    up[up] = until[since[up]] != at[up] + 1
    first, after = np.r_[at[on], since[up]], np.r_[until[on], at[up] + 1]
    step = np.full(len(hs) + 1, _STEP, np.uint64)
    back = np.full(len(hs) + 1, pow(_STEP, -1, 1 << 64), np.uint64)
    step[0] = back[0] = 1
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(hs.astype(np.int64).view(np.uint64) * np.cumprod(step)[:-1], dtype=np.uint64)]
    return ((sums[after] - sums[first]) * np.cumprod(back)[first]).view(np.int64), first, after


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def _sequences(docs: DataFrame) -> DataFrame:
    """Per document: order o, hashes and sizes of its lines."""
    lines = F.split(text_of(), "\n", -1)
    k1, k2 = text_key()
    return (
        docs.select("doc_id", k1, k2, F.transform(lines, lambda x: F.xxhash64(x)).alias("hs"),
                    F.transform(lines, lambda x: F.char_length(x)).alias("ls"))
        .groupBy("doc_id", "k1", "k2").agg(F.first("hs").alias("hs"), F.first("ls").alias("ls"))
        .select(F.struct(F.col("doc_id").isNull().alias("z"), F.coalesce("doc_id", F.lit(0)).alias("id"), "k1", "k2").alias("o"),
                "hs", "ls")
    )


def line_pairs(kinds: DataFrame, min_line: int, rare: int | None) -> tuple[DataFrame, list[str]]:
    """(later, first): documents and the earliest holders of their rare lines; and the paths of tables it reads."""
    held = kinds.select("r", F.explode(F.array_distinct(F.expr(
        f"transform(filter(arrays_zip(hs, ls), x -> x.ls >= {int(min_line)}), x -> x.hs)"))).alias("h"))
    holders = held.groupBy("h").agg(F.min("r").alias("first"), F.count("*").alias("n")).filter("n > 1")
    if rare is not None:
        holders = holders.filter(F.col("n") <= rare)
    # A written table, so that the join is of two plain shuffles and the rows of a very common line can be split.
    holders, path = staged(holders, "line-holders")
    none = F.lit(None).cast("array<struct<i:int,j:int,p:int>>").alias("runs")
    return held.join(holders, "h").filter("r > first").select("r", "first").distinct().select("r", "first", none), [path]


def run_pairs(kinds: DataFrame, min_block: int) -> tuple[DataFrame, list[str]]:
    """(later, first, runs): documents, the earliest holders of their shortest runs of ``min_block`` characters, and which
    lines of the later one (i to j) start where (p) in the earlier one; and the paths of tables it reads."""

    def cut(batch: pa.RecordBatch) -> dict | None:
        hs, ls = batch.column("hs"), batch.column("ls")
        count = np.diff(hs.offsets.to_numpy())
        ends = np.cumsum(count)
        keys, first, after = windows(hs.flatten().to_numpy(), ls.flatten().to_numpy(), ends, min_block)
        document = np.searchsorted(ends, first, "right")
        before = (ends - count)[document]
        return {"w": keys, "r": batch.column("r").to_numpy()[document], "i": first - before, "j": after - before}

    cuts = map_arrow(kinds.select("r", "hs", "ls"), cut, "w long, r long, i int, j int")
    known, path = staged(cuts.groupBy("w").agg(F.min(F.struct("r", "i")).alias("at"), F.max("r").alias("last")).filter(
        "at.r < last").select("w", F.col("at.r").alias("first"), F.col("at.i").alias("p")), "line-windows")
    shared = cuts.join(known, "w").filter("r > first")
    return shared.groupBy("r", "first").agg(F.collect_list(F.struct("i", "j", "p")).alias("runs")), [path]


def removed_lines(docs: DataFrame, min_line: int = MIN_LINE, rare: int | None = RARE, min_block: int = MIN_BLOCK,
                  fan: int = FAN, every: bool = False) -> tuple[DataFrame, str]:
    """Per document (doc_id, k1, k2) that loses any: ``removed``, positions of lines; and the table's path."""
    sequences, sequences_path = staged(_sequences(docs), "lines")
    same = [F.xxhash64("hs").alias("s1"), F.hash("hs").alias("s2"), F.size("hs").alias("s3")]
    keyed = sequences.select("o", *same)
    first = keyed.groupBy("s1", "s2", "s3").agg(F.min("o").alias("first"), F.count("*").alias("n"))
    copies = keyed.join(first.filter("n > 1"), ["s1", "s2", "s3"]).filter("o != first").select("o", "first")
    copies, copies_path = staged(copies, "line-copies")
    # Numbers in document order; the staged table keeps them.
    kinds, kinds_path = staged(sequences.join(copies, "o", "left_anti").orderBy("o").select(
        F.monotonically_increasing_id().alias("r"), "o", "hs", "ls"), "line-kinds")

    pairs, more = run_pairs(kinds, min_block) if every else line_pairs(kinds, min_line, rare)
    near, near_path = staged(pairs.withColumn("part", F.pmod(F.xxhash64("r"), F.lit(fan)).cast("int")), "line-pairs")
    discard(docs.sparkSession, *more)
    earlier = near.select("first", "part").distinct().join(kinds.select(F.col("r").alias("first"), F.col("hs").alias("a")), "first")
    both = near.join(kinds.select("r", "o", F.col("hs").alias("b"), F.col("ls").alias("sizes")), "r").join(
        earlier, ["first", "part"])

    def align(batch: pa.RecordBatch) -> dict:
        a, b, sizes, runs = (batch.column(c).to_pylist() for c in ("a", "b", "sizes", "runs"))
        return {"o": batch.column("o"), "removed": [
            common_lines(x, y, s, min_block, r) for x, y, s, r in zip(a, b, sizes, runs, strict=True)]}

    found = map_arrow(both.select("o", "a", "b", "sizes", "runs"), align, f"{_ORDER}, removed array<int>").filter("size(removed) > 0")
    whole = sequences.join(copies, "o", "left_semi").filter(
        F.aggregate("ls", F.lit(0).cast("long"), lambda s, x: s + x) >= min_block
    ).select("o", F.sequence(F.lit(0), F.size("hs") - 1).alias("removed"))
    gone = found.unionByName(whole).groupBy("o").agg(F.array_distinct(F.flatten(F.collect_list("removed"))).alias("removed"))
    result, path = staged(gone.select(
        F.when(~F.col("o.z"), F.col("o.id")).alias("doc_id"), "o.k1", "o.k2", "removed"), "removed-lines")
    discard(docs.sparkSession, sequences_path, copies_path, kinds_path, near_path)
    return result, path


def _left(text: Column, removed: Column) -> Column:
    """The text without the removed lines."""
    return F.when(removed.isNull(), text).otherwise(_let(
        F.split(text, "\n", -1),
        lambda lines: F.array_join(F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), removed), lambda i: F.get(lines, i)), "\n")))


def deduplicated(docs: DataFrame, min_line: int = MIN_LINE, rare: int | None = RARE, min_block: int = MIN_BLOCK,
                 fan: int = FAN, every: bool = False) -> DataFrame:
    """The documents with shortened ``text`` and ``removed``, positions of deleted lines (null: none).

    Without ``every`` a document is aligned once with the earliest holder of each line. All rows and columns stay but a column ``removed``, which is replaced.
    """
    gone, _ = removed_lines(docs, min_line, rare, min_block, fan, every)
    gone = gone.select(*[F.col(c).alias(f"_g_{c}") for c in gone.columns])
    rows = docs.drop("removed").select("*", *text_key(prefix="_t_"))
    same = (rows.doc_id.eqNullSafe(gone["_g_doc_id"])) & (rows["_t_k1"] == gone["_g_k1"]) & (rows["_t_k2"] == gone["_g_k2"])
    columns = [c for c in docs.columns if c != "removed"]
    removed = F.col("_g_removed")
    return rows.join(gone, same, "left").select(
        *[_left(F.col(c), removed).alias(c) if c == "text" else F.col(c) for c in columns], removed.alias("removed"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, lines before, lines deleted, characters and hash of what is left."""
    lines = F.size(F.split(text_of(), "\n", -1))
    shorter = deduplicated(docs.select("doc_id", "text", lines.alias("n_lines")), every=True)
    return shorter.select(
        "doc_id", "n_lines", F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.char_length(text_of()).alias("kept_chars"), F.sha2(text_of().cast("binary"), 256).alias("kept_sha256"))
