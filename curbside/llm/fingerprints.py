"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

A text's words are what lies between ASCII white space, its shingles all runs of five words (fewer words: the whole
sequence). Every shingle is hashed once; the top bits of a hash name its bin, and a bin keeps its least hash. An empty bin
takes over the bin that comes first in its own pseudo-random order of all bins (optimal densification: the order depends on
the two bins alone, so documents with the same bins borrow alike). A fingerprint packs the low eight bits of every bin.
Bins of unlike documents agree by chance once in 256, which the estimate of likeness takes out again.

The edited text needs the next document's head. Ids are numbered in order without their texts; then the next document
sends as much of its head as is asked for, and both joins read the texts from the same shuffle by id and text.

Defined results: a null text is empty; a text without words has an empty fingerprint, like that of other such texts (1) and
unlike all others (0); documents without an id come last; rows with the same id and text are one document for the order,
and each row has its result; rows with the same id and other texts are documents of their own, in the order of two hashes
of the text; a single document is its own next one; an empty table gives no rows. Further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.common import discard, numbered, staged, text_key, text_of

SHINGLE, BINS, BITS = 5, 128, 8
_KEY = ["_id", "_none", "k1", "k2"]


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def shingle_hashes(text: Column, shingle: int = SHINGLE) -> Column:
    """Hashes of 63 bits of all shingles, repeats included; no words: an empty array."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    hashed = lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (shingle - 1), F.lit(1))),
        lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(w, i, F.lit(shingle))), 1))
    none = F.array().cast("array<bigint>")
    return _let(words, lambda w: F.when(F.size(w) > 0, hashed(w)).otherwise(none))


def _least(hashes: Column, bins: int) -> Column:
    """The least hash of every bin that has one, in the order of bins."""
    shift = 63 - (bins.bit_length() - 1)
    in_bin = lambda h: F.shiftright(h, shift)
    return _let(F.sort_array(hashes), lambda h: F.filter(
        h, lambda x, i: (i == 0) | (in_bin(x) != in_bin(F.get(h, F.greatest(i - 1, F.lit(0)))))))


def _filled(least: Column, bins: int, bits: int) -> Column:
    """Low bits of every bin, empty ones from the bin that is first in their order."""
    shift, low = 63 - (bins.bit_length() - 1), (1 << bits) - 1
    # What a bin has to lend: its number and its low bits, in one integer.
    entry = lambda h: F.shiftleft(F.shiftright(h, shift), bits).bitwiseOR(h.bitwiseAND(F.lit(low)))

    def borrowed(entries: Column, b: Column) -> Column:
        order = lambda e: F.xxhash64(b, F.shiftright(e, bits)).bitwiseAND(F.lit(~low))
        return F.array_min(F.transform(entries, lambda e: order(e).bitwiseOR(e.bitwiseAND(F.lit(low))))).bitwiseAND(F.lit(low))

    def fill(entries: Column) -> Column:
        full = F.transform(entries, lambda e: F.shiftright(e, bits))
        own = F.transform(entries, lambda e: e.bitwiseAND(F.lit(low)))
        every = F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))
        # Full and borrowed bins are put together and sorted by their numbers.
        lent = lambda f: F.transform(
            F.array_except(every, f), lambda b: F.shiftleft(b, bits).bitwiseOR(borrowed(entries, b)))
        return F.when(F.size(entries) == bins, own).otherwise(_let(full, lambda f: F.transform(
            F.sort_array(F.concat(entries, lent(f))), lambda e: e.bitwiseAND(F.lit(low)))))

    return _let(F.transform(least, entry), fill)


def packed(text: Column, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> Column:
    """The fingerprint as longs, the first bin in the highest bits; no words: an empty array.

    ``bins`` and ``bits`` are powers of two, and ``bins * bits`` at least 64.
    """
    per = 64 // bits
    none = F.array().cast("array<bigint>")
    pack = lambda v: F.transform(
        F.sequence(F.lit(0), F.lit(bins // per - 1)),
        lambda j: F.aggregate(F.slice(v, j * per + 1, F.lit(per)), F.lit(0).cast("long"),
                              lambda a, x: F.shiftleft(a, bits).bitwiseOR(x)))
    return _let(_least(shingle_hashes(text, shingle), bins), lambda m: F.when(
        F.size(m) > 0, _let(_filled(m, bins, bits), pack)).otherwise(none))


def written(fingerprint: Column) -> Column:
    """Lowercase hex digits of a packed fingerprint."""
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column, bins: int = BINS, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of two packed fingerprints, 0 to 1, without the agreement by chance."""
    lowest = sum(1 << i for i in range(0, 64, bits))
    lowest -= (lowest >> 63) << 64

    def differing(x: Column) -> Column:
        shift = 1
        while shift < bits:
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
            shift *= 2
        return F.bit_count(x.bitwiseAND(F.lit(lowest).cast("long")))

    unequal = F.aggregate(F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    chance = 1.0 / (1 << bits)
    estimate = F.greatest(F.lit(0.0), ((F.lit(bins) - unequal) / F.lit(float(bins)) - chance) / (1.0 - chance))
    none = (F.size(a) == 0).cast("int") + (F.size(b) == 0).cast("int")
    return F.when(none == 2, 1.0).when(none == 1, 0.0).otherwise(estimate)


def fingerprinted(docs: DataFrame, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """doc_id and the packed ``fingerprint`` of every whole text."""
    return docs.select("doc_id", packed(text_of(), shingle, bins, bits).alias("fingerprint"))


def _keyed(docs: DataFrame) -> DataFrame:
    """The text with the key of its document: id (0 where null), whether it is null, two hashes of the text."""
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_none"),
                       *text_key(), text_of().alias("text"))


def _renamed(df: DataFrame, mark: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{mark}{c}") for c in df.columns])


def compared(docs: DataFrame, shingle: int = SHINGLE, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Per row: doc_id, n_chars, packed fingerprints of the text, its edited form and the next document, edited_sha256."""
    keyed = _keyed(docs)
    once, path = staged(keyed.select(
        *_KEY, F.char_length("text").cast("long").alias("n_chars"), packed(F.col("text"), shingle, bins, bits).alias("fingerprint")),
        "fingerprints-texts")
    places, n = numbered(once.dropDuplicates(_KEY), [F.col("_none"), F.col("_id"), F.col("k1"), F.col("k2")], "fingerprints-order")
    following = _renamed(places.select(*_KEY, "fingerprint", ((F.col("position") + (n - 1)) % max(n, 1)).alias("at")), "next_")
    pairs, _ = staged(places.join(following, F.col("position") == F.col("next_at")).drop("position", "next_at"), "fingerprints-pairs")
    discard(docs.sparkSession, path)

    # Both joins on the texts' keys read the same columns, so the texts are shuffled once.
    # Asked of the next document: as many code points as the own text gives up, for every document that it follows.
    asked = pairs.select(*[F.col(f"next_{c}").alias(c) for c in _KEY], F.struct(*_KEY).alias("by"),
                         F.floor(F.col("n_chars") / 4).cast("int").alias("n"))
    heads = keyed.join(asked, _KEY).select("by.*", F.substring(F.col("text"), F.lit(1), F.col("n")).alias("head")).groupBy(
        *_KEY).agg(F.first("head").alias("head"))  # copies of a row send the same head
    given = pairs.select(*_KEY, "n_chars", "fingerprint", F.col("next_fingerprint"))
    kept = F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    edited = keyed.join(given, _KEY).join(heads, _KEY).select(
        F.when(~F.col("_none"), F.col("_id")).alias("doc_id"), "n_chars", "fingerprint", "next_fingerprint", F.concat(kept, F.col("head")).alias("edited"))
    return edited.select(
        "doc_id", "n_chars", "fingerprint", "next_fingerprint", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed(F.col("edited"), shingle, bins, bits).alias("edited_fingerprint"))


def digests(docs: DataFrame) -> DataFrame:
    """Fingerprints in hex digits, and likeness of a text to its edited form and to the next document."""
    found, _ = staged(compared(docs), "fingerprints-compared")
    own = F.col("fingerprint")
    return found.select(
        "doc_id", "n_chars", "edited_sha256", written(own).alias("fingerprint"),
        written(F.col("edited_fingerprint")).alias("edited_fingerprint"),
        likeness(own, F.col("edited_fingerprint")).alias("near_edited"), likeness(own, F.col("next_fingerprint")).alias("near_next"))
