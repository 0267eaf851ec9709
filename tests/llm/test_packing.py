import random
import zlib
from array import array

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from curbside.llm import packing

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = ["", " ", "  a", "a  b", "a b ", "a\n b", "it's we'll  x", "日本語 テキスト", "a b c", "a\x1c b", "<|endoftext|> x", "é ü\tß", "x" * 700,
       "ab" * 400 + " tail", "a   b", "1 2,3 .. !", " \n\n ", "ⅷ ½ ـ َ"]


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(JSON)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizers(plain, spark, sf):
    encoder = packing.Encoder(JSON, RANKS)
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(["a", " ", "é", "\n", "'s", "7", "ж", "，", "\t", "the"]) for _ in range(40)) for _ in range(300)]
    texts += ["".join(rng.choice(["a", " ", "the ", "<|endoftext|>", "é", "<|", "\n"]) for _ in range(20)) for _ in range(100)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in texts:
        assert encoder.encode(text) == array("I", plain(text)).tobytes(), text[:80]


def test_latin_texts_are_encoded_at_once(plain):
    rng = random.Random(4)
    parts = ["a", "the", "é", "ß", "ÿ", "'s", "7", "½", "\n", "\t", "\x1c", "\x85", "\xa0", "§§", "x" * 80, ".\n\n"]
    texts = [" ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(1 + i % 9)) for i in range(400)]
    encoder = packing.Encoder(JSON, RANKS)
    at_once = [t for t in texts if packing.plain(t)]
    texts += [" ".join(["word", "Größe.\nÉté"] * 200)]
    for text in texts:
        assert encoder.encode(text) == array("I", plain(text)).tobytes(), text[:80]
    assert 0 < len(at_once) < 400 and not encoder.spaced.known.keys() & set(texts[-1].split(" "))
    assert not any(map(packing.plain, ["日本", "a  b", " a", "a ", "a\n b", "a \xa0b", "x" * 300, "œ"]))
    assert packing.plain("") and packing.plain("x\ny z")


def test_special_strings_have_their_own_id(plain):
    assert plain("<|endoftext|>") == [50256] and packing.Encoder(JSON, RANKS).encode("<|endoftext|>") == array("I", [50256]).tobytes()


def test_places(spark, plain):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 60)) for i in range(200)] + [(7, None), (None, ""), (3, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    placed = packing.pack(docs, JSON, RANKS, length=32, open_bins=8, with_ids=True)
    got = placed.collect()
    bins = {}
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32
        bins.setdefault(r.sequence_id, []).append(r)
    for parts in bins.values():
        end = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == end
            end += p.length
        assert end <= 32
    total = sum(r.length for r in got)
    assert total == sum(len(plain(t or "")) + 1 for _, t in rows)
    assert len(bins) <= 1.1 * total / 32 + 1
    assert all(r.length == 32 for r in got if r.piece > 0)
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(placed).collect()}
    assert sum(map(len, whole.values())) == 4 * total


def test_open_bins_equal_plain_best_fit():
    rng = random.Random(3)
    bins = packing.OpenBins(50, 5)
    open_, made = {}, 0
    for _ in range(2000):
        size = rng.randrange(1, 51)
        found, offset = bins.place(size)
        fits = [f for f in open_.values() if f >= size]
        if fits:
            assert open_[found] == min(fits) and offset == 50 - min(fits)
        else:
            if len(open_) == 5:
                fullest = min(open_.values())
                closed = [b for b in open_ if open_[b] == fullest and b not in {x for l in bins.by_free for x in l}]
                del open_[closed[0]]
            assert (found, offset) == (made, 0)
            made += 1
            open_[found] = 50
        open_[found] -= size
        if not open_[found]:
            del open_[found]


def test_cuts_and_empty_table(spark):
    assert packing.cuts(5, 8) == [(0, 5)] and packing.cuts(8, 8) == [(0, 8)] and packing.cuts(17, 8) == [(0, 1), (1, 8), (9, 8)]
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), JSON, RANKS).count() == 0
