import hashlib
import random
import re

import pytest
import xxhash

from curbside.llm import fingerprints as fp

SIGN = 1 << 63


def h64(*parts):
    """Chained XXH64 of strings or signed longs."""
    h = 42
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else p.to_bytes(8, "little", signed=True), h)
    return h


def plain_bins(text, bins=fp.BINS, bits=fp.BITS):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    shift, low = 63 - (bins.bit_length() - 1), (1 << bits) - 1
    least = {}
    for i in range(max(1, len(words) - 4) if words else 0):
        h = h64(*words[i : i + 5]) >> 1
        least[h >> shift] = min(h, least.get(h >> shift, h))

    def signed(x):
        return x - (1 << 64) if x >= SIGN else x

    def lender(b):
        return min(least, key=lambda j: signed(h64(b, j) & ~low | least[j] & low))

    return [least[b if b in least else lender(b)] & low for b in range(bins)] if least else []


def plain_likeness(a, b, bits=fp.BITS):
    if not a or not b:
        return float(not a and not b)
    chance = 1.0 / (1 << bits)
    return max(0.0, (sum(x == y for x, y in zip(a, b, strict=True)) / len(a) - chance) / (1.0 - chance))


def plain(docs):
    docs = sorted(docs)
    out = []
    for i, (doc_id, text) in enumerate(docs):
        following = docs[(i + 1) % len(docs)][1] or ""
        text = text or ""
        m = len(text) // 4
        edited = text[: len(text) - m] + following[:m]
        a, b, c = plain_bins(text), plain_bins(edited), plain_bins(following)
        hexed = lambda v: "".join(f"{x:02x}" for x in v)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b),
                    pytest.approx(plain_likeness(a, b)), pytest.approx(plain_likeness(a, c))))
    return out


def given():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "𝒳y", "日本", "-"]
    text = lambda n: rng.choice(["", " "]) + rng.choice([" ", "\n\t", "\x0b"]).join(rng.choices(vocabulary, k=n))
    docs = [None, "", " \n", "one", "one two three four", "a b c d e", text(40) * 400]
    docs += [text(rng.randrange(1, 700)) for _ in range(60)]
    docs += [docs[-1], docs[-1] + " x", docs[-3], "w " * 30_000, "x" * 200_000]
    ids = rng.sample(range(-1000, 1000), len(docs))
    return list(zip(ids, docs, strict=True))


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                               "near_edited", "near_next").collect()), key=repr)


def test_equals_plain_version(spark):
    docs = spark.createDataFrame(given(), "doc_id long, text string").repartition(5)
    assert rows(fp.digests(docs)) == sorted(plain(given()), key=lambda r: repr(r[:1]))


def test_estimate_is_near_the_similarity(spark):
    rng = random.Random(6)
    errors = []
    for share in (0.1, 0.5, 0.8, 0.95):
        for _ in range(10):
            a = [f"w{rng.randrange(10**6)}" for _ in range(500)]
            b = a[: int(500 * share)] + [f"v{rng.randrange(10**6)}" for _ in range(500 - int(500 * share))]
            sets = [{tuple(x[i : i + 5]) for i in range(496)} for x in (a, b)]
            true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
            errors.append(plain_likeness(plain_bins(" ".join(a)), plain_bins(" ".join(b))) - true)
    assert abs(sum(errors) / len(errors)) < 0.02
    assert sum(map(abs, errors)) / len(errors) < 0.05


def test_no_python_in_the_plan(spark, sf, capsys):
    fp.compared(spark.read.parquet(f"{sf}/documents.parquet")).explain("formatted")
    plan = capsys.readouterr().out
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_repeated_rows_null_ids_and_clashing_columns(spark):
    docs = [(1, "a b c d e f g h"), (1, "a b c d e f g h"), (1, "other words of the same id"), (None, "no id at all here"), (2, None)]
    df = spark.createDataFrame([(*r, "x", 5, 6) for r in docs], "doc_id long, text string, k1 string, _id long, n_chars long")
    found = {(r["doc_id"], r["n_chars"]): r for r in fp.digests(df).collect()}
    assert fp.digests(df).count() == 5
    assert found[(2, 0)]["fingerprint"] == "" and found[(2, 0)]["near_edited"] == 1.0
    last = "no id at all here"
    assert found[(None, 17)]["edited_sha256"] in {
        hashlib.sha256((last[:13] + head[:4]).encode()).hexdigest() for _, head in docs[:3]}


def test_single_document_and_empty_table(spark):
    one = fp.digests(spark.createDataFrame([(4, "a b c d e f g h")], "doc_id long, text string")).collect()
    assert one[0]["near_next"] == 1.0 and one[0]["edited_sha256"] == hashlib.sha256(b"a b c d e f " + b"a b").hexdigest()
    assert fp.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0
