import base64
import random

import public_tokenizers
import pytest
from test_language_id import plain_grams, top
from test_line_dedup import plain as plain_lines
from test_secret_scan import plain as plain_secrets
from test_simhash import plain_components
from tokenizers import Tokenizer

import corpus_pipeline as cp
from curbside.llm import language_id, line_dedup, secret_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    rng = random.Random(4)
    words = {"en": "the of and that with thing her ing".split(), "fr": "le la des que eau une ment oui".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(["", "s", "ra"]) for _ in range(n))
    out = [(i, "\n".join(text(lang, 25) for _ in range(3)), lang, "s", 1) for i, lang in enumerate(["en", "fr"] * 8)]
    out += [(20, out[0][1], "en", "s", 1), (21, out[1][1] + " x", "fr", "s", 1), (22, None, "en", "s", 1), (23, "", "fr", None, None)]
    out += [(24, "123 456 !!", "en", "s", 1), (25, "the token = \"abcdefgh12\" of AKIA" + "A1" * 8 + " " + text("en", 30), None, "s", 1)]
    out += [(26, text("en", 900), "en", "s", 1), (27, out[2][1].split("\n")[1] + "\n" + text("en", 20), "en", "s", 1)]
    return out


def plain_run(docs):
    """What stays before packing: (doc_id, text)."""
    counts = {}
    for _, t, lang, *_ in docs:
        if t is not None and lang is not None:
            counts.setdefault(lang, plain_grams("")).update(plain_grams(t))
    profiles = {k: top(c, language_id.PROFILE) for k, c in counts.items()}
    kept = []
    for d, t, *_ in docs:
        own = top(plain_grams(t), language_id.PROFILE)
        score = max((1 - sum(abs(p.index(g) - i) if g in p else language_id.PROFILE for i, g in enumerate(own))
                     / (language_id.PROFILE * len(own)) for p in profiles.values()), default=0) if own else 0
        if own and score >= cp.MIN_SCORE:
            kept.append((d, t))
    lines = plain_lines(kept, line_dedup.MIN_LINE, line_dedup.RARE, line_dedup.MIN_BLOCK)
    shorter = [(int(d), t) for d, _, gone, t in lines if not gone or t.strip()]
    leaders = {d: c for d, _, c in plain_components(shorter)}
    left = []
    for d, t in shorter:
        if leaders[d] == d:
            out, end = "", 0
            for s, _, e, _ in plain_secrets(t)[1]:
                if s >= end:
                    out += t[end:s] + "[secret]"
                end = max(end, e)
            left.append((d, out + t[end:]))
    return dict(left)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages_equal_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in cp.STAGES[:-1]:
        docs, _ = cp.staged(stage(spark, docs, folder), name)
        assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")]
    got = {r.doc_id: r.text for r in docs.collect()}
    want = plain_run(rows())
    assert got == want
    assert 20 not in got and 22 not in got and 24 not in got and "[secret]" in got[25] and set(range(16)) <= set(got)
    assert all(r.n_chars == len(r.text) for r in docs.filter("doc_id in (25, 27)").collect())


def test_run_packs_what_stays(spark, folder):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in plain_run(rows()).items()}
    got, ends = {}, {}
    for r in cp.run(spark, folder).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
        ends[r.sequence_id] = ends.get(r.sequence_id, 0) + r.length
    assert got == want and max(ends.values()) <= 2048


def test_language_stage_rejects_noise_and_unlearned_languages(spark):
    rng = random.Random(7)
    noise = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 10))) for _ in range(400))
    dump = base64.b64encode(rng.randbytes(2000)).decode()
    polish = ("wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem "
              "i powinni postępować wobec innych w duchu braterstwa")
    finnish = ("kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto "
               "ja heidän on toimittava toisiaan kohtaan veljeyden hengessä")
    planted = [(-1 - i, t, None, "planted", len(t)) for i, t in enumerate((noise, dump, polish, finnish))]
    clean = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*[f.split()[0] for f in SCHEMA.split(", ")])
    docs = clean.unionByName(spark.createDataFrame(planted, SCHEMA))
    letters = clean.filter(r"text rlike '\\p{L}'").select("doc_id")
    kept = cp.identify_language(spark, docs, "").select("doc_id")
    assert kept.filter("doc_id < 0").count() == 0
    assert letters.subtract(kept).count() == 0 and letters.count() >= 990


def test_empty_table_and_extra_columns(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "simhash", "secret_scan", "packing"]
    assert secret_scan.SCOPE > 0


def test_extra_columns_of_any_name_survive(spark, sf):
    from pyspark.sql import functions as F

    names = ["score", "removed", "kept", "lang_pred", "spans", "k1", "fingerprint", "a.b"]
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    docs = docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names])
    for name, stage in cp.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names), name
