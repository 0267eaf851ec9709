import zlib
from collections import Counter

from curbside.llm import language_id as li


def plain_grams(text):
    marked = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    marked = " " + marked + " "
    out = Counter(c for c in marked if c != " ")
    out.update(marked[i : i + 2] for i in range(len(marked) - 1) if marked[i : i + 2].strip())
    out.update(marked[i : i + 3] for i in range(len(marked) - 2) if marked[i + 1] != " ")
    return out


def top(counts, size):
    return sorted(counts, key=lambda g: (-counts[g], [len(g), *((1 if c == " " else ord(c) + 2) for c in g)]))[:size]


def plain(rows, size):
    profiles = {}
    for doc, text, lang in rows:
        if doc is not None and zlib.crc32(str(doc).encode()) % 4 != 2 and text is not None and lang is not None:
            profiles.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {k: top(c, size) for k, c in profiles.items()}
    out = []
    for doc, text, _ in rows:
        own = top(plain_grams(text), size)
        held = doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2
        if not own or not profiles:
            out.append((doc, held, "und", 0.0))
            continue
        far = {k: sum(abs(p.index(g) - i) if g in p else size for i, g in enumerate(own)) for k, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((doc, held, best, round(1 - far[best] / (size * len(own)), 9)))
    return sorted(out, key=repr)


def test_equals_plain_version(spark, monkeypatch, sf):
    monkeypatch.setattr(li, "_SUMMED", 50)
    rows = [(r.doc_id, r.text[:300], r.lang) for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    rows += [(500, None, "xx"), (501, "", "xx"), (502, "12 3!", "xx"), (None, "the of", "en"), (503, "İ ß 漢字 𝒳x", "zz"),
             (503, "the " * 500, None), (503, rows[0][1], "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in li.digests(docs).collect()]
    assert sorted(got, key=repr) == plain(rows, li.PROFILE)


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf.replace('0.001', '0.01')}/documents.parquet")
    rows = li.digests(docs).filter("held_out").join(docs, "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "le la les", "fr", 0.5)], "doc_id long, text string, lang string, score double")
    assert li.predicted(docs, {"fr": [110, 103]}).columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    assert li.digests(docs.limit(0)).count() == 0
    assert [r.lang_pred for r in li.predicted(docs, {}).collect()] == ["und"]
