import hashlib
import random
import re
import time

import duckdb

from curbside.llm import secret_scan as ss

PIECES = ["token = \"abcdefgh1\"", "AKIA" + "A1" * 8, "AKIAB", "f" * 40, "user=bob", "pwd: xyzw", "Zz9" * 8, "https://a.b/c?d", " ", "é𝒳 ",
          "\n", "password=token: abcdefgh", "API_KEY='", "secret=short", "x" * 30, "w " * 60, "SeCrEt : " + "Q" * 12, "client_id = 12"]


def plain(text, scope=ss.SCOPE):
    text = text or ""
    spans = []
    for k, (name, pattern, least, group, role) in enumerate(ss.KINDS):
        for m in re.finditer(pattern, text):
            v = m.group(group)
            if len(v) >= least and (name != "mixed" or all(re.search(c, v) for c in ("[0-9]", "[a-z]", "[A-Z]"))):
                spans.append((m.start(), k, m.end(), role))

    def near(a, role):
        return any(r == role and (a[2] <= s <= a[2] + scope or a[0] - scope <= e <= a[0]) for s, _, e, r in spans)

    kept = sorted(a for a in spans if a[1] < ss.BASE or all(near(a, r) for r in ss.NEEDS[ss.KINDS[a[1]][0]]))
    name = lambda part: ",".join(f"{ss.KINDS[k][0]}:{s}:{e}" for s, k, e, _ in part)
    base = [a for a in kept if a[1] < ss.BASE]
    return (*(sum(a[1] == i for a in base) for i in range(3)), hashlib.sha256(name(base).encode()).hexdigest(), name(kept)), kept


def rows():
    rng = random.Random(1)
    texts = [None, "", "AKIA" * 5, "token=token=12345678", "a" * 5000 + " token=aaaaaaaaa"]
    texts += ["".join(rng.choice(PIECES) for _ in range(rng.randrange(1, 14))) for _ in range(200)]
    texts.append(" ".join(rng.choice(PIECES) for _ in range(600)))
    return [*enumerate(texts), (None, texts[10]), (None, texts[20]), (7, texts[7]), (7, texts[8])]


def test_equals_plain_version(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string").repartition(3)
    got = sorted((repr(r[0]), *r[1:]) for r in ss.digests(docs).collect())
    assert got == sorted((repr(d), *plain(t)[0]) for d, t in rows())


def test_sql_equals_plain_version():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    own = [r for r in rows()[:150] if r[0] is not None]
    con.executemany("INSERT INTO documents VALUES (?, ?)", own)
    assert sorted(con.execute(ss.oracle_sql()).fetchall()) == sorted((d, *plain(t)[0]) for d, t in own)


def test_redaction(spark):
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows()], "doc_id long, text string, spans int")
    for d, t, _ in [tuple(r) for r in ss.redacted(docs).collect()]:
        want = set()
        for i, own in rows():
            if i != d:
                continue
            out, end = "", 0
            for s, _, e, _ in plain(own)[1]:
                if s >= end:
                    out += own[end:s] + "[secret]"
                end = max(end, e)
            want.add(None if own is None else out + own[end:])
        assert t in want


def test_empty_table(spark):
    assert ss.digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_long_text_with_many_matches_takes_linear_time(spark):
    text = "token=abcdefgh1 AKIA" + "A1" * 8 + " x\n"
    docs = spark.createDataFrame([(1, text * 25_000)], "doc_id long, text string")
    started = time.time()
    row = ss.digests(docs).first()
    assert row.n_assign == row.n_access == 25_000 and time.time() - started < 90
    spans = row.spans.split(",")
    assert spans[-1] == f"access:{24_999 * len(text) + 16}:{24_999 * len(text) + 36}"
