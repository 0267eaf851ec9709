"""Secret scans with multipart credential linking, in DataFrame functions only.

A span is (kind, start, end) in code points, end exclusive. Base kinds are reported wherever they match. Weak kinds are
parts of a credential that mean little alone: an identifier is reported if a secret lies within ``SCOPE`` code points of
it, a weak secret if an identifier does, an endpoint if both do. Base spans are such parts too. Parts must not overlap.

The parts meet in an interval join: starts and ends are put into cells of ``SCOPE`` code points, of which each keeps its
least and greatest, and a weak span looks into the two cells on either side of it. So a cell makes one row, however many
parts it holds.

Positions come from the lengths of the matches and of the text between them. Rows with the same doc_id and text have the
same result. Null texts count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curbside.llm.common import staged, text_key, text_of

SCOPE = 200


def _either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _words(*words: str) -> str:
    return "(?:" + "|".join(map(_either_case, words)) + ")"


_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
#: Kinds in the order of reports: name, pattern, least length of the match or of its group, role.
KINDS = [
    ("assign", _words("password", "passwd", "secret", "token", "api_?key") + _GIVEN + "([A-Za-z0-9+/_.=-]+)", 8, 1, "secret"),
    ("access", "AKIA[A-Z0-9]+", 16, 0, "identifier"),
    ("hex", "[0-9a-f]{32,}", 32, 0, "secret"),
    ("ident", _words("access_?key_?id", "client_?id", "user_?name", "user", "login", "account") + _GIVEN + "([A-Za-z0-9+/_.@-]+)",
     3, 1, "identifier"),
    ("pass", _words("passphrase", "pass", "pwd", "credential") + _GIVEN + "([A-Za-z0-9+/_.=-]+)", 4, 1, "secret"),
    ("mixed", "[A-Za-z0-9+/_=-]{20,}", 20, 0, "secret"),
    ("endpoint", _words("https?", "ftp", "postgresql", "mysql", "mongodb", "redis", "amqp") + r"""://[^\x20\x09-\x0D"'<>]+""",
     10, 0, "endpoint"),
]
BASE = 3  # the first kinds
NEEDS = {"ident": ["secret"], "pass": ["identifier"], "mixed": ["identifier"], "endpoint": ["identifier", "secret"]}
SPAN = "array<struct<s:int,k:int,e:int>>"


def _let(value: Column, body) -> Column:
    """body(value), with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + x)


def _sums_before(numbers: Column, block: int = 64, levels: int = 2) -> Column:
    """Per element the sum of all before it: those of its block, and the sums of blocks before, found the same way.

    So an element costs about ``block`` steps a level, and the top level has one sum for ``block ** (levels + 1)`` elements.
    """
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(numbers) / block).cast("int")),
        lambda b: _sum(F.slice(numbers, b * block + 1, F.lit(block))))

    def before(sums: Column) -> Column:
        if levels:
            return _sums_before(sums, block, levels - 1)
        return F.transform(sums, lambda _, i: _sum(F.slice(sums, F.lit(1), i)))

    return _let(blocks, lambda sums: _let(before(sums), lambda earlier: F.transform(numbers, lambda _, i: F.get(
        earlier, F.floor(i / block).cast("int")) + _sum(F.slice(numbers, F.floor(i / block).cast("int") * block + 1, i % block)))))


def kind_spans(text: Column, number: int) -> Column:
    """Spans of one kind, leftmost and not overlapping, without those that are too short."""
    name, pattern, least, group, _ = KINDS[number]
    p = F.lit(pattern)

    def spans(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x))
        sizes = F.transform(found, lambda x: F.char_length(x))
        # Sums of an expression would compute it once an element.
        return _let(gaps, lambda g: _let(sizes, lambda n: _let(
            _let(F.zip_with(F.slice(g, F.lit(1), F.size(n)), n, lambda a, b: a + b), lambda each: _sums_before(each)),
            lambda before: F.transform(n, lambda size, i: F.struct(
                (F.get(before, i) + F.get(g, i)).alias("s"), F.lit(number).alias("k"),
                (F.get(before, i) + F.get(g, i) + size).alias("e"))))))

    def checked(found: Column) -> Column:
        all_spans = spans(found)
        if group:
            return _let(F.regexp_extract_all(text, p, F.lit(group)), lambda values: F.filter(
                all_spans, lambda _, i: F.char_length(F.get(values, i)) >= least))
        if name == "mixed":
            return F.filter(all_spans, lambda _, i: F.get(found, i).rlike("[0-9]") & F.get(found, i).rlike("[a-z]")
                            & F.get(found, i).rlike("[A-Z]"))
        return F.filter(all_spans, lambda x: x.e - x.s >= least)

    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, p, F.lit(0)), checked)).otherwise(
        F.array().cast(SPAN)).cast(SPAN)


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, text key, ``base`` and ``weak`` spans of every whole text."""
    text = text_of()
    spans = docs.select("doc_id", *text_key(), *[kind_spans(text, i).alias(k[0]) for i, k in enumerate(KINDS)])
    names = [k[0] for k in KINDS]
    return spans.select("doc_id", "k1", "k2", F.concat(*names[:BASE]).alias("base"), F.concat(*names[BASE:]).alias("weak"))


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, k1, k2, links): the weak spans whose complementary parts lie within scope."""
    row = ["_id", "k1", "k2"]  # a row without an id is a struct with a null in it, which equals itself
    once = found.filter("size(weak) > 0").select(
        F.struct("doc_id", F.col("doc_id").isNull().alias("z")).alias("_id"), "k1", "k2", "base", "weak").distinct()
    role = F.element_at(F.array(*[F.lit(k[4]) for k in KINDS]), F.col("x.k") + 1)
    parts = once.select(*row, F.explode(F.concat("base", "weak")).alias("x")).select(*row, "x", role.alias("role")).filter(
        "role != 'endpoint'")
    cell = lambda c: F.floor(F.col(c) / scope)
    edges = parts.select(*row, "role", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("x.s").alias("at")), F.struct(F.lit(1).alias("side"), F.col("x.e").alias("at")))).alias("p"))
    cells = edges.select(*row, "role", "p.side", "p.at", cell("p.at").alias("cell")).groupBy(*row, "role", "side", "cell").agg(
        F.min("at").alias("least"), F.max("at").alias("most"))
    needs = F.element_at(F.array(*[F.array(*map(F.lit, NEEDS.get(k[0], []))).cast("array<string>") for k in KINDS]), F.col("x.k") + 1)
    weak = once.select(*row, F.explode("weak").alias("x")).select(*row, "x", needs.alias("needs"))
    probes = weak.select(
        *row, "x", F.size("needs").alias("n"), F.explode("needs").alias("role")).select(
        "*", F.explode(F.array(*[
            F.struct(F.lit(side).alias("side"), (cell(edge) + step).alias("cell"))
            for side, edge, steps in ((0, "x.e", (0, 1)), (1, "x.s", (-1, 0))) for step in steps])).alias("q")).select(
        "*", "q.side", "q.cell").drop("q")
    # A cell is as long as the scope: all of the nearer cell is near enough, all of the farther one on the right side.
    near = F.when(F.col("side") == 0, F.col("most").between(F.col("x.e"), F.col("x.e") + scope)
                  | F.col("least").between(F.col("x.e"), F.col("x.e") + scope)).otherwise(
        F.col("most").between(F.col("x.s") - scope, F.col("x.s")) | F.col("least").between(F.col("x.s") - scope, F.col("x.s")))
    met = probes.join(cells, [*row, "role", "side", "cell"]).filter(near).select(*row, "x", "n", "role").distinct()
    return (
        met.groupBy(*row, "x", "n").agg(F.count("*").alias("roles")).filter("roles = n")
        .groupBy(*row).agg(F.collect_list("x").alias("links"))
        .select(F.col("_id.doc_id").alias("doc_id"), "k1", "k2", "links")
    )


def _written(spans: Column) -> Column:
    name = lambda x: F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), x.k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x.s, x.e)), ",")


def scanned(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, text key, sorted ``base`` spans and ``spans`` with the linked ones, per row."""
    found, _ = staged(candidates(docs), "secret-candidates")
    links = linked(found, scope).select(F.col("doc_id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "links")
    same = found.doc_id.eqNullSafe(links["_id"]) & (found.k1 == links["_k1"]) & (found.k2 == links["_k2"])
    every = F.concat("base", F.coalesce("links", F.array().cast(SPAN)))
    return found.join(links, same, "left").select(
        "doc_id", "k1", "k2", F.array_sort("base").alias("base"), F.array_sort(every).alias("spans"))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, numbers of base spans, hash of them, and all spans."""
    count = lambda k: F.size(F.filter("base", lambda x: x.k == k)).cast("long")
    return scanned(docs).select(
        "doc_id", *[count(i).alias(f"n_{KINDS[i][0]}") for i in range(BASE)],
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[secret]", scope: int = SCOPE) -> DataFrame:
    """The documents with every reported span replaced by ``mark``; overlapping spans by one. Columns stay."""
    hits = scanned(docs, scope).filter("size(spans) > 0").select(
        F.col("doc_id").alias("_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), F.col("spans").alias("_spans")).distinct()
    rows = docs.select("*", *text_key(prefix="_t"))
    same = rows.doc_id.eqNullSafe(hits["_id"]) & (rows["_tk1"] == hits["_k1"]) & (rows["_tk2"] == hits["_k2"])
    # Spans are sorted: what stays is what lies between the furthest end so far and the next start.
    state = F.struct(F.lit(0).alias("end"), F.lit("").alias("out"))
    text = F.col("text")
    cut = F.aggregate(
        "_spans", state,
        lambda a, x: F.struct(
            F.greatest(a.end, x.e).alias("end"),
            F.when(x.s >= a.end, F.concat(a.out, F.substring(text, a.end + 1, x.s - a.end), F.lit(mark)))
            .otherwise(a.out).alias("out")),
        lambda a: F.concat(a.out, F.substring(text, a.end + 1, F.char_length(text))))
    return rows.join(hits, same, "left").select(
        *[F.when(F.col("_spans").isNull(), F.col(c)).otherwise(cut).alias(c) if c == "text" else F.col(c) for c in docs.columns])


def oracle_sql() -> str:
    """The same in DuckDB: pairs of parts are compared one by one."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, (name, pattern, least, group, role) in enumerate(KINDS):
        value = f"regexp_extract_all(t, {q(pattern)}, {group})"
        check = f"length(v[i]) >= {least}"
        if name == "mixed":
            check += " AND regexp_matches(v[i], '[0-9]') AND regexp_matches(v[i], '[a-z]') AND regexp_matches(v[i], '[A-Z]')"
        parts.append(f"""
            SELECT doc_id, {i} AS k, {q(name)} AS kind, {q(role)} AS role, s, s + length(m[i]) AS e FROM (
              SELECT doc_id, m, v, i, (coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0)
                     + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
              FROM (SELECT doc_id, g, m, v, unnest(range(1, len(m) + 1)) AS i FROM (
                SELECT doc_id, string_split_regex(t, {q(pattern)}) AS g, regexp_extract_all(t, {q(pattern)}, 0) AS m, {value} AS v
                FROM texts WHERE regexp_matches(t, {q(pattern)}))))
            WHERE {check}""")
    near = f"(b.s BETWEEN a.e AND a.e + {SCOPE} OR b.e BETWEEN a.s - {SCOPE} AND a.s)"
    has = lambda role: f"EXISTS (SELECT 1 FROM spans b WHERE b.doc_id = a.doc_id AND b.role = '{role}' AND {near})"
    needs = " OR ".join(f"(a.kind = '{k}' AND {' AND '.join(map(has, r))})" for k, r in NEEDS.items())
    line = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k)"
    counts = ", ".join(f"count(*) FILTER (WHERE k = {i}) AS n_{KINDS[i][0]}" for i in range(BASE))
    return f"""
        WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), spans AS ({' UNION ALL '.join(parts)}),
        kept AS (SELECT * FROM spans a WHERE k < {BASE} OR {needs}),
        per AS (SELECT doc_id, {counts}, {line} FILTER (WHERE k < {BASE}) AS base, {line} AS spans FROM kept GROUP BY doc_id)
        SELECT doc_id, {', '.join(f"coalesce(n_{KINDS[i][0]}, 0)::BIGINT AS n_{KINDS[i][0]}" for i in range(BASE))},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM documents LEFT JOIN per USING (doc_id)"""
