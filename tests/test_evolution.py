import random

import pytest

from curbside.operators import evolution

INT, INT_NULLS, DOUBLE, UNTYPED, UNTYPED_NULLS, ABSENT = ("int64", False), ("int64", True), ("double", False), ("null", False), ("null", True), None

# What a field is in four files, the changes expected in them, and what remains at the end.
HISTORIES = {
    "steady": ([INT] * 4, {0: ": int64"}, "int64"),
    "added": ([ABSENT, INT, INT, INT], {1: "+ int64"}, "int64"),
    "dropped": ([INT, INT, ABSENT, ABSENT], {0: ": int64", 2: "-"}, None),
    "dropped last": ([INT, INT, INT, ABSENT], {0: ": int64", 3: "-"}, None),
    "added again": ([INT_NULLS, ABSENT, DOUBLE, DOUBLE], {0: ": ?int64", 1: "-", 2: "+ double"}, "double"),
    "nullable stays": ([INT, INT_NULLS, INT, INT], {0: ": int64", 1: ": int64 -> ?int64"}, "?int64"),
    "type changes": ([INT, DOUBLE, DOUBLE, INT], {0: ": int64", 1: ": int64 -> double", 3: ": double -> int64"}, "int64"),
    "both change": ([INT, INT_NULLS, DOUBLE, DOUBLE], {0: ": int64", 1: ": int64 -> ?int64", 2: ": ?int64 -> ?double"}, "?double"),
    "untyped keeps the type": ([INT, UNTYPED, INT, INT], {0: ": int64", 1: ": int64 -> ?int64"}, "?int64"),
    "untyped at first": ([UNTYPED, INT, INT, INT], {0: ": null", 1: ": null -> int64"}, "int64"),
    "untyped with nulls": ([UNTYPED_NULLS, DOUBLE, DOUBLE, DOUBLE], {0: ": ?null", 1: ": ?null -> ?double"}, "?double"),
    "untyped throughout": ([UNTYPED] * 4, {0: ": null"}, "null"),
    "untyped after a gap": ([DOUBLE, ABSENT, UNTYPED, DOUBLE], {0: ": double", 1: "-", 2: "+ null", 3: ": null -> double"}, "double"),
}


@pytest.fixture(scope="module")
def profile(spark):
    rows = [(f"f{i}", name, *state) for name, (states, _, _) in HISTORIES.items() for i, state in enumerate(states) if state]
    return spark.createDataFrame(rows, "file string, field string, type string, has_nulls boolean")


def test_changes(profile):
    got = sorted((r.field, r.file, r.change) for r in evolution.schema_changes(profile).collect())
    assert got == sorted((name, f"f{i}", change) for name, (_, changes, _) in HISTORIES.items() for i, change in changes.items())


def test_final_schema(profile):
    got = {r.field: r.schema for r in evolution.final_schema(profile).collect()}
    assert got == {name: final for name, (_, _, final) in HISTORIES.items() if final}


def test_field_names_differ_by_case(spark):
    rows = [("f0", "a", "int64", False), ("f0", "A", "double", False), ("f1", "A", "double", False)]
    profile = spark.createDataFrame(rows, "file string, field string, type string, has_nulls boolean")
    assert {r.field: r.schema for r in evolution.final_schema(profile).collect()} == {"A": "double"}


def folded(rows):
    """The rules applied file by file."""
    out, state, files = [], {}, sorted({r[0] for r in rows})
    for i, file in enumerate(files):
        now = {r[1]: r[2:] for r in rows if r[0] == file}
        for name in sorted(set(state) | set(now)):
            if name not in now:
                out.append((file, name, "-"))
                del state[name]
                continue
            type_, nulls = now[name]
            before = state.get(name)
            if before is None:
                state[name] = (type_, nulls, type_ != "null" or nulls)
            else:
                known = before[2]
                state[name] = (before[0] if type_ == "null" else type_, before[1] or nulls or (type_ == "null" and known),
                               known or type_ != "null" or nulls)
            shown = ("?" if state[name][1] else "") + state[name][0]
            old = before and ("?" if before[1] else "") + before[0]
            if before is None:
                out.append((file, name, (": " if i == 0 else "+ ") + shown))
            elif old != shown:
                out.append((file, name, f": {old} -> {shown}"))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_of_files_against_fold(spark, seed):
    rng = random.Random(seed)
    rows = []
    for name in "abcdefghijkl":
        kind, there = "int64", rng.random() < 0.7
        for i in range(40):
            there = there if rng.random() < 0.9 else not there
            kind = kind if rng.random() < 0.8 else rng.choice(["int64", "double", "null", "null"])
            if there:
                rows.append((f"f{i:03}", name, kind, rng.random() < 0.1))
    rows += [(f"f{i:03}", "always", "int64", False) for i in range(40)]
    settings = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        profile = spark.createDataFrame(rows, "file string, field string, type string, has_nulls boolean")
        assert evolution.file_order(profile).select("block").distinct().count() > 3
        got = sorted(tuple(r) for r in evolution.schema_changes(profile).collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == sorted(folded(rows))


def test_no_files(spark):
    profile = spark.createDataFrame([], "file string, field string, type string, has_nulls boolean")
    assert evolution.schema_changes(profile).count() == 0
