"""How the schema of a series of files changes.

The sequential rules (a null-typed column keeps the type seen before and becomes nullable,
nullable sticks, a drop forgets everything) are associative: what a stretch of consecutive files
does to a field is a row of four values, and stretches merge. The sorted files are dealt into blocks,
a field's files are followed within a block, and blocks hand on one row per field.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from curbside.session import checkpointed

_ROW_BITS = 33  # monotonically_increasing_id has the partition above these bits


def _rendered(nullable: Column, type_: Column) -> Column:
    return F.concat(F.when(nullable, "?").otherwise(""), type_)


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _upto(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def file_order(files: DataFrame) -> DataFrame:
    """(file, block, at, size, first_file, next_file): sorted files in blocks, without a window over all of them.

    Files are sorted by range; a block is a range, ``at`` the place in it and ``size`` its files. One
    window numbers the blocks, of which there are as many as shuffle partitions at most.
    """
    row = F.monotonically_increasing_id()
    mask = (1 << _ROW_BITS) - 1
    placed = checkpointed(files.select("file").distinct().orderBy("file").select(
        "file", F.shiftright(row, _ROW_BITS).alias("part"), row.bitwiseAND(F.lit(mask)).alias("at")))
    in_order = Window.partitionBy(F.lit(0)).orderBy("part")  # one row per block
    blocks = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"), F.min("file").alias("head")).select(
        "part", "size", (F.row_number().over(in_order) - 1).alias("block"), F.lead("head").over(in_order).alias("_next"))
    in_block = Window.partitionBy("block").orderBy("at")
    return placed.join(blocks, "part").select(
        "file", "block", "at", "size", ((F.col("block") == 0) & (F.col("at") == 0)).alias("first_file"),
        F.coalesce(F.lead("file").over(in_block), "_next").alias("next_file"))


def _states(rows: DataFrame, run: list[str], order: str) -> DataFrame:
    """Running state of each run of items (known, nulls, untyped, typed), merged in order.

    An item is a file or a whole block: ``known`` whether a real value was seen, ``nulls`` whether it
    is nullable by itself, ``untyped`` whether it becomes so once something is known, ``typed`` its type.
    """
    window = Window.partitionBy(*run).orderBy(order)
    rows = rows.withColumn("_seen", F.coalesce(F.max("known").over(_before(window)), F.lit(False)))
    upto = _upto(window)
    return rows.withColumns({
        "run_known": F.max("known").over(upto),
        "run_nulls": F.max(F.col("nulls") | (F.col("untyped") & F.col("_seen"))).over(upto),
        "run_untyped": F.max("untyped").over(upto),
        "run_typed": F.last("typed", ignorenulls=True).over(upto),
    }).drop("_seen")


def field_states(profile: DataFrame) -> DataFrame:
    """Effective type and nullability of every field after every file, with run boundaries.

    Input: one row per (file, field, type, has_nulls); files are ordered by name.
    """
    profile = checkpointed(profile.select("file", "field", "type", "has_nulls"))
    rows = profile.join(file_order(profile), "file")
    by_field = Window.partitionBy("field", "block").orderBy("at")
    # A run that starts with its block has the number -1.
    rows = rows.withColumn("run", F.col("at") - F.row_number().over(by_field)).withColumns({
        "known": (F.col("type") != "null") | F.col("has_nulls"),
        "nulls": F.col("has_nulls"),
        "untyped": F.col("type") == "null",
        "typed": F.when(F.col("type") != "null", F.col("type")),
    })
    in_run = Window.partitionBy("field", "block", "run").orderBy("at")
    rows = checkpointed(_states(rows, ["field", "block", "run"], "at").withColumn(
        "_ends", F.lead("at").over(in_run).isNull()))

    at_end = F.col("at") == F.col("size") - 1
    tails = rows.filter(at_end).select(
        "field", "block", "run", *[F.col(f"run_{c}").alias(c) for c in ("known", "nulls", "untyped", "typed")])
    by_block = Window.partitionBy("field").orderBy("block")
    # A block goes on with the one before it if the field fills it from its first file on.
    fresh = (F.col("run") != -1) | F.coalesce(F.lag("block").over(by_block) != F.col("block") - 1, F.lit(True))
    tails = tails.withColumn("_fresh", fresh.cast("int")).withColumn("chain", F.sum("_fresh").over(_upto(by_block)))
    carried = _states(tails, ["field", "chain"], "block").select(
        "field", (F.col("block") + 1).alias("block"), F.lit(-1).cast("long").alias("run"),
        *[F.col(f"run_{c}").alias(f"in_{c}") for c in ("known", "nulls", "typed")])
    heads = rows.filter("at = 0").select("field", (F.col("block") - 1).alias("block"), F.lit(True).alias("_goes_on"))

    rows = rows.withColumn("run", F.col("run").cast("long"))
    rows = rows.join(carried, ["field", "block", "run"], "left").join(heads, ["field", "block"], "left")
    handed = F.coalesce(F.col("in_nulls"), F.lit(False)) | (F.col("run_untyped") & F.coalesce(F.col("in_known"), F.lit(False)))
    rows = rows.withColumns({
        "nullable": F.col("run_nulls") | handed,
        "effective": F.coalesce("run_typed", "in_typed", F.lit("null")),
    }).withColumn("schema", _rendered(F.col("nullable"), F.col("effective")))
    entered = F.when(F.col("in_known").isNotNull(), _rendered(F.col("in_nulls"), F.coalesce("in_typed", F.lit("null"))))
    return rows.withColumns({
        "previous": F.coalesce(F.lag("schema").over(in_run), F.when(F.col("at") == 0, entered)),
        "last_of_run": F.col("_ends") & ~(at_end & F.coalesce("_goes_on", F.lit(False))),
    }).select("file", "field", "type", "has_nulls", "nullable", "effective", "schema", "previous",
              "last_of_run", "first_file", "next_file")


def schema_changes(profile: DataFrame) -> DataFrame:
    """(file, field, change): the first file in full, then ``+ type``, ``-`` and ``: a -> b``."""
    states = checkpointed(field_states(profile))
    first = states.filter("first_file").select("file", "field", F.concat(F.lit(": "), "schema").alias("change"))
    added = states.filter(~F.col("first_file") & F.col("previous").isNull()).select(
        "file", "field", F.concat(F.lit("+ "), "schema").alias("change")
    )
    changed = states.filter(F.col("previous") != F.col("schema")).select(
        "file", "field", F.concat(F.lit(": "), "previous", F.lit(" -> "), "schema").alias("change")
    )
    dropped = states.filter(F.col("last_of_run") & F.col("next_file").isNotNull()).select(
        F.col("next_file").alias("file"), "field", F.lit("-").alias("change")
    )
    return first.unionByName(added).unionByName(changed).unionByName(dropped)


def final_schema(profile: DataFrame) -> DataFrame:
    """(field, schema) of the fields still there in the last file."""
    return field_states(profile).filter(F.col("next_file").isNull()).select("field", "schema")
