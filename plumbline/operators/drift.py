"""Schema drift against an expected schema, and drift between two recorded states."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.session import union_all


def normalised_name(column="table"):
    """A table name without a version suffix: fx_v2 is fx."""
    return F.regexp_replace(column, K.VERSION_SUFFIX, "")


def catalogue(spark: SparkSession, schema: Mapping[str, list[str]]) -> DataFrame:
    """(table, column, position) rows of a schema given as names; no data is read."""
    rows = [(t, c, i) for t, columns in schema.items() for i, c in enumerate(columns)]
    return spark.createDataFrame(
        pa.table({name: [r[i] for r in rows] for i, name in enumerate(("table", "column", "position"))})
        if rows else [],
        schema="table string, column string, position int",
    )


def schema_of(tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    return {name: df.columns for name, df in tables.items()}


def schema_drift(
    spark: SparkSession,
    actual: Mapping[str, list[str]],
    expected: Mapping[str, list[str]] = K.EXPECTED_SCHEMA,
) -> DataFrame:
    """Missing tables, missing columns and added columns; high risk first.

    Tables that are not expected are not reported."""
    have = catalogue(spark, actual).withColumn("table", normalised_name())
    want = catalogue(spark, expected)
    order = catalogue(spark, {"": list(expected)}).select(
        F.col("column").alias("table"), F.col("position").alias("table_position")
    )
    missing_tables = (
        want.select("table").distinct().join(have.select("table"), "table", "left_anti")
    )
    tables = missing_tables.select(
        F.lit("TABLE_MISSING").alias("type"),
        "table",
        F.lit(None).cast("string").alias("column"),
        F.lit("HIGH").alias("risk"),
        F.concat(F.lit("Table ["), "table", F.lit("] is expected but was not loaded; "
                 "everything that reads it will fail.")).alias("detail"),
        F.lit(-1).alias("position"),
    )
    missing = (
        want.join(have.select("table", "column"), ["table", "column"], "left_anti")
        .join(missing_tables, "table", "left_anti")
        .select(
            F.lit("COLUMN_MISSING").alias("type"),
            "table",
            "column",
            F.lit("HIGH").alias("risk"),
            F.concat(F.lit("["), "table", F.lit("."), "column", F.lit("] is required but "
                     "missing; measures and joins that use it will fail.")).alias("detail"),
            "position",
        )
    )
    added = (
        have.join(want.select("table").distinct(), "table", "left_semi")
        .join(want.select("table", "column"), ["table", "column"], "left_anti")
        .select(
            F.lit("COLUMN_ADDED").alias("type"),
            "table",
            "column",
            F.lit("LOW").alias("risk"),
            F.concat(F.lit("["), "table", F.lit("."), "column", F.lit("] is new and not part "
                     "of the expected schema; nothing depends on it.")).alias("detail"),
            F.lit(0).alias("position"),
        )
    )
    rank = F.when(F.col("risk") == "HIGH", 0).otherwise(1)
    return (
        union_all([tables, missing, added])
        .join(order, "table")
        .orderBy(rank, "table_position", "position", "column")
        .select("type", "table", "column", "risk", "detail")
    )


def snapshot_drift(before: DataFrame, now: DataFrame) -> DataFrame:
    """Tables and columns added or removed and row counts changed between two snapshots.

    A snapshot has one row per table: table, row_count, columns."""
    old = before.select("table", F.col("row_count").alias("old_rows"),
                        F.col("columns").alias("old_columns"))
    new = now.select("table", F.col("row_count").alias("new_rows"),
                     F.col("columns").alias("new_columns"))
    both = old.join(new, "table", "full_outer")
    none = F.lit(None).cast("string")

    def events(kind, risk, column, detail, rows):
        return rows.select(
            F.lit(kind).alias("type"), "table", column.alias("column"),
            F.lit(risk).alias("risk"), detail.alias("detail"),
        )

    shared = both.where("old_columns IS NOT NULL AND new_columns IS NOT NULL")
    removed = shared.select("table", F.explode(F.array_except("old_columns", "new_columns")).alias("c"))
    added = shared.select("table", F.explode(F.array_except("new_columns", "old_columns")).alias("c"))
    change = F.concat(F.col("old_rows").cast("string"), F.lit(" -> "), F.col("new_rows").cast("string"))
    return union_all([
        events("TABLE_REMOVED", "HIGH", none, F.lit("table removed"), both.where("new_columns IS NULL")),
        events("TABLE_ADDED", "MEDIUM", none, F.lit("table added"), both.where("old_columns IS NULL")),
        events("COLUMN_REMOVED", "HIGH", F.col("c"), F.lit("column removed"), removed),
        events("COLUMN_ADDED", "MEDIUM", F.col("c"), F.lit("column added"), added),
        events("ROW_COUNT_CHANGE", "LOW", none, change, shared.where("old_rows <> new_rows")),
    ])


def value_set_drift(before: DataFrame, now: DataFrame) -> DataFrame:
    """Values (table, column, value, n) present now and not in the baseline histogram."""
    keys = ["table", "column", "value"]
    return now.join(before.select(*keys), keys, "left_anti")


def numeric_range_drift(before: DataFrame, now: DataFrame) -> DataFrame:
    """Columns whose minimum or maximum moved by more than half of its former size.

    Both inputs hold one row per numeric column: table, column, num_min, num_max."""
    old = before.select(
        "table", "column", F.col("num_min").alias("old_min"), F.col("num_max").alias("old_max")
    )
    new = now.select(
        "table", "column", F.col("num_min").alias("new_min"), F.col("num_max").alias("new_max")
    )

    def change(end):
        moved = F.abs(F.col(f"new_{end}") - F.col(f"old_{end}"))
        return F.when(F.col(f"old_{end}") == 0, F.when(moved == 0, 0.0).otherwise(1.0)).otherwise(
            moved / F.abs(F.col(f"old_{end}"))
        )

    return (
        old.join(new, ["table", "column"])
        .withColumn("min_change", change("min"))
        .withColumn("max_change", change("max"))
        .where(F.greatest("min_change", "max_change") > K.RANGE_DRIFT_SHARE)
    )


#: New values that a drift event names.
NAMED_VALUES = 5
NO_DRIFT = "type string, table string, column string, risk string, detail string"


def run_drift(before, now) -> DataFrame:
    """What changed between the stored states of two runs (tables, columns, values): tables and columns that
    came or went, row counts, values that no column of the former run held, and numeric ranges.

    Values are compared where the former run kept them; a column whose values were not kept then has no
    new values. Only value rows are shuffled; each column's event names its least new values."""
    listed = before.columns.where("has_values").select("table", "column")
    known = now.values.join(F.broadcast(listed), ["table", "column"])  # one row per column
    order = Window.partitionBy("table", "column").orderBy("value")
    fresh = value_set_drift(before.values, known)
    counted = fresh.groupBy("table", "column").agg(F.count("*").alias("values"), F.sum("n").alias("rows"))
    named = (
        fresh.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= NAMED_VALUES)
        .groupBy("table", "column")
        .agg(F.array_sort(F.collect_list("value")).alias("names"))
    )
    more = F.when(F.col("values") > NAMED_VALUES, F.lit(", …")).otherwise(F.lit(""))
    value_events = counted.join(named, ["table", "column"]).select(
        F.lit("VALUE_SET_DRIFT").alias("type"),
        "table",
        "column",
        F.lit("MEDIUM").alias("risk"),
        F.format_string("%d new value(s) in %d row(s): ", "values", "rows").alias("count"),
        F.concat(F.array_join("names", ", "), more).alias("named"),
    )
    numeric = [state.columns.where("inferred_type = 'numeric'") for state in (before, now)]
    moved = [
        F.concat(F.lit(f"{end} "), F.col(f"old_{end}").cast("string"), F.lit(" -> "), F.col(f"new_{end}").cast("string"))
        for end in ("min", "max")
    ]
    range_events = numeric_range_drift(*numeric).select(
        F.lit("NUMERIC_RANGE_DRIFT").alias("type"),
        "table",
        "column",
        F.lit("MEDIUM").alias("risk"),
        F.concat_ws(", ", *moved).alias("detail"),
    )
    return union_all([
        snapshot_drift(before.tables, now.tables),
        value_events.withColumn("detail", F.concat("count", "named")).drop("count", "named"),
        range_events,
    ])
