"""Run snapshots: what each run loaded and found in its columns, kept as an append-only history.

A run is written in parts (tables, columns, values) under a name of its own, and its commit last.
Only committed runs are read back, so a run that was broken off is never a baseline."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.distinct import value_counts
from plumbline.operators.drift import normalised_name
from plumbline.sources import history

SCHEMA = (
    "table string, row_count bigint, columns array<string>, files array<string>, "
    "saved_at string, run_id string"
)
COLUMNS = (
    "table string, column string, inferred_type string, row_count bigint, null_count bigint, "
    "unique_count bigint, num_min double, num_max double, num_mean double, num_std double, "
    "date_min timestamp_ntz, date_max timestamp_ntz, has_values boolean"
)
VALUES = "table string, column string, value string, n bigint"
#: The folder of each part and its columns; rows lie under the name their run was written as.
PARTS = {"tables": SCHEMA, "columns": COLUMNS, "values": VALUES}


@dataclass
class State:
    """What is kept of a run: a row for each table, for each column, and for each value of a column
    with a limited set of values."""

    tables: DataFrame
    columns: DataFrame
    values: DataFrame


def snapshot(tables: DataFrame, files: Mapping[str, str], run_id: str, saved_at: str) -> DataFrame:
    """One row per table from a table profile; `files` names the source of each table."""
    source = F.col("table")
    for name, path in files.items():
        source = F.when(
            F.col("table") == name, F.lit(str(path).rsplit("/", 1)[-1])
        ).otherwise(source)
    return tables.select(
        normalised_name(F.col("table")).alias("table"),
        F.col("row_count").cast("bigint").alias("row_count"),
        "columns",
        F.array(source).alias("files"),
        F.lit(saved_at).alias("saved_at"),
        F.lit(run_id).alias("run_id"),
    )


def listed_columns(columns: DataFrame) -> DataFrame:
    """Columns whose values are kept: categories, and ids that point elsewhere."""
    return columns.where(
        "inferred_type = 'categorical' OR (inferred_type = 'id' AND is_likely_fk AND NOT is_likely_pk)"
    ).select("table", "column")


def state(
    tables: Mapping[str, DataFrame],
    table_profile: DataFrame,
    column_profile: DataFrame,
    files: Mapping[str, str] | None = None,
    run_id: str = "",
    saved_at: str = "",
) -> State:
    """The state of a run from its profile; the values of the listed columns are counted from the tables."""
    spark = table_profile.sparkSession
    listed = [tuple(r) for r in listed_columns(column_profile).collect()]  # schema-sized
    by_table: dict[str, list[str]] = {}
    for table, column in listed:
        by_table.setdefault(table, []).append(column)
    values = value_counts(tables, by_table) if listed else spark.createDataFrame([], VALUES)
    kept = spark.createDataFrame(listed, "table string, column string").withColumn("kept", F.lit(True))
    columns = column_profile.join(F.broadcast(kept), ["table", "column"], "left")  # one row per column
    names = [part.split()[0] for part in COLUMNS.split(", ")]
    return State(
        snapshot(table_profile, files or {}, run_id, saved_at),
        columns.withColumns(
            {"table": normalised_name(F.col("table")), "has_values": F.coalesce("kept", F.lit(False))}
        ).select(*names),
        values.withColumn("table", normalised_name(F.col("table"))),
    )


def append(rows: DataFrame, path: str, columns: DataFrame | None = None, values: DataFrame | None = None) -> None:
    """Add a run to the history: its table rows, and what is given of its columns and values; at last the
    commit that makes it a baseline. A run is rows of one run id and one time."""
    named = rows.agg(F.max("run_id"), F.max("saved_at")).first()
    parts = {"tables": rows, "columns": columns, "values": values}
    given = {name: df for name, df in parts.items() if df is not None}
    history.add(rows.sparkSession, path, given, named[0] or "", named[1] or "")


def latest_state(spark: SparkSession, path: str) -> State | None:
    """What was kept of the latest run; None if there is none yet."""
    last = history.latest(spark, path)
    if last is None:
        return None
    return State(**{name: history.part(spark, path, name, schema, [last]) for name, schema in PARTS.items()})


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The table rows of the latest run; no rows if there is none yet."""
    found = latest_state(spark, path)
    return found.tables if found else spark.createDataFrame([], SCHEMA)


def baseline_info(rows: DataFrame) -> DataFrame:
    """When the last run was saved, its files, tables and total rows."""
    return rows.groupBy("saved_at").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("files")))).alias("files"),
        F.array_sort(F.collect_set("table")).alias("tables"),
        F.sum("row_count").alias("total_rows"),
    )
