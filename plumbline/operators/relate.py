"""Relationship discovery and orphans from one grouping of the key values.

Every distinct value is grouped once with the columns it occurs in (at most the number of key
columns). Values that occur in the same set of columns are then counted together, so column
pairs are formed from a handful of column sets and never from rows or values.
"""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions.columns import ref
from plumbline.functions.parsing import name_similarity, thousands
from plumbline.operators.distinct import cells, value_counts
from plumbline.session import cut, pin

KEY_TYPES = ("id", "categorical")
#: Up to so many key columns each have a counter per value; with more, the counters would take a task's memory,
#: and only those that are not zero are kept.
COUNTED_KEYS = 4


def key_columns(columns: DataFrame) -> DataFrame:
    """The columns that can take part in a relationship, numbered."""
    rows = sorted(
        columns.where(F.col("inferred_type").isin(*KEY_TYPES))
        .select(
            "table", "column", "table_position", "position", "inferred_type",
            "unique_count", "unique_pct", "row_count", "null_count",
        )
        .collect(),
        key=lambda r: (r["table_position"], r["position"]),
    )
    schema = (
        "key int, table string, column string, table_position int, position int, "
        "inferred_type string, unique_count bigint, unique_pct double, value_rows bigint"
    )
    data = [
        {
            "key": i,
            **{n: r[n] for n in (
                "table", "column", "table_position", "position", "inferred_type",
                "unique_count", "unique_pct",
            )},
            "value_rows": r["row_count"] - r["null_count"],
        }
        for i, r in enumerate(rows)
    ]
    spark = columns.sparkSession
    return spark.createDataFrame(
        pa.Table.from_pylist(data) if data else [], schema=schema
    )


def value_members(counts: DataFrame, keys: DataFrame) -> DataFrame:
    """(value, keys, members): each value once, with the key columns it occurs in and the
    number of rows in each."""
    numbered = counts.join(
        F.broadcast(keys.select("table", "column", "key")), ["table", "column"]
    )
    return (
        numbered.groupBy("value")
        .agg(F.sort_array(F.collect_list(F.struct("key", "n"))).alias("members"))
        .withColumn("keys", F.transform("members", lambda m: m["key"]))
    )


def counted_members(tables: Mapping[str, DataFrame], wanted: Mapping[str, list[str]], keys: DataFrame) -> DataFrame:
    """The same from the rows at once: one counter per key column, so that values are shuffled once and counted
    without lists being collected. For a limited number of key columns."""
    found = {(r["table"], r["column"]): r["key"] for r in keys.collect()}
    text = {t: df.select(*[ref(c).cast("string").alias(c) for c in wanted[t]]) for t, df in tables.items() if wanted.get(t)}
    listing = [found[t, c] for t, df in text.items() for c in df.columns]  # cells number the columns in this order
    order = sorted(range(len(listing)), key=listing.__getitem__)
    counted = cells(text, "string").groupBy("value").agg(*[F.count_if(F.col("key") == i).alias(f"n{i}") for i in order])
    held = ", ".join(f"named_struct('key', {listing[i]}, 'n', n{i})" for i in order)
    columns = " + ".join(f"IF(n{i} > 0, 1, 0)" for i in order)
    only = " + ".join(f"IF(n{i} > 0, {listing[i]}, 0)" for i in order)
    rows = " + ".join(f"n{i}" for i in order)
    # most values are of one column, and need no function called for each column
    alone = f"array(named_struct('key', {only}, 'n', {rows}))"
    members = F.expr(f"IF({columns} = 1, {alone}, filter(array({held}), m -> m.n > 0))").alias("members")
    return counted.select("value", members).withColumn("keys", F.col("members")["key"])


def pair_overlaps(members: DataFrame) -> DataFrame:
    """For each ordered pair of key columns: shared values and the rows of the first column
    that hold them."""
    per_set = (
        members.select("keys", F.inline("members"))
        .groupBy("keys", "key")
        .agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("rows"))
    )
    return (
        per_set.select("key", "values", "rows", F.explode("keys").alias("other"))
        .where("key <> other")
        .groupBy("key", "other")
        .agg(F.sum("values").alias("overlap"), F.sum("rows").alias("overlap_rows"))
    )


def relationships(overlaps: DataFrame, keys: DataFrame) -> DataFrame:
    """Accept, direct and grade column pairs; one row per relationship."""
    a = keys.select(*[F.col(c).alias(f"a_{c}") for c in keys.columns])
    b = keys.select(*[F.col(c).alias(f"b_{c}") for c in keys.columns])
    pairs = (
        overlaps.join(F.broadcast(a), F.col("key") == F.col("a_key"))
        .join(F.broadcast(b), F.col("other") == F.col("b_key"))
        .where("a_table <> b_table AND a_inferred_type = b_inferred_type")
        .withColumn("name_match", name_similarity(F.col("a_column"), F.col("b_column")))
        .withColumn("a_pct", F.expr("overlap / a_unique_count * 100"))
        .withColumn("b_pct", F.expr("overlap / b_unique_count * 100"))
    )
    passes = (
        "({0} >= %s AND ({0} >= %s OR name_match >= %s))"
        % (K.MATCH_FLOOR_PCT, K.MATCH_WEAK_PCT, K.NAME_SIMILAR)
    )
    pairs = pairs.withColumn("a_ok", F.expr(passes.format("a_pct"))).withColumn(
        "b_ok", F.expr(passes.format("b_pct"))
    )
    # The side with the lower distinct share points to the other one; it is accepted by
    # either side's share. With equal shares each direction must pass by its own.
    accepted = pairs.where(
        "(a_unique_pct < b_unique_pct AND (a_ok OR b_ok)) OR (a_unique_pct = b_unique_pct AND a_ok)"
    )
    found_as_ab = F.expr(
        "a_unique_pct = b_unique_pct OR (a_table_position < b_table_position AND a_ok) "
        "OR (a_table_position > b_table_position AND NOT b_ok)"
    )
    ab = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(
        ("a_table_position", "b_table_position", "a_position", "b_position"))])
    ba = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(
        ("b_table_position", "a_table_position", "b_position", "a_position"))])
    confidence = F.expr(
        f"""
        CASE WHEN a_pct >= {K.MATCH_HIGH_PCT} AND name_match >= {K.NAME_STRONG} THEN 'HIGH'
             WHEN a_pct >= {K.MATCH_SURE_PCT} THEN 'HIGH'
             WHEN a_pct >= {K.MATCH_MEDIUM_PCT} OR name_match >= {K.NAME_STRONG} THEN 'MEDIUM'
             ELSE 'LOW' END
        """
    )
    # fixed values: the wording of the reason
    reason = F.concat_ws(
        " + ",
        F.when(
            F.col("name_match") >= K.NAME_SIMILAR,
            F.concat(
                F.lit("column names similar ("), thousands(F.col("name_match") * 100, 0),
                F.lit("%)"),
            ),
        ),
        F.when(
            F.col("a_pct") > 0,
            F.concat(thousands(F.col("a_pct"), 0), F.lit("% of values overlap")),
        ),
    )
    return accepted.select(
        F.when(found_as_ab, ab).otherwise(ba).alias("found_at"),
        F.col("a_key").alias("from_key"),
        F.col("b_key").alias("to_key"),
        F.col("a_table").alias("from_table"),
        F.col("a_column").alias("from_column"),
        F.col("b_table").alias("to_table"),
        F.col("b_column").alias("to_column"),
        confidence.alias("confidence"),
        F.bround("a_pct", 1).alias("match_pct"),
        F.col("a_pct").alias("match_share"),
        reason.alias("reason"),
        F.col("a_inferred_type").alias("key_type"),
        (F.col("a_unique_count") - F.col("overlap")).alias("orphan_values"),
        (F.col("a_value_rows") - F.col("overlap_rows")).alias("orphan_rows"),
    )


def group_values(tables: Mapping[str, DataFrame], keys: DataFrame) -> DataFrame:
    """The value members of all key columns, written once: top values, relationships and
    orphans are all read from them."""
    wanted: dict[str, list[str]] = {}
    for row in keys.collect():
        wanted.setdefault(row["table"], []).append(row["column"])
    if not wanted:
        return keys.sparkSession.createDataFrame(
            [], "value string, members array<struct<key:int,n:bigint>>, keys array<int>"
        )
    if sum(map(len, wanted.values())) <= COUNTED_KEYS:
        return cut(counted_members(tables, wanted, keys))
    return cut(value_members(value_counts(tables, wanted), keys))


def counts_of(members: DataFrame, keys: DataFrame) -> DataFrame:
    """Back to the histogram (table, column, value, n)."""
    names = F.broadcast(keys.select("key", "table", "column"))  # one row per key column
    return members.select("value", F.inline("members")).join(names, "key").select(
        "table", "column", "value", "n"
    )


def discover(members: DataFrame, keys: DataFrame) -> DataFrame:
    """All relationships, one row each; evaluated once."""
    return pin(relationships(pair_overlaps(members), keys))


def checked(relations: DataFrame) -> DataFrame:
    """The relationships whose orphans are reported."""
    return relations.where("confidence IN ('HIGH', 'MEDIUM') AND orphan_values > 0")


def orphan_examples(
    members: DataFrame, relations: DataFrame, k: int = K.EXAMPLES
) -> DataFrame:
    """The k smallest orphaned values per reported relationship.

    The list of reported relationships is schema-sized and travels as a literal; the rank
    filter limits each relationship inside the task before the shuffle."""
    pairs = sorted(
        {(r["from_key"], r["to_key"]) for r in checked(relations).collect()}
    )
    literal = F.expr(
        "array(" + ", ".join(f"struct({a} AS from_key, {b} AS to_key)" for a, b in pairs) + ")"
        if pairs
        else "CAST(array() AS array<struct<from_key:int,to_key:int>>)"
    )
    orphaned = F.filter(
        literal,
        lambda r: F.array_contains(F.col("keys"), r["from_key"])
        & ~F.array_contains(F.col("keys"), r["to_key"]),
    )
    order = Window.partitionBy("from_key", "to_key").orderBy("value")
    return (
        members.select("value", F.inline(orphaned))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .groupBy("from_key", "to_key")
        .agg(F.sort_array(F.collect_list("value")).alias("examples"))
    )


def unconnected_tables(relations: DataFrame, tables: DataFrame) -> DataFrame:
    """Tables that take part in no HIGH or MEDIUM key relationship."""
    strong = relations.where("confidence IN ('HIGH', 'MEDIUM')")
    connected = (
        strong.select(F.col("from_table").alias("table"))
        .union(strong.select(F.col("to_table").alias("table")))
        .distinct()
    )
    return tables.join(connected, "table", "left_anti")
