"""Configured business rules: required columns, allowed values, value ranges."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted, ref
from plumbline.operators.facts import measure
from plumbline.session import union_all


def missing_columns(tables: Mapping[str, DataFrame], rules: list[dict]) -> list[dict]:
    """Rules whose required column does not exist. Only names are looked at."""
    return [
        rule
        for rule in rules
        if rule.get("validator") == "column_exists"
        and rule.get("applies_to") in tables
        and rule.get("column")
        and rule["column"] not in tables[rule["applies_to"]].columns
    ]


UNKNOWN = "rule int, rule_id string, table string, column string, value string, n bigint"


def unknown_values(df: DataFrame, column: str, allowed: list) -> DataFrame:
    """Values outside the allowed set with their row counts."""
    rule = {"validator": "allowed_values", "applies_to": "", "column": column, "values": allowed}
    return all_unknown_values({"": df}, [rule]).select("value", "n")


def all_unknown_values(tables: Mapping[str, DataFrame], rules: list[dict]) -> DataFrame:
    """Every value outside the allowed set of its rule, with its number of rows; `rule` is the
    place of the rule in the configuration.

    The columns of all rules of a table are grouped in one scan. Values combine before the shuffle.
    The allowed values are part of the configuration, so their table is small."""
    places = {id(r): i for i, r in enumerate(rules)}
    by_table: dict[str, list[dict]] = {}
    for rule in allowed_value_rules(tables, rules):
        by_table.setdefault(rule["applies_to"], []).append(rule)
    parts = []
    for name, chosen in by_table.items():
        df = tables[name]
        spark = df.sparkSession
        cells = ", ".join(
            f"{places[id(r)]}, CAST({quoted(r['column'])} AS STRING)" for r in chosen
        )
        counted = (
            df.selectExpr(f"stack({len(chosen)}, {cells}) AS (rule, value)")
            .where("value IS NOT NULL")
            .groupBy("rule", "value")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        listed = [
            {"rule": places[id(r)], "rule_id": str(r.get("id", "?")), "column": r["column"], "value": str(v)}
            for r in chosen
            for v in r["values"]
        ]
        allowed = spark.createDataFrame(
            pa.Table.from_pylist(listed),
            schema="rule int, rule_id string, column string, value string",
        )
        typed = F.lit(None).cast("string")
        for r in chosen:
            same = F.col("rule") == places[id(r)]
            known = F.col("value").try_cast(df.schema[r["column"]].dataType).cast("string")
            typed = F.when(same, known).otherwise(typed)
        names = allowed.select("rule", "rule_id", "column").distinct()
        parts.append(
            counted.join(allowed.select("rule", typed.alias("value")), ["rule", "value"], "left_anti")
            .join(names, "rule")
            .select("rule", "rule_id", F.lit(name).alias("table"), "column", "value", "n")
        )
    if parts:
        return union_all(parts)
    spark = SparkSession.active()
    return spark.createDataFrame([], UNKNOWN)


def allowed_value_rules(tables: Mapping[str, DataFrame], rules: list[dict]) -> list[dict]:
    return [
        rule
        for rule in rules
        if rule.get("validator") == "allowed_values"
        and rule.get("applies_to") in tables
        and rule.get("column") in tables[rule["applies_to"]].columns
        and rule.get("values")
    ]


def range_violations(tables: Mapping[str, DataFrame], rules: list[dict]) -> list[dict]:
    """Rows outside [min, max] per value_range rule; all rules in one scan per table."""
    chosen = [
        rule
        for rule in rules
        if rule.get("validator") == "value_range"
        and rule.get("applies_to") in tables
        and rule.get("column") in tables[rule["applies_to"]].columns
    ]
    wanted = []
    for rule in chosen:
        number = f"CAST({quoted(rule['column'])} AS DOUBLE)"
        bounds = [
            f"{number} {sign} {float(rule[end])!r}D"
            for end, sign in (("min", "<"), ("max", ">"))
            if rule.get(end) is not None
        ]
        wanted.append(
            (rule["applies_to"], {"affected": f"count_if({' OR '.join(bounds) or 'false'})"})
        )
    return [rule | found for rule, found in zip(chosen, measure(tables, wanted))]
