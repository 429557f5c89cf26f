"""The profile of a set of tables: a few jobs over the data, then schema-sized results."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType

from plumbline import constants as K
from plumbline.functions.columns import normalise, quoted
from plumbline.operators import distinct, duplicates, facts, infer, relate, temporal
from plumbline.operators.quantiles import exact_quantiles
from plumbline.schemas import COLUMN_PROFILE, TABLE_PROFILE
from plumbline.session import together


def local(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A schema-sized result as a local relation."""
    empty = spark.createDataFrame([], schema)
    if not rows:
        return empty
    data = pa.Table.from_pylist(
        [{n: r.get(n) for n in empty.columns} for r in rows], schema=to_arrow_schema(empty.schema)
    )
    return spark.createDataFrame(data, schema=empty.schema)


def fences(q1: float, q3: float) -> dict:
    """Quartiles, range and fences, each rounded to six decimals before the next step."""
    low, high = round(q1, 6), round(q3, 6)
    iqr = round(high - low, 6)
    found = {"num_q1": low, "num_q3": high, "num_iqr": iqr}
    if iqr > 0:
        found["outlier_fence_lo"] = round(low - K.FENCE_MULTIPLIER * iqr, 6)
        found["outlier_fence_hi"] = round(high + K.FENCE_MULTIPLIER * iqr, 6)
    return found


STAGES = ("distinct", "quartiles", "gaps", "values", "samples", "duplicates")


@dataclass
class Profile:
    spark: SparkSession
    tables: dict[str, DataFrame]
    typed: dict[str, DataFrame]
    rows: list[dict]
    table_rows: list[dict]
    as_of: str | None = None
    duplicate_groups: dict[str, DataFrame] = field(default_factory=dict)

    @cached_property
    def columns(self) -> DataFrame:
        return local(self.spark, self.rows, COLUMN_PROFILE)

    @cached_property
    def table_profile(self) -> DataFrame:
        return local(self.spark, self.table_rows, TABLE_PROFILE)

    @cached_property
    def keys(self) -> DataFrame:
        return relate.key_columns(self.columns)

    @cached_property
    def value_members(self) -> DataFrame:
        return relate.group_values(self.tables, self.keys)

    @cached_property
    def relationships(self) -> DataFrame:
        return relate.discover(self.value_members, self.keys)


def _numeric(typed, rows, sorted_rows) -> None:
    """Statistics of parsed text, quartiles, fences and outlier counts of numeric columns."""
    numeric = [r for r in rows if r["inferred_type"] == "numeric"]
    sizes = {
        (r["table"], r["column"]): r["row_count"] - r["null_count"] - r["unparsed"]
        for r in numeric
    }
    options = {} if sorted_rows is None else {"sorted_rows": sorted_rows}
    quartiles = exact_quantiles(typed, sizes, **options)
    for r in numeric:
        found = quartiles.get((r["table"], r["column"]))
        if found:
            r.update(fences(*found))
    fenced = [r for r in numeric if r.get("outlier_fence_lo") is not None]
    counted = facts.measure(
        typed,
        [
            (
                r["table"],
                {
                    "outliers": f"count_if(CAST({quoted(r['column'])} AS DOUBLE) < "
                    f"{r['outlier_fence_lo']!r}D OR CAST({quoted(r['column'])} AS DOUBLE) > "
                    f"{r['outlier_fence_hi']!r}D)"
                },
            )
            for r in fenced
        ],
    )
    for r, c in zip(fenced, counted):
        r["outlier_count"] = c["outliers"]


def _dates(typed, rows) -> None:
    """Gap counts of date columns."""
    dates = [r for r in rows if r["inferred_type"] == "date" and r["date_min"] is not None]
    known = {}
    parsed = []
    for r in dates:
        key = (r["table"], r["column"])
        if r["kind"] == "date":
            known[key] = {
                "n": r["row_count"] - r["null_count"],
                "distinct": r["unique_count"],
                "min": r["date_min"],
                "max": r["date_max"],
            }
        else:
            parsed.append(key)
    if parsed:
        known |= temporal.distinct_moments(typed, parsed)
    gaps = temporal.date_gaps(typed, known)
    for r in dates:
        r["date_gaps"] = gaps.get((r["table"], r["column"]), 0)


def _top_values(tables, rows, keys) -> DataFrame:
    """Top values of key and category columns; returns the value members they are read from."""
    members = relate.group_values(tables, keys)
    by_key = {(r["table"], r["column"]): r for r in rows}
    top = distinct.top_values(relate.counts_of(members, keys)).collect()
    for v in sorted(top, key=lambda v: v["rank"]):
        by_key[v["table"], v["column"]]["top_values"].append(
            {"value": v["value"], "count": v["n"]}
        )
    return members


def _samples(tables, rows) -> None:
    """The smallest distinct values of every column."""
    by_key = {(r["table"], r["column"]): r for r in rows}
    long_text = [r for r in rows if r["kind"] == "string" and r["inferred_type"] == "text"]
    skipped = {(r["table"], r["column"]) for r in long_text}
    short: dict[str, list[str]] = {}
    for r in rows:
        if r["unique_count"] is not None and (r["table"], r["column"]) not in skipped:
            short.setdefault(r["table"], []).append(r["column"])
    if short:
        for v in sorted(
            distinct.smallest_values(tables, short).collect(), key=lambda v: v["rank"]
        ):
            by_key[v["table"], v["column"]]["sample_values"].append(v["value"])
    for r in long_text:
        r["sample_values"] = distinct.smallest_texts(tables[r["table"]], r["column"])


def cardinality_flag(row: dict) -> str:
    if row["inferred_type"] not in ("id", "categorical"):
        return ""
    unique, total = row["unique_count"], row["row_count"]
    if total < K.MIN_ROWS_CARDINALITY:
        return "OK"
    if unique == 1:
        return "LOW"
    if unique > total * K.HIGH_CARDINALITY_RATIO and unique > K.HIGH_CARDINALITY_VALUES:
        return "HIGH"
    return "OK"


def _text_kinds(row: dict) -> None:
    """Parse failures, mixed types and encoding marks, from counts already taken."""
    filled = row["row_count"] - row["null_count"]
    is_text = row["kind"] == "string"
    row["unparsed"] = 0
    row["date_parse_fail"] = 0
    if is_text and row["inferred_type"] == "numeric":
        row["unparsed"] = filled - row["number_count"]
    if is_text and row["inferred_type"] == "date":
        row["date_parse_fail"] = filled - row["date_value_count"]
    row["has_mixed_types"] = row["unparsed"] > 0
    row["encoding_count"] = row["encoding_count"] or 0
    row["has_encoding_issues"] = row["encoding_count"] > 0


def _round(value: float | None) -> float | None:
    return None if value is None else round(value, 6)


def _duplicates(tables, rows) -> tuple[dict[str, int], dict[str, DataFrame]]:
    """Copies and duplicate groups per table. A complete column without repeats rules them
    out, so such tables are not shuffled."""
    complete = {
        r["table"]
        for r in rows
        if r["unique_count"] == r["row_count"] and r["null_count"] == 0
    }

    def look(df: DataFrame) -> tuple[int, DataFrame]:
        found = duplicates.duplicate_groups(df)
        total = found.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("copies"))
        return total.first()["copies"], found

    open_tables = [name for name in tables if name not in complete]
    looked = together(
        next(iter(tables.values())).sparkSession,
        *[lambda df=tables[name]: look(df) for name in open_tables],
    )
    found = dict(zip(open_tables, looked))
    copies = {name: n for name, (n, _) in found.items()}
    return copies, {name: groups for name, (n, groups) in found.items() if n}


def profile(
    tables: Mapping[str, DataFrame],
    as_of: str | None = None,
    declared_keys: Mapping[str, str] | None = None,
    stages: Iterable[str] = STAGES,
    sorted_rows: int | None = None,
    integer_keys: bool = False,
) -> Profile:
    """Profile every column and table; `as_of` is the moment after which dates are future.

    Counts and types are always taken; each stage can be left out. Without the distinct counts
    of all columns no keys are inferred. With `integer_keys`, whole numbers in columns named like a
    key are ids: they take part in relationships and are not measured."""
    stages = set(stages)
    slots = ("string", "timestamp_ntz") if "gaps" in stages else ("string",)
    slots = () if stages == {"quartiles"} else slots  # numbers need no distinct values
    slots = distinct.SLOTS if "distinct" in stages or integer_keys else slots
    tables = {name: normalise(df) for name, df in tables.items()}
    spark = next(iter(tables.values())).sparkSession
    position = {name: i for i, name in enumerate(tables)}
    rows = [
        r.asDict() | {"top_values": [], "sample_values": [], "outlier_count": 0, "date_gaps": 0}
        for r in infer.infer_columns(tables, as_of, declared_keys, slots=slots).collect()
    ]
    rows.sort(key=lambda r: (position[r["table"]], r["position"]))
    for r in rows:
        r["table_position"] = position[r["table"]]
        whole = isinstance(tables[r["table"]].schema[r["column"]].dataType, IntegralType)
        if integer_keys and whole and any(w in r["column"].lower() for w in K.FOREIGN_KEY_NAMES):
            r["inferred_type"] = "id"
        _text_kinds(r)
    types: dict[str, dict[str, str]] = {}
    for r in rows:
        types.setdefault(r["table"], {})[r["column"]] = r["inferred_type"]
    typed = {name: infer.typed_table(df, types[name]) for name, df in tables.items()}

    reparsed: dict[str, list[str]] = {}
    for r in rows:
        if r["kind"] == "string" and r["inferred_type"] in ("numeric", "date"):
            reparsed.setdefault(r["table"], []).append(r["column"])
    if reparsed:
        narrow = {t: typed[t].select(*[quoted(c) for c in cs]) for t, cs in reparsed.items()}
        found = {
            (r["table"], r["column"]): r.asDict()
            for r in facts.column_facts(narrow, (facts.NUMBERS, facts.DATES), as_of).collect()
        }
        for r in rows:
            parsed = found.get((r["table"], r["column"]))
            if parsed:
                r.update(
                    {n: parsed[n] for n, _, f in facts.FACTS if f in (facts.NUMBERS, facts.DATES)}
                )
    for r in rows:
        for name in ("num_min", "num_max", "num_mean", "num_std"):
            r[name] = _round(r[name])
        r["negative_count"] = r["negative_count"] or 0
        r["has_negatives"] = r["negative_count"] > 0
        r["date_future"] = r["date_future"] or 0
        r["cardinality_flag"] = cardinality_flag(r)
    keys = relate.key_columns(local(spark, rows, COLUMN_PROFILE)) if "values" in stages else None
    work = {
        "quartiles": lambda: _numeric(typed, rows, sorted_rows),
        "gaps": lambda: _dates(typed, rows),
        "values": lambda: _top_values(tables, rows, keys),
        "samples": lambda: _samples(tables, rows),
        "duplicates": lambda: _duplicates(tables, rows),
    }
    # a column without nulls proves that no row is empty; only the other tables are read again
    known = {}
    for r in rows:
        if r["null_count"] == 0:
            known[r["table"]] = {
                "table": r["table"], "table_position": position[r["table"]],
                "row_count": r["row_count"], "col_count": len(tables[r["table"]].columns),
                "columns": tables[r["table"]].columns, "fully_empty_rows": 0,
            }
    others = {name: df for name, df in tables.items() if name not in known and df.columns}

    def count_rows() -> list[dict]:
        counted = facts.table_sizes(others).collect() if others else []
        return [*known.values(), *(r.asDict() | {"table_position": position[r["table"]]} for r in counted)]

    # every stage fills fields of its own
    chosen = {name: task for name, task in work.items() if name in stages}
    sizes, *done = together(
        spark, count_rows, *chosen.values()
    )
    results = dict(zip(chosen, done))
    copies, groups = results.get("duplicates", ({}, {}))
    table_rows = sorted(sizes, key=lambda r: r["table_position"])
    for t in table_rows:
        t["duplicate_rows"] = copies.get(t["table"], 0)
        key = next((r for r in rows if r["table"] == t["table"] and r["is_likely_pk"]), None)
        t["likely_pk"] = key["column"] if key else None
        # a declared key may hold nulls, which count as equal to each other
        repeated_nulls = key["null_count"] if key and key["null_count"] > 1 else 0
        t["duplicate_pk_rows"] = key["repeated_rows"] + repeated_nulls if key else 0
    found = Profile(spark, tables, typed, rows, table_rows, as_of, groups)
    if "values" in results:
        found.keys, found.value_members = keys, results["values"]
    return found
