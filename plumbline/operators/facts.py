"""Single-pass column statistics.

Each table is scanned with plain aggregates (no grouping key, so partial aggregation leaves
one row per task to shuffle) and the wide result row is melted to one row per column. Wide
tables are split into groups of columns; the groups read disjoint columns of the file, and
every aggregate stays below the field limit of whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import parsing as P
from plumbline.functions.columns import (
    BOOLEAN,
    DATE,
    NUMERIC,
    STRING,
    all_missing,
    kinds,
    literal,
    quoted,
)
from plumbline.session import union_all

AGGREGATES_PER_SCAN = 48

NULLS, NUMBERS, DATES = "nulls", "numbers", "dates"

# name, type and family of every fact; a family can be left out of a scan
FACTS = (
    ("null_count", "bigint", NULLS),
    ("num_min", "double", NUMBERS),
    ("num_max", "double", NUMBERS),
    ("num_mean", "double", NUMBERS),
    ("num_std", "double", NUMBERS),
    ("negative_count", "bigint", NUMBERS),
    ("date_min", "timestamp_ntz", DATES),
    ("date_max", "timestamp_ntz", DATES),
    ("date_future", "bigint", DATES),
)


def _aggregates(name: str, kind: str, as_of: str | None) -> dict[str, str]:
    """The aggregates of one column as SQL text: wide tables need hundreds of them."""
    column = quoted(name)
    found = {"null_count": f"count_if({column} IS NULL)"}
    if kind == NUMERIC:
        number = f"CAST({column} AS DOUBLE)"
        found |= {
            "num_min": f"min({number})",
            "num_max": f"max({number})",
            "num_mean": f"avg({number})",
            "num_std": f"stddev_samp({number})",
            "negative_count": f"count_if({number} < 0)",
        }
    if kind == DATE:
        moment = f"CAST({column} AS TIMESTAMP_NTZ)"
        found |= {"date_min": f"min({moment})", "date_max": f"max({moment})"}
        if as_of is not None:
            found["date_future"] = f"count_if({moment} > TIMESTAMP_NTZ {literal(as_of)})"
    return found


def _scans(plan: list[tuple[int, str, dict[str, str]]]) -> Iterable[list]:
    """Cut the columns of one table into groups with a bounded number of aggregates."""
    group, size = [], 0
    for entry in plan:
        if group and size + len(entry[2]) > AGGREGATES_PER_SCAN:
            yield group
            group, size = [], 0
        group.append(entry)
        size += len(entry[2])
    if group:
        yield group


def table_facts(
    table: str,
    df: DataFrame,
    families: Iterable[str] = (NULLS, NUMBERS, DATES),
    as_of: str | None = None,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """One row per column of one table with the facts of the wanted families."""
    families = set(families)
    wanted = df.columns if columns is None else list(columns)
    family_of = {name: family for name, _, family in FACTS}
    types = {name: data_type for name, data_type, _ in FACTS}
    column_kinds = kinds(df)
    plan = [
        (
            position,
            name,
            {
                fact: expr
                for fact, expr in _aggregates(name, column_kinds[name], as_of).items()
                if family_of[fact] in families
            },
        )
        for position, name in enumerate(df.columns)
        if name in wanted
    ]
    parts = []
    for group in _scans(plan):
        scan = df.selectExpr(
            "count(1) AS row_count",
            *[f"{e} AS `{p}_{fact}`" for p, _, exprs in group for fact, e in exprs.items()],
        )
        melted = [
            f"struct({literal(table)} AS table, {literal(name)} AS column, "
            f"{position} AS position, {literal(column_kinds[name])} AS kind, row_count, "
            + ", ".join(
                f"CAST({f'`{position}_{fact}`' if fact in exprs else 'NULL'} AS {data_type})"
                f" AS {fact}"
                for fact, data_type in types.items()
            )
            + ")"
            for position, name, exprs in group
        ]
        parts.append(scan.selectExpr(f"inline(array({', '.join(melted)}))"))
    return union_all(parts)


def column_facts(
    tables: Mapping[str, DataFrame],
    families: Iterable[str] = (NULLS, NUMBERS, DATES),
    as_of: str | None = None,
) -> DataFrame:
    """One row per column over all tables; the scans of all tables run as one job."""
    return union_all(
        table_facts(name, df, families, as_of) for name, df in tables.items() if df.columns
    )


def measure(
    tables: Mapping[str, DataFrame], wanted: list[tuple[str, dict[str, str]]]
) -> list[dict]:
    """Evaluate SQL aggregates over many tables in one job.

    Each entry names a table and its aggregates; all entries give the same result names.
    Returns one dict per entry. For a bounded number of entries (columns, ranks, rules).
    """
    if not wanted:
        return []
    parts = []
    for table in dict.fromkeys(t for t, _ in wanted):
        plan = [(i, table, exprs) for i, (t, exprs) in enumerate(wanted) if t == table]
        for group in _scans(plan):
            scan = tables[table].selectExpr(
                *[f"{e} AS `{i}_{name}`" for i, _, exprs in group for name, e in exprs.items()]
            )
            structs = [
                f"struct({i} AS entry, "
                + ", ".join(f"`{i}_{name}` AS `{name}`" for name in exprs)
                + ")"
                for i, _, exprs in group
            ]
            parts.append(scan.selectExpr(f"inline(array({', '.join(structs)}))"))
    found = {row["entry"]: row.asDict() for row in union_all(parts).collect()}
    return [found[i] for i in range(len(wanted))]


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and fully empty rows of every table."""
    return union_all(
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(all_missing(df.columns)).alias("fully_empty_rows"),
        ).select(
            F.lit(name).alias("table"),
            F.lit(position).alias("table_position"),
            "row_count",
            F.lit(len(df.columns)).alias("col_count"),
            F.array(*[F.lit(c) for c in df.columns]).alias("columns"),
            "fully_empty_rows",
        )
        for position, (name, df) in enumerate(tables.items())
        if df.columns
    )


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Null count and share of every column."""
    facts = column_facts(tables, (NULLS,))
    return facts.select(
        "table",
        "column",
        "position",
        "row_count",
        "null_count",
        P.percent(F.col("null_count"), F.col("row_count")).alias("null_pct"),
    )
