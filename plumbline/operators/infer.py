"""Semantic types, primary keys and foreign-key hints, decided on column facts.

The inputs here hold one row per column, so everything is schema-sized.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions import parsing as P
from plumbline.functions.columns import STRING, kinds, ref
from plumbline.operators.distinct import SLOTS, TEXT_TESTS, distinct_counts, row_tests
from plumbline.operators.facts import DATES, NULLS, NUMBERS, column_facts
from plumbline.session import pin, together

ALL_FAMILIES = (NULLS, NUMBERS, DATES)


def with_types(facts: DataFrame) -> DataFrame:
    """Add inferred_type by the first rule that holds."""
    return facts.withColumn(
        "inferred_type",
        F.expr(
            f"""
            CASE
              WHEN kind IN ('date', 'numeric', 'boolean') THEN kind
              WHEN kind <> 'string' OR row_count = null_count THEN 'text'
              WHEN date_pattern_count / (row_count - null_count) > {K.DATE_RATIO}
               AND date_value_count / (row_count - null_count) > {K.DATE_RATIO} THEN 'date'
              WHEN number_count / (row_count - null_count) > {K.NUMERIC_RATIO} THEN 'numeric'
              WHEN id_pattern_count / (row_count - null_count) > {K.ID_RATIO} THEN 'id'
              WHEN unique_count / (row_count - null_count) < {K.CATEGORICAL_RATIO}
                OR unique_count <= {K.CATEGORICAL_MAX_VALUES} THEN 'categorical'
              ELSE 'text'
            END
            """
        ),
    )


def with_percentages(facts: DataFrame) -> DataFrame:
    rows = F.col("row_count")
    return facts.withColumns(
        {
            "null_pct": P.percent(F.col("null_count"), rows),
            "unique_pct": P.percent(F.col("unique_count"), rows),
        }
    )


def with_foreign_key_hint(facts: DataFrame) -> DataFrame:
    """Key-like names with few distinct values."""
    hint = P.name_has(F.col("column"), K.FOREIGN_KEY_NAMES)
    low = F.col("unique_pct") < K.FOREIGN_KEY_UNIQUE_PCT
    return facts.withColumn("is_likely_fk", F.coalesce(hint & low, F.lit(False)))


def key_candidates(facts: DataFrame) -> DataFrame:
    """Complete and (almost) unique columns with their score and rank within the table."""
    name = P.name_has(F.col("column"), K.PRIMARY_KEY_NAMES)
    kind = F.col("inferred_type").isin("id", "categorical")
    first = F.col("position") == 0
    score = (
        F.when(name, 3).otherwise(0) + F.when(kind, 2).otherwise(0) + F.when(first, 1).otherwise(0)
    )
    best_first = Window.partitionBy("table").orderBy(F.desc("score"), F.asc("position"))
    return (
        facts.where(
            (F.col("row_count") >= K.MIN_ROWS_PRIMARY_KEY)
            & (F.col("null_count") == 0)
            & (F.col("unique_pct") >= K.PRIMARY_KEY_UNIQUE_PCT)
        )
        .withColumn("score", score)
        .withColumn("rank", F.row_number().over(best_first))
    )


def with_primary_key(facts: DataFrame, declared: Mapping[str, str] | None = None) -> DataFrame:
    """Mark the best candidate of each table; a declared key replaces the inferred one."""
    best = (
        key_candidates(facts)
        .where("rank = 1")
        .select("table", "column", F.lit(True).alias("inferred_pk"))
    )
    marked = facts.join(F.broadcast(best), ["table", "column"], "left")  # one row per table
    flag = F.coalesce("inferred_pk", F.lit(False))
    for table, column in (declared or {}).items():
        flag = F.when(F.col("table") == table, F.col("column") == column).otherwise(flag)
    return marked.withColumn("is_likely_pk", flag).drop("inferred_pk")


def _with_counts(facts: DataFrame, counts: DataFrame | None) -> DataFrame:
    if counts is not None:
        return facts.join(F.broadcast(counts), ["table", "column"], "left")  # one row per column
    names = ("unique_count", "repeated_rows", *TEXT_TESTS)
    return facts.selectExpr("*", *[f"CAST(NULL AS BIGINT) AS {name}" for name in names])


def infer_columns(
    tables: Mapping[str, DataFrame],
    as_of: str | None = None,
    declared_keys: Mapping[str, str] | None = None,
    families: tuple[str, ...] = ALL_FAMILIES,
    slots: tuple[str, ...] = SLOTS,
) -> DataFrame:
    """Facts, counts, inferred type and key marks of every column; evaluated once.

    Types need the values of text columns only. Keys need those of all columns, so with fewer
    slots no key is inferred. With none, text is only told from numbers and dates."""

    def counted() -> DataFrame | None:
        counts = distinct_counts(tables, with_tests=True, slots=slots) if slots else row_tests(tables)
        return None if counts is None else pin(counts)

    facts, counts = together(
        next(iter(tables.values())).sparkSession,
        lambda: pin(column_facts(tables, families, as_of)),
        counted,
    )
    typed = with_foreign_key_hint(with_percentages(with_types(_with_counts(facts, counts))))
    if set(slots) != set(SLOTS):
        return pin(typed.withColumn("is_likely_pk", F.lit(False)))
    return pin(with_primary_key(pin(typed), declared_keys))


def infer_types(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Inferred type of every column. Only text columns need their values counted."""
    facts = column_facts(tables, (NULLS,))
    return with_types(
        _with_counts(facts, distinct_counts(tables, with_tests=True, slots=("string",)))
    )


def typed_table(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns inferred as numeric or date become numbers or timestamps."""
    parse = {"numeric": P.to_number, "date": P.to_timestamp}
    column_kinds = kinds(df)
    return df.select(
        *[
            parse[types[c]](ref(c)).alias(c)
            if column_kinds[c] == STRING and types.get(c) in parse
            else ref(c)
            for c in df.columns
        ]
    )
