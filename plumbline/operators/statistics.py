"""Statistics of the check registry: z-scores, first digits, relative dispersion."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions.columns import literal, quoted
from plumbline.operators.facts import NUMBERS, column_facts, measure
from plumbline.session import union_all


def zscore_outliers(tables: Mapping[str, DataFrame], facts: list) -> list[dict]:
    """Values more than three standard deviations from the mean, per numeric column.

    `facts` are rows with num_mean and num_std; they go into the second scan as literals."""
    chosen = [r for r in facts if r["num_std"]]
    wanted = []
    for r in chosen:
        score = f"(CAST({quoted(r['column'])} AS DOUBLE) - {r['num_mean']!r}D) / {r['num_std']!r}D"
        wanted.append((r["table"], {"outliers": f"count_if(abs({score}) > {K.ZSCORE_LIMIT})"}))
    counted = measure(tables, wanted)
    return [
        {"table": r["table"], "column": r["column"], "outlier_count": c["outliers"]}
        for r, c in zip(chosen, counted)
    ]


def first_digits(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]]) -> DataFrame:
    """Share of each first significant digit among positive values against Benford's law.

    One scan per table: the digit of every value is taken once, and digits combine before the
    shuffle. Columns with few positive values are left out."""
    parts = []
    for table, names in columns.items():
        cells = ", ".join(f"{literal(c)}, CAST({quoted(c)} AS DOUBLE)" for c in names)
        digits = (
            tables[table]
            .selectExpr(f"stack({len(names)}, {cells}) AS (`column`, value)")
            .where("value > 0")
            .selectExpr("`column`", "regexp_extract(CAST(value AS STRING), '[1-9]', 0) AS digit")
            .groupBy("column", "digit")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        counts = digits.groupBy("column").agg(
            F.sum("n").alias("positive_count"),
            *[F.expr(f"coalesce(sum(n) FILTER (WHERE digit = '{d}'), 0) AS d{d}") for d in range(1, 10)],
        )
        rows = ", ".join(f"struct({d} AS digit, d{d} AS digit_count)" for d in range(1, 10))
        parts.append(
            counts.selectExpr(
                f"{literal(table)} AS `table`", "`column`", "positive_count", f"inline(array({rows}))"
            )
        )
    return (
        union_all(parts)
        .where(F.col("positive_count") >= K.BENFORD_MIN_ROWS)
        .withColumn("observed", F.col("digit_count") / F.col("positive_count"))
        .withColumn("expected", F.log10(1 + F.lit(1) / F.col("digit")))
    )


def variation(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Standard deviation over mean of every numeric column."""
    return (
        column_facts(tables, (NUMBERS,))
        .where("kind = 'numeric'")
        .select("table", "column", F.try_divide("num_std", "num_mean").alias("cv"))
    )
