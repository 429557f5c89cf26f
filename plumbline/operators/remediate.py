"""Remediated tables: filled series, outlier flags, unmapped rows, reference flags."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import parsing as P
from plumbline.functions.columns import STRING, kinds, ref
from plumbline.operators.ordered import forward_fill
from plumbline.operators.skew import lookup


def outlier_flag(df: DataFrame, column: str, low: float, high: float):
    """OUTLIER outside the fences, else OK; a missing value is OK."""
    number = P.to_number(ref(column)) if kinds(df)[column] == STRING else ref(column)
    number = number.cast("double")
    outside = (number < low) | (number > high)
    return F.when(F.coalesce(outside, F.lit(False)), "OUTLIER").otherwise("OK")


def flag_outliers(
    df: DataFrame, fences: Mapping[str, tuple[float, float]], suffix: str = "-quality-flag"
) -> DataFrame:
    return df.withColumns(
        {f"{c}{suffix}": outlier_flag(df, c, low, high) for c, (low, high) in fences.items()}
    )


def fill_numeric_gaps(
    df: DataFrame, columns: list[str], date: str, buckets: int | None = None
) -> DataFrame:
    """Forward-fill along a date column, which may still be text."""
    if kinds(df)[date] != STRING:
        return forward_fill(df, date, columns, buckets=buckets)
    others = [c for c in df.columns if c not in columns]
    return forward_fill(df, P.to_timestamp(ref(date)), columns, ties=others, buckets=buckets)


def _reference_keys(reference: DataFrame, keys: list[str]) -> DataFrame:
    named = [ref(c).alias(f"key_{i}") for i, c in enumerate(keys)]
    complete = reduce(lambda a, b: a & b, [ref(c).isNotNull() for c in keys])
    return reference.where(complete).select(*named).distinct()


def mark_mapped(
    df: DataFrame, reference: DataFrame, keys: list[str], flag: str = "is-mapped"
) -> DataFrame:
    """All rows with a flag that tells whether the key exists in the reference table."""
    known = _reference_keys(reference, keys).withColumn("known", F.lit(True))
    joined = lookup(df, known, [(c, f"key_{i}") for i, c in enumerate(keys)])
    return joined.select(
        *[ref(c) for c in df.columns], F.coalesce("known", F.lit(False)).alias(flag)
    )


def split_mapped(
    df: DataFrame, reference: DataFrame, keys: list[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows whose key exists in the reference table, and the rows to log separately."""
    flag = "__mapped__"
    marked = mark_mapped(df, reference, keys, flag)
    return marked.where(ref(flag)).drop(flag), marked.where(~ref(flag)).drop(flag)


def mark_reference_data(
    df: DataFrame, key: str, reference: DataFrame, reference_key: str, value: str
) -> DataFrame:
    """Left join of one reference value and the flag [has-reference-data].

    The reference is reduced to one value per key first, so the join never multiplies rows."""
    known = reference.groupBy(ref(reference_key).alias("reference_key")).agg(
        F.max(ref(value)).alias("reference_value")
    )
    return lookup(df, known.where("reference_key IS NOT NULL"), [(key, "reference_key")]).select(
        *[ref(c) for c in df.columns],
        F.col("reference_value").alias(value),
        F.col("reference_value").isNotNull().alias("has-reference-data"),
    )


def clean_table(df: DataFrame, columns: list, fill: bool = True) -> DataFrame:
    """Numeric nulls filled along the first date column, outliers flagged with the fences of the
    raw data; `columns` are the profile rows of the table."""
    dates = [r["column"] for r in columns if r["inferred_type"] == "date"]
    numeric = [r for r in columns if r["inferred_type"] == "numeric"]
    gaps = [r["column"] for r in numeric if r["null_count"] > 0]
    if fill and gaps and dates:
        df = fill_numeric_gaps(df, gaps, dates[0])
    fences = {
        r["column"]: (r["outlier_fence_lo"], r["outlier_fence_hi"])
        for r in numeric
        if r["outlier_count"] > 0
    }
    return flag_outliers(df, fences) if fences else df


class Cleaned(Mapping):
    """The remediated tables by name. A table is built when it is first asked for: filling one
    starts jobs, which a run that only wants findings does not need."""

    def __init__(self, tables: Mapping[str, DataFrame], profile_rows: list, fill: bool = True) -> None:
        self._tables, self._rows, self._fill = tables, profile_rows, fill
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            columns = [r for r in self._rows if r["table"] == name]
            self._built[name] = clean_table(self._tables[name], columns, self._fill)
        return self._built[name]

    def __contains__(self, name: object) -> bool:
        return name in self._tables

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables)


def remediate(
    tables: Mapping[str, DataFrame], profile_rows: list, fill: bool = True
) -> Mapping[str, DataFrame]:
    return Cleaned(tables, profile_rows, fill)
