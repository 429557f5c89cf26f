"""Fully duplicate rows and duplicate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions.columns import comparable, quoted, ref
from plumbline.operators.skew import lookup
from plumbline.session import cut

BROADCAST_ROWS = 1_000_000


def _row_hash(df: DataFrame):
    """Hash of a row that tells (NULL, x) from (x, NULL)."""
    parts = []
    for name in df.columns:
        parts += [comparable(df, name), ref(name).isNull()]
    return F.xxhash64(*parts)


def duplicate_groups(df: DataFrame) -> DataFrame:
    """The distinct rows that occur more than once, with their number of copies n.

    Step 1 shuffles an 8-byte hash per distinct row instead of whole rows and keeps the
    hashes that repeat. Step 2 groups whole rows, but only the candidates; it decides exactly,
    so a hash collision costs work and never a wrong result. Copies collapse before each
    shuffle, however many there are.
    """
    candidates = cut(
        df.select(_row_hash(df).alias("row_hash"))
        .groupBy("row_hash")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("row_hash")
    )
    rows = df
    if candidates.count() <= BROADCAST_ROWS:  # at most 8 MB of hashes
        rows = df.withColumn("row_hash", _row_hash(df)).join(
            F.broadcast(candidates), "row_hash", "left_semi"
        )
    # else so many rows repeat that all are grouped; no row is shuffled before its copies met
    return (
        rows.groupBy(*[comparable(df, c).alias(c) for c in df.columns])
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Copies beyond the first of each distinct row."""
    return duplicate_groups(df).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows (nulls are equal)."""
    return (
        df.groupBy(ref(key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
    )


def first_duplicate_keys(df: DataFrame, key: str, k: int = K.EXAMPLES) -> DataFrame:
    return duplicate_keys(df, key).orderBy("key").limit(k)


def keep_latest(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """One row per key: the one with the highest version.

    Spark turns the rank filter into a limit inside each task, so a key held by a large share
    of the rows arrives at the final task as one row per input task."""
    rest = [c for c in df.columns if c not in keys + version]
    order = [ref(c).desc_nulls_last() for c in version] + [ref(c).asc_nulls_last() for c in rest]
    ranked = Window.partitionBy(*[ref(c) for c in keys]).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(ranked)).where("rank = 1").drop("rank")


def flag_duplicates(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """All rows with [is-duplicate] and [version-flag] (LATEST or OLDER)."""
    named = [ref(c).alias(f"key_{i}") for i, c in enumerate(keys)]
    latest = df.groupBy(*named).agg(
        F.count(F.lit(1)).alias("copies"), F.max(ref(version)).alias("latest")
    )
    # single rows need no partner: only repeated keys are joined back
    repeated = latest.where("copies > 1")
    pairs = [(c, f"key_{i}") for i, c in enumerate(keys)]
    return lookup(df, repeated, pairs, null_safe=True).select(
        *[ref(c) for c in df.columns],
        F.col("copies").isNotNull().alias("is-duplicate"),
        F.when(
            F.col("copies").isNull() | ref(version).eqNullSafe(F.col("latest")), "LATEST"
        ).otherwise("OLDER").alias("version-flag"),
    )


def split_version(code: str):
    """Base code and number of a suffix such as -01; codes without a suffix are version 0."""
    base = f"regexp_replace({quoted(code)}, '-[0-9]{{2}}$', '')"
    number = f"CAST(coalesce(nullif(regexp_extract({quoted(code)}, '-([0-9]{{2}})$', 1), ''), '0') AS INT)"
    return F.expr(base), F.expr(number)
