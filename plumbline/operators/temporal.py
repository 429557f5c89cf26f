"""Gaps in date sequences and differences in date coverage.

A global `lag` over the rows would pull a table into one task. Whether a series is daily,
sparse or has no usable spacing follows from counts alone:

- with n dates of which d are distinct, the median step is positive exactly when the n - d
  zero steps do not reach the middle of the n - 1 steps;
- a median step above two days needs a range of more than n - 1 days, so only series with
  no more dates than their range has days need their steps looked at one by one.

In both cases the rows that are put in order are bounded by the number of calendar days. Distinct days
come from merged bitmaps, so a task hands on a few KB for a series, whatever its rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions.columns import quoted
from plumbline.functions.parsing import business_days
from plumbline.session import union_all

DAY = timedelta(days=1)
DAY_MICROS = 86_400_000_000


#: Days are numbered from long before any calendar date, so that all numbers are positive.
FIRST_DAY = 1_000_000
BITMAP_DAYS = 32_768


def _days(tables: Mapping[str, DataFrame], series: list[tuple[str, str]]) -> DataFrame:
    """Distinct days of each series.

    Every task marks the days it sees in bitmaps of 4 KB, one for about ninety years of a series. These are
    what is shuffled and merged, however many rows and days there are; then the marked days are listed."""
    numbers = union_all(
        tables[t].selectExpr(f"{i} AS series", f"unix_date(CAST({quoted(c)} AS DATE)) + {FIRST_DAY} AS n")
        for i, (t, c) in enumerate(series)
    ).where("n IS NOT NULL")
    maps = numbers.groupBy("series", F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("days")
    )
    # bit k of a bitmap is bit k % 8 of byte k / 8; bucket b holds the numbers from (b - 1) * BITMAP_DAYS + 1
    marked = maps.selectExpr("series", "bucket", "days", f"explode(sequence(0, {BITMAP_DAYS // 8 - 1})) AS byte").selectExpr(
        "series", "bucket", "byte", "CAST(conv(hex(substring(days, byte + 1, 1)), 16, 10) AS INT) AS bits"
    )
    listed = marked.where("bits > 0").selectExpr("series", "bucket", "byte", "bits", "explode(sequence(0, 7)) AS bit")
    day = f"date_from_unix_date(CAST((bucket - 1) * {BITMAP_DAYS} + byte * 8 + bit + 1 - {FIRST_DAY} AS INT))"
    return listed.where("shiftright(bits, bit) % 2 = 1").selectExpr("series", f"{day} AS day")


def business_day_gaps(
    tables: Mapping[str, DataFrame], series: list[tuple[str, str]]
) -> dict[tuple[str, str], int]:
    """Neighbouring days with more than one business day between them, per series."""
    if not series:
        return {}
    order = Window.partitionBy("series").orderBy("day")
    rows = (
        _days(tables, series)
        .withColumn("previous", F.lag("day").over(order))
        .groupBy("series")
        .agg(F.count_if(business_days(F.col("previous"), F.col("day")) > 1).alias("gaps"))
        .collect()
    )
    return {series[r["series"]]: r["gaps"] for r in rows}


def _sparse_gaps(
    tables: Mapping[str, DataFrame], series: list[tuple[str, str]], zeros: list[int]
) -> dict[tuple[str, str], tuple[float, int]]:
    """Median step in days and the steps above three times it, for calendar-bounded series.

    Equal dates are collapsed, so the median position is shifted by the zero steps."""
    if not series:
        return {}
    order = Window.partitionBy("series").orderBy("moment")
    ranked = Window.partitionBy("series").orderBy("step")
    steps = (
        union_all(
            tables[t]
            .selectExpr(
                f"{i} AS series",
                f"{zeros[i]}L AS zeros",
                f"CAST({quoted(c)} AS TIMESTAMP_NTZ) AS moment",
            )
            .where("moment IS NOT NULL")
            for i, (t, c) in enumerate(series)
        )
        .distinct()
        .withColumn("previous", F.lag("moment").over(order))
        .where("previous IS NOT NULL")
        .withColumn("step", F.expr("timestampdiff(MICROSECOND, previous, moment)"))
        .withColumn("rank", F.row_number().over(ranked) - 1 + F.col("zeros"))
        .withColumn(
            "total", F.count(F.lit(1)).over(Window.partitionBy("series")) + F.col("zeros")
        )
    )
    middle = "(rank = (total - 1) div 2 OR rank = total div 2)"
    medians = steps.groupBy("series").agg(
        F.expr(
            f"sum(CASE WHEN {middle} THEN step ELSE 0 END)"
            " / CASE WHEN first(total) % 2 = 1 THEN 1 ELSE 2 END"
        ).alias("median")
    )
    rows = (
        steps.join(F.broadcast(medians), "series")  # one row per date column
        .groupBy("series", "median")
        .agg(F.count_if(F.col("step") > F.col("median") * 3).alias("gaps"))
        .collect()
    )
    return {series[r["series"]]: (r["median"] / DAY_MICROS, r["gaps"]) for r in rows}


def date_gaps(
    tables: Mapping[str, DataFrame], facts: Mapping[tuple[str, str], dict]
) -> dict[tuple[str, str], int]:
    """Gap count per date column, from typed tables and the facts n, distinct, min and max."""
    result = dict.fromkeys(facts, 0)
    daily, sparse = [], []
    for key, f in facts.items():
        n, steps = f["n"], f["n"] - 1
        if n <= K.MIN_DATES_FOR_GAPS or n - f["distinct"] > steps // 2:
            continue
        span = (f["max"] - f["min"]) / DAY
        (daily if span <= steps else sparse).append(key)
    zeros = [facts[k]["n"] - facts[k]["distinct"] for k in sparse]
    for key, (median, gaps) in _sparse_gaps(tables, sparse, zeros).items():
        if median <= K.MAX_DAILY_MEDIAN_DAYS:
            daily.append(key)
        else:
            result[key] = gaps
    return result | business_day_gaps(tables, daily)


def distinct_moments(
    tables: Mapping[str, DataFrame], series: list[tuple[str, str]]
) -> dict[tuple[str, str], dict]:
    """The facts `date_gaps` needs, for date columns that have none yet."""
    counted = (
        union_all(
            tables[t]
            .selectExpr(f"{i} AS series", f"CAST({quoted(c)} AS TIMESTAMP_NTZ) AS moment")
            .where("moment IS NOT NULL")
            for i, (t, c) in enumerate(series)
        )
        .groupBy("series", "moment")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("series")
        .agg(
            F.sum("n").alias("n"),
            F.count(F.lit(1)).alias("distinct"),
            F.min("moment").alias("min"),
            F.max("moment").alias("max"),
        )
    )
    return {series[r["series"]]: r.asDict() for r in counted.collect()}


def coverage_differences(ranges: DataFrame) -> DataFrame:
    """Compare every date column with the one of the widest range.

    `ranges` holds one row per date column: table, column, table_position, position,
    date_min, date_max. The single window below sorts those rows only."""
    order = Window.partitionBy(F.lit(1)).orderBy(
        F.desc("range_days"), F.asc("table_position"), F.asc("position")
    )
    seconds = "timestampdiff(SECOND, {}, {})"
    compared = (
        ranges.where("date_min IS NOT NULL AND date_max IS NOT NULL")
        .withColumn("range_days", F.floor(F.expr(seconds.format("date_min", "date_max")) / 86400))
        .withColumn(
            "reference",
            F.first(F.struct("table", "column", "date_min", "date_max")).over(order),
        )
        .where("NOT (`table` = reference.`table` AND `column` = reference.`column`)")
    )
    sides = []
    for side, late, start, end in (
        ("start", "date_min > reference.date_min", "reference.date_min", "date_min"),
        ("end", "date_max < reference.date_max", "date_max", "reference.date_max"),
    ):
        sides.append(
            compared.where(late).select(
                "table",
                "column",
                "table_position",
                "position",
                F.lit(side).alias("side"),
                F.floor(F.expr(seconds.format(start, end)) / 86400).alias("gap_days"),
                F.expr("date_format(%s, 'yyyy-MM-dd')" % (end if side == "start" else start))
                .alias("own_date"),
                F.expr("date_format(%s, 'yyyy-MM-dd')" % (start if side == "start" else end))
                .alias("reference_date"),
                F.col("reference.table").alias("reference_table"),
                F.col("reference.column").alias("reference_column"),
            )
        )
    return union_all(sides)
