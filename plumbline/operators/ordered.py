"""Forward fill and as-of lookup over an order of the whole table.

A window without partition columns would sort a table in one task. Values are carried in two
steps instead: within a date by a window over the rows of that date, and from date to date by a
table of one row per date. The rows are shuffled once, by their date. Dates that hold more
than a thousandth of all rows, of which there are at most a thousand, are range partitioned by
the complete order (date, other columns, a running number that spreads identical rows).

The table of dates is range partitioned too, since dates may be as many as rows. Its bucket
number is written before it is used, because range bounds are sampled and a recomputation could
draw others. Each bucket is filled on its own, and the last known value of each bucket is
carried forward through a table of one row per bucket.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import orderable, ref
from plumbline.session import cut

BUCKET, RUNNING = "__bucket__", "__running__"
BROADCAST_ROWS = 1_000_000
#: A date with fewer rows than this fits one task, whatever its share.
MIN_HEAVY = 100_000


#: A line of a plan's tree that is a shuffle; names of tables and columns come later in a line.
SHUFFLE = re.compile(r"^[\s:|+\-*()\d]*(?:Exchange|ShuffleQueryStage|AQEShuffleRead)\b", re.MULTILINE)


def _has_shuffle(df: DataFrame) -> bool:
    return bool(SHUFFLE.search(df._jdf.queryExecution().executedPlan().toString()))


def bucketed(df: DataFrame, keys: list[Column], buckets: int | None = None) -> DataFrame:
    """Rows with a fixed bucket number; buckets follow each other in the order of the keys.

    The running number repeats itself when a lost task is run again, provided its input comes
    in the same sequence. Files give that, a shuffle does not, so its rows are written first."""
    if _has_shuffle(df):
        df = cut(df)
    numbered = df.withColumn(RUNNING, F.monotonically_increasing_id())
    order = [*keys, F.col(RUNNING)]
    ranged = (
        numbered.repartitionByRange(buckets, *order) if buckets else
        numbered.repartitionByRange(*order)
    )
    return cut(ranged.withColumn(BUCKET, F.spark_partition_id()))


def carry_forward(
    df: DataFrame, keys: list[Column], columns: list[str], own: bool = True
) -> DataFrame:
    """Replace nulls in the columns by the last known value before them; needs bucketed rows.
    Without `own`, every value is replaced by the last known one before its row."""
    order = [*keys, F.col(RUNNING)]
    within = Window.partitionBy(BUCKET).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if own else -1
    )
    filled = df.withColumns({c: F.last(ref(c), ignorenulls=True).over(within) for c in columns})
    # A task holds one bucket, so this grouping shuffles about one row per bucket.
    place = F.struct(*[key.alias(f"k{i}") for i, key in enumerate(order)])
    lasts = df.groupBy(BUCKET).agg(
        *[
            F.max_by(ref(c), F.when(ref(c).isNotNull(), place)).alias(f"v{i}")
            for i, c in enumerate(columns)
        ]
    )
    # one row per bucket, so this window sorts as many rows as there are partitions
    before = Window.partitionBy(F.lit(1)).orderBy(BUCKET).rowsBetween(
        Window.unboundedPreceding, -1
    )
    carried = lasts.select(
        BUCKET,
        *[
            F.last(F.col(f"v{i}"), ignorenulls=True).over(before).alias(f"carry{i}")
            for i in range(len(columns))
        ],
    )
    joined = filled.join(F.broadcast(carried), BUCKET, "left")
    return joined.select(
        *[
            F.coalesce(ref(c), F.col(f"carry{columns.index(c)}")).alias(c)
            if c in columns
            else ref(c)
            for c in df.columns
            if c not in (BUCKET, RUNNING)
        ]
    )


MOMENT, SIDE = "__moment__", "__side__"
HEAVY_DATES = 1000


def forward_fill(
    df: DataFrame,
    date: str | Column,
    columns: list[str],
    ties: list[str] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Fill nulls of the columns with the last value by date; rows without a date come last.

    Rows of one date are ordered by the tie columns, by default all others that are not
    filled, and rows that are equal in them by the filled columns. Nulls before the first value
    stay."""
    if ties is None:
        ties = [
            f.name
            for f in df.schema.fields
            if f.name not in columns and f.name != date and orderable(f.dataType)
        ]
    dated = df.withColumn(MOMENT, ref(date) if isinstance(date, str) else date)
    order = [ref(c) for c in ties]
    for c in columns:
        order += [ref(c).isNull(), ref(c)]
    place = F.struct(*[key.alias(f"k{i}") for i, key in enumerate(order)])
    # the last known value of each date, combined before the shuffle
    dates = cut(
        dated.groupBy(MOMENT).agg(
            F.count(F.lit(1)).alias("n"),
            *[
                F.max_by(ref(c), F.when(ref(c).isNotNull(), place)).alias(f"v{i}")
                for i, c in enumerate(columns)
            ],
        )
    )
    total = dates.agg(F.sum("n")).first()[0] or 0
    heavy = cut(dates.where(F.col("n") * HEAVY_DATES > total).where(f"n >= {MIN_HEAVY}").select(MOMENT))
    values = [f"v{i}" for i in range(len(columns))]
    by_date = [F.col(MOMENT).isNull(), F.col(MOMENT)]
    before = cut(
        carry_forward(bucketed(dates.drop("n"), by_date, buckets), by_date, values, own=False)
    )
    many = heavy.count() > 0

    # What is known before a date comes first in its window, so the rows need no join.
    carried = {v: c for v, c in zip(values, columns)}
    first = before.select(
        MOMENT,
        *[F.col(v).alias(c) for v, c in carried.items()],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields if f.name not in columns],
        F.lit(0).alias(SIDE),
    )
    light = dated.withColumn(SIDE, F.lit(1)).unionByName(first)
    if many:
        light = light.join(F.broadcast(heavy), light[MOMENT].eqNullSafe(heavy[MOMENT]), "left_anti")
    inside = Window.partitionBy(MOMENT).orderBy(SIDE, *order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    filled = (
        light.withColumns({c: F.last(ref(c), ignorenulls=True).over(inside) for c in columns})
        .where(f"{SIDE} = 1")
        .select(*[ref(c) for c in df.columns])
    )
    if not many:
        return filled
    hot = dated.join(F.broadcast(heavy), dated[MOMENT].eqNullSafe(heavy[MOMENT]), "left_semi")
    known = before.withColumnRenamed(MOMENT, "__date__").join(
        F.broadcast(heavy), F.col("__date__").eqNullSafe(F.col(MOMENT)), "left_semi"
    )
    # one row per heavy date
    joined = _fill_heavy(hot, by_date, order, columns, buckets).join(
        F.broadcast(known), F.col(MOMENT).eqNullSafe(F.col("__date__")), "left"
    )
    return filled.unionByName(
        joined.select(
            *[
                F.coalesce(ref(c), F.col(f"v{columns.index(c)}")).alias(c) if c in columns else ref(c)
                for c in df.columns
            ]
        )
    )


def _fill_heavy(
    hot: DataFrame, by_date: list[Column], order: list[Column], columns: list[str], buckets: int | None
) -> DataFrame:
    """Fill within dates whose rows are too many for one task: a value is carried with its date
    and taken only by rows of that date."""
    packed = hot.withColumns(
        {f"__{c}__": F.when(ref(c).isNotNull(), F.struct(F.col(MOMENT), ref(c).alias("value"))) for c in columns}
    )
    keys = [*by_date, *order]
    carried = carry_forward(bucketed(packed, keys, buckets), keys, [f"__{c}__" for c in columns])
    return carried.select(
        *[
            F.when(
                ref(f"__{c}__")[MOMENT].eqNullSafe(F.col(MOMENT)), ref(f"__{c}__")["value"]
            ).alias(c)
            if c in columns
            else ref(c)
            for c in hot.columns
        ]
    )


def asof_join(
    left: DataFrame,
    left_date: str,
    right: DataFrame,
    right_date: str,
    columns: list[str],
    buckets: int | None = None,
) -> DataFrame:
    """Add to each left row the values of the latest right row on or before its date.

    Only the distinct dates of both sides are put in order; the values found for each date are
    then joined back by equality. Right rows of one date are reduced to their greatest values
    first. A null in the latest row stays null: the date decides, not the presence of a value."""
    found = F.struct(*[F.max(ref(c)).alias(c) for c in columns])
    known = right.groupBy(ref(right_date).alias("__date__")).agg(found.alias("__found__"))
    wanted = left.select(ref(left_date).alias("__date__")).distinct()
    dates = known.where("__date__ IS NOT NULL").withColumn("__side__", F.lit(0)).unionByName(
        wanted.where("__date__ IS NOT NULL").withColumns(
            {
                "__found__": F.lit(None).cast(known.schema["__found__"].dataType),
                "__side__": F.lit(1),
            }
        )
    )
    keys = [F.col("__date__"), F.col("__side__")]
    filled = cut(
        carry_forward(bucketed(dates, keys, buckets), keys, ["__found__"])
        .where("__side__ = 1")
        .select("__date__", "__found__.*")
    )
    if filled.count() <= BROADCAST_ROWS:  # one row per date
        filled = F.broadcast(filled)
    return left.join(filled, ref(left_date) == F.col("__date__"), "left").drop("__date__")
