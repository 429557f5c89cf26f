"""Lookups by keys of which a few may hold most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.columns import ref
from plumbline.session import cut, union_all

#: Rows of a lookup table that may be broadcast.
BROADCAST_ROWS = 1_000_000
#: A key is heavy if it has more than this share of the rows; so there are at most that many.
HEAVY_KEYS = 1000


def lookup(
    df: DataFrame,
    known: DataFrame,
    pairs: list[tuple[str, str]],
    null_safe: bool = False,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Left join of rows with a table that has one row per key; pairs are (column of df, column
    of known). The columns of both stay.

    A table of at most `broadcast_rows` rows is sent to all tasks. Beyond that the rows of each key
    are counted first, combined before the shuffle: heavy keys, at most HEAVY_KEYS at any size,
    are joined by broadcast, only the rows of the others are shuffled, and rows with a null in
    their key, which match nothing, go past the join (unless nulls are equal).
    """
    known = cut(known)
    equal = [ref(a).eqNullSafe(F.col(b)) if null_safe else ref(a) == F.col(b) for a, b in pairs]
    if known.count() <= broadcast_rows:
        return df.join(F.broadcast(known), equal, "left")
    named = [ref(a).alias(f"__{b}") for a, b in pairs]
    counts = df.select(*named).groupBy(*[f"__{b}" for _, b in pairs]).agg(F.count(F.lit(1)).alias("__n"))
    counts = cut(counts)
    total = counts.agg(F.sum("__n")).first()[0] or 0
    heavy = cut(counts.where(F.col("__n") * HEAVY_KEYS > total).drop("__n"))
    same = [
        ref(a).eqNullSafe(F.col(f"__{b}")) if null_safe else ref(a) == F.col(f"__{b}") for a, b in pairs
    ]
    of_heavy = [
        F.col(f"__{b}").eqNullSafe(F.col(b)) if null_safe else F.col(f"__{b}") == F.col(b)
        for _, b in pairs
    ]
    answers = known.join(F.broadcast(heavy), of_heavy, "left_semi")
    parts = [df.join(F.broadcast(heavy), same, "left_semi").join(F.broadcast(answers), equal, "left")]
    rest = df.join(F.broadcast(heavy), same, "left_anti")
    if not null_safe:
        complete = reduce(lambda a, b: a & b, [ref(a).isNotNull() for a, _ in pairs])
        none = rest.where(~complete)
        parts.append(
            none.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema.fields])
        )
        rest = rest.where(complete)
    parts.append(rest.join(known, equal, "left"))
    return union_all(parts)
