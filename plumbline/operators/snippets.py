"""The first rows behind a finding, in an explicit order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline import constants as K
from plumbline.functions.columns import kinds, literal, orderable, quoted, ref

DISPLAY_DATE_CHARS = 10


def _displayed(df: DataFrame) -> str:
    """A row as a map of text; dates are cut to the day."""
    column_kinds = kinds(df)
    entries = []
    for name in df.columns:
        text = f"CAST({quoted(name)} AS STRING)"
        if column_kinds[name] == "date":
            text = f"substring({text}, 1, {DISPLAY_DATE_CHARS})"
        entries.append(f"{literal(name)}, {text}")
    return f"map({', '.join(entries)})"


def first_rows(
    df: DataFrame, conditions: dict[int, str], k: int = K.SNIPPET_ROWS
) -> DataFrame:
    """(entry, row map) of the first k rows for each condition, all in one scan.

    A row is emitted once per condition it meets, and the rank filter limits each condition
    inside the task, so at most k rows per task and condition are shuffled."""
    met = ", ".join(f"CASE WHEN {c} THEN {i} END" for i, c in conditions.items())
    order = [
        ref(f.name).asc_nulls_last() for f in df.schema.fields if orderable(f.dataType)
    ]
    ranked = Window.partitionBy("__entry__").orderBy(*order)
    return (
        df.selectExpr("*", f"explode(array_compact(array({met}))) AS __entry__")
        .withColumn("__rank__", F.row_number().over(ranked))
        .where(F.col("__rank__") <= k)
        .selectExpr("__entry__ AS entry", "__rank__ AS rank", f"{_displayed(df)} AS row")
    )


def first_copies(groups: DataFrame, entry: int, columns: list[str], k: int = K.SNIPPET_ROWS):
    """The first k rows of duplicate groups, each group standing for n equal rows."""
    df = groups.select(*[ref(c) for c in columns])
    order = [ref(f.name).asc_nulls_last() for f in df.schema.fields if orderable(f.dataType)]
    first = groups.orderBy(*order).limit(k)  # k groups hold at least k rows
    copies = first.selectExpr("*", f"explode(sequence(1, CAST(least(n, {k}) AS INT))) AS __copy__")
    ranked = Window.partitionBy(F.lit(1)).orderBy(*order, "__copy__")  # at most k * k rows
    return (
        copies.withColumn("__rank__", F.row_number().over(ranked))
        .where(F.col("__rank__") <= k)
        .selectExpr(f"{entry} AS entry", "__rank__ AS rank", f"{_displayed(df)} AS row")
    )
