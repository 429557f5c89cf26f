"""Exact quantiles with bounded memory.

An exact `percentile` keeps all distinct values of a column in one task. Here a wanted rank is narrowed
first: one mergeable sketch per column proposes a row of values around each rank, within the error its
size allows; one pass counts exactly how many rows lie below each of them, which proves between
which two neighbours the rank lies; and the rows between these are selected from. Three scans in all,
whatever the number of rows. Should the sketch have been off, the counts show it and the
next round starts from what they prove. The result is exact whatever the sketch returned.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.columns import quoted
from plumbline.operators.facts import measure
from plumbline.session import cut, union_all

#: Up to so many rows of an interval are put in order by one task; more are dealt out by range.
SORTED_ROWS = 1_000_000
#: Size parameter of the sketch, and three times the rank error it has for that size.
SKETCH_SIZE = 4096
MARGIN = 3 * 2.296 / SKETCH_SIZE**0.9723
#: Values proposed on either side of a rank.
STEPS = 8


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


@dataclass
class Target:
    """One wanted rank; the open interval (low, high) holds ranks [below, below + inside)."""

    table: str
    column: str
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    value: float | None = None

    @property
    def number(self) -> str:
        return f"CAST({quoted(self.column)} AS DOUBLE)"

    @property
    def interval(self) -> str:
        low = "" if self.low is None else f" AND {self.number} > {_number(self.low)}"
        high = "" if self.high is None else f" AND {self.number} < {_number(self.high)}"
        return f"{self.number} IS NOT NULL{low}{high}"


def _proposed(tables: Mapping[str, DataFrame], targets: list[Target]) -> dict[tuple, list[float]]:
    """Values around each wanted rank, from one sketch per column and interval."""
    shares: dict[tuple, set[float]] = {}
    for t in targets:
        middle = (t.rank - t.below) / t.inside
        around = {middle + MARGIN * step / STEPS for step in range(-STEPS, STEPS + 1)}
        # ranks next to each other ask for the same values
        near = (round(min(1.0, max(0.0, share)), 6) for share in around)
        shares.setdefault((t.table, t.number, t.interval), set()).update(near)
    sketches = [
        (
            table,
            {
                "found": "kll_sketch_get_quantile_double("
                f"kll_sketch_agg_double(CASE WHEN {interval} THEN {number} END, {SKETCH_SIZE}), "
                f"array({', '.join(f'{s!r}D' for s in sorted(wanted))}))"
            },
        )
        for (table, number, interval), wanted in shares.items()
    ]
    found = measure(tables, sketches)
    return {key: sorted(set(row["found"])) for key, row in zip(shares, found)}


def _narrow(tables: Mapping[str, DataFrame], targets: list[Target]) -> None:
    """One round: propose values per target by sketch, then prove by counting between which two the rank
    lies, or that it is one of them."""
    proposed = _proposed(tables, targets)
    # an entry per value, so that a scan holds a bounded number of counts, however many are proposed
    asked = [(key, value) for key, values in proposed.items() for value in values]
    entries = [
        (table, {"below": f"count_if({number} < {_number(v)})", "upto": f"count_if({number} <= {_number(v)})"})
        for (table, number, _), v in asked
    ]
    counted: dict[tuple, list[tuple[float, int, int]]] = {}
    for (key, value), found in zip(asked, measure(tables, entries)):
        counted.setdefault(key, []).append((value, found["below"], found["upto"]))
    for t in targets:
        key = (t.table, t.number, t.interval)
        top = t.below + t.inside
        for value, below, upto in counted.get(key, ()):
            if below <= t.rank < upto:
                t.value = value
                break
            if upto <= t.rank:
                t.low, t.below = value, upto
            elif below < top:
                t.high, top = value, below
                break
        t.inside = top - t.below


def _with_upto(counts: DataFrame, *keys: str) -> DataFrame:
    """How many rows of the group have a value up to each value."""
    order = Window.partitionBy(*keys).orderBy("x")
    return counts.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)))


def _ranked_by_parts(counts: DataFrame) -> DataFrame:
    """The same for intervals of any size: values are dealt out by range, each part is put in order for
    itself, and the rows of the parts before it are added."""
    dealt = cut(counts.repartitionByRange("interval", "x").withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("interval", "part").agg(F.sum("n").alias("rows"))  # one row per task
    before = Window.partitionBy("interval").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("before", F.coalesce(F.sum("rows").over(before), F.lit(0))).drop("rows")
    placed = _with_upto(dealt, "interval", "part").join(F.broadcast(offsets), ["interval", "part"])
    return placed.select("interval", "x", "n", (F.col("upto") + F.col("before")).alias("upto"))


def _select(tables: Mapping[str, DataFrame], targets: list[Target], sorted_rows: int) -> None:
    """Put the rows left inside each interval in order and read off the ranks."""
    intervals: dict[tuple, list[Target]] = {}
    for t in targets:
        intervals.setdefault((t.table, t.column, t.low, t.high), []).append(t)
    groups = list(enumerate(intervals.values()))
    parts = []
    for table in dict.fromkeys(t.table for t in targets):
        chosen = [(i, group[0]) for i, group in groups if group[0].table == table]
        narrow = tables[table].selectExpr(
            *[f"CASE WHEN {t.interval} THEN {t.number} END AS `{i}`" for i, t in chosen]
        )
        long = narrow.unpivot([], [f"`{i}`" for i, _ in chosen], "interval", "x")
        parts.append(long.where("x IS NOT NULL").selectExpr("CAST(interval AS INT)", "x"))
    counts = union_all(parts).groupBy("interval", "x").agg(F.count(F.lit(1)).alias("n"))
    if any(group[0].inside > sorted_rows for _, group in groups):
        ranked = _ranked_by_parts(counts)
    else:
        ranked = _with_upto(counts, "interval")
    ranks = [(i, t.rank - t.below) for i, group in groups for t in group]
    wanted = ranked.sparkSession.createDataFrame(
        pa.table({"interval": [r[0] for r in ranks], "local": [r[1] for r in ranks]}),
        schema="interval int, local bigint",
    )
    rows = (
        ranked.join(F.broadcast(wanted), "interval")  # at most four ranks per numeric column
        .where("upto > local AND upto - n <= local")
        .collect()
    )
    found = {(r["interval"], r["local"]): r["x"] for r in rows}
    for i, group in groups:
        for t in group:
            t.value = found[i, t.rank - t.below]


def exact_quantiles(
    tables: Mapping[str, DataFrame],
    sizes: Mapping[tuple[str, str], int],
    probabilities: tuple[float, ...] = (0.25, 0.75),
    sorted_rows: int = SORTED_ROWS,
) -> dict[tuple[str, str], list[float]]:
    """Quantiles with linear interpolation for each (table, column) with its non-null count."""
    ranks: dict[tuple[str, str, int], Target] = {}
    for (table, column), n in sizes.items():
        for p in probabilities if n else ():
            position = p * (n - 1)
            for rank in (math.floor(position), math.ceil(position)):
                ranks.setdefault((table, column, rank), Target(table, column, rank, n))
    wide = [t for t in ranks.values() if t.inside > sorted_rows]
    while wide:
        sizes_before = {id(t): t.inside for t in wide}
        _narrow(tables, wide)
        # one round leaves less than the margin of the sketch; only if it was off, another may help
        wide = [
            t for t in wide
            if t.value is None and t.inside > sorted_rows
            and sizes_before[id(t)] * MARGIN < t.inside < sizes_before[id(t)]
        ]
    left = [t for t in ranks.values() if t.value is None]
    if left:
        _select(tables, left, sorted_rows)
    result = {}
    for (table, column), n in sizes.items():
        if not n:
            continue
        values = []
        for p in probabilities:
            position = p * (n - 1)
            low = ranks[table, column, math.floor(position)].value
            high = ranks[table, column, math.ceil(position)].value
            values.append(low + (high - low) * (position - math.floor(position)))
        result[table, column] = values
    return result
