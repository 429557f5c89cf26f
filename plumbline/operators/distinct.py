"""Distinct counts, value counts, top values and samples.

Cells are unpivoted per physical class, so each class keeps its own compact type and reads
only its own columns. Every grouping is pre-aggregated before the shuffle, which collapses a
value held by a large share of the rows to one record per task. Rankings filter on the rank,
so Spark limits each group inside the task before shuffling.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import constants as K
from plumbline.functions import parsing as P
from plumbline.functions.columns import BOOLEAN, DATE, NUMERIC, STRING, is_float, kind_of, literal, quoted, ref
from plumbline.operators.facts import measure
from plumbline.session import pin, union_all

LONG_TEXT = 64
SLOTS = ("bigint", "double", "timestamp_ntz", "string")


def _slot(data_type: T.DataType) -> str | None:
    kind = kind_of(data_type)
    if kind == NUMERIC:
        if is_float(data_type):
            return "double"
        return "string" if isinstance(data_type, T.DecimalType) else "bigint"
    return {BOOLEAN: "string", DATE: "timestamp_ntz", STRING: "string"}.get(kind)


def cells(
    tables: Mapping[str, DataFrame], slot: str, columns: Mapping[str, Iterable[str]] | None = None
) -> DataFrame | None:
    """(key, value) for every non-null cell of the columns with this slot type.

    The key numbers the columns of all tables, so that names are not shuffled with the values;
    `named` puts them back."""
    parts, key = [], 0
    for table, df in tables.items():
        wanted = set(df.columns if columns is None else columns.get(table, ()))
        pairs = []
        for field in df.schema.fields:
            if field.name in wanted and _slot(field.dataType) == slot:
                pairs.append(f"{key}, CAST({quoted(field.name)} AS {slot})")
            key += 1
        if pairs:
            parts.append(df.selectExpr(f"stack({len(pairs)}, {', '.join(pairs)}) AS (key, value)"))
    return union_all(parts).where("value IS NOT NULL") if parts else None


def named(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Replace the key of a column by the names of table and column."""
    listing = [(table, column) for table, source in tables.items() for column in source.columns]
    names = [f"array({', '.join(literal(pair[i]) for pair in listing)})[key]" for i in (0, 1)]
    rest = [c for c in df.columns if c != "key"]
    return df.selectExpr(f"{names[0]} AS table", f"{names[1]} AS column", *rest)


def compact(value: Column) -> Column:
    """Short text as it is, long text as its SHA-256 digest (always longer than short text):
    a distinct count then shuffles at most 64 characters per value."""
    return F.when(F.length(value) < LONG_TEXT, value).otherwise(F.sha2(value, 256))


# what is asked of every text value; the answers are counted in rows, not in distinct values
TEXT_TESTS = {
    "encoding_count": P.has_control_characters,
    "date_pattern_count": P.looks_like_date,
    "date_value_count": lambda value: P.to_timestamp(value).isNotNull(),
    "number_count": lambda value: P.to_number(value).isNotNull(),
    "id_pattern_count": P.looks_like_id,
}


def _test_bits(value: Column) -> Column:
    bits = [
        F.when(test(value), F.lit(1 << i)).otherwise(F.lit(0))
        for i, test in enumerate(TEXT_TESTS.values())
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _count_values(found: DataFrame, slot: str, with_tests: bool) -> DataFrame:
    repeated = F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated_rows")
    counts = [F.count(F.lit(1)).alias("unique_count"), repeated]
    if slot != "string" or not with_tests:
        if slot == "string":
            found = found.withColumn("value", compact(F.col("value")))
        return (
            found.groupBy("key", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("key")
            .agg(*counts, *[F.lit(None).cast("bigint").alias(name) for name in TEXT_TESTS])
        )
    # Short texts are tested once per distinct value; long ones once per row, while the text
    # is still at hand, and their answers travel with the digest.
    is_long = F.length("value") >= LONG_TEXT
    values = (
        found.select(
            "key",
            compact(F.col("value")).alias("value"),
            F.when(is_long, _test_bits(F.col("value"))).alias("long_bits"),
        )
        .groupBy("key", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.max("long_bits").alias("long_bits"))
        .select(
            "key",
            "n",
            F.coalesce("long_bits", _test_bits(F.col("value"))).alias("bits"),
        )
    )
    return values.groupBy("key").agg(
        *counts,
        *[
            F.sum(F.when(F.col("bits").bitwiseAND(F.lit(1 << i)) != 0, F.col("n")).otherwise(0))
            .alias(name)
            for i, name in enumerate(TEXT_TESTS)
        ],
    )


def row_tests(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """How many rows of each text column are dates or numbers, in one aggregate per table: without
    distinct values nothing but counters is shuffled. The other counts are null."""
    names = ("date_pattern_count", "date_value_count", "number_count")
    parts = []
    for table, df in tables.items():
        text = [f.name for f in df.schema.fields if kind_of(f.dataType) == STRING]
        if not text:
            continue
        counted = df.agg(
            *[
                F.count_if(TEXT_TESTS[name](ref(c))).alias(f"{name}{i}")
                for i, c in enumerate(text)
                for name in names
            ]
        )
        rows = [
            F.struct(
                F.lit(table).alias("table"),
                F.lit(c).alias("column"),
                *[F.lit(None).cast("bigint").alias(n) for n in ("unique_count", "repeated_rows")],
                *[
                    (F.col(f"{n}{i}") if n in names else F.lit(None).cast("bigint")).alias(n)
                    for n in TEXT_TESTS
                ],
            )
            for i, c in enumerate(text)
        ]
        parts.append(counted.select(F.inline(F.array(*rows))))
    return union_all(parts) if parts else None


def distinct_counts(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, Iterable[str]] | None = None,
    with_tests: bool = False,
    slots: Iterable[str] = SLOTS,
) -> DataFrame | None:
    """Exact distinct count per column, the rows that share their value with another and,
    on request, how many rows of a text column pass each of the text tests."""
    parts = []
    for slot in slots:
        found = cells(tables, slot, columns)
        if found is not None:
            parts.append(_count_values(found, slot, with_tests))
    if not parts:
        return None
    tests = TEXT_TESTS if with_tests else ()
    return named(union_all(parts), tables).select(
        "table", "column", "unique_count", "repeated_rows", *tests
    )


def value_counts(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Iterable[str]]
) -> DataFrame:
    """The value histogram (table, column, value, n) of the named text columns."""
    text = {
        table: df.select(*[ref(c).cast("string").alias(c) for c in columns[table]])
        for table, df in tables.items()
        if columns.get(table)
    }
    counted = cells(text, "string").groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    return named(counted, text)


def top_values(counts: DataFrame, k: int = K.TOP_VALUES) -> DataFrame:
    """The k most frequent values per column, ties by value."""
    order = Window.partitionBy("table", "column").orderBy(F.desc("n"), F.asc("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


#: Counters per column of the first pass of `heavy_values`, and how many of the largest are looked into.
COUNTERS = 1 << 16
LOOKED_INTO = 64


def heavy_values(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, Iterable[str]],
    k: int = K.TOP_VALUES,
    counters: int = COUNTERS,
    looked_into: int = LOOKED_INTO,
) -> DataFrame:
    """The k most frequent values per column (table, column, rank, value, n), ties by value, without
    grouping all distinct values where that can be avoided.

    The first pass adds up the rows of a fixed number of counters, to which values are dealt by hash. The
    second counts the values of the largest counters exactly. A value of any other counter has at most the rows
    of the largest of those, so if the k-th count found is above that, nothing is missing: that is the proof.
    Only columns without proof, in which no k values stand out, have all their values grouped."""
    tables = {t: df.select(*[ref(c) for c in columns[t]]) for t, df in tables.items() if columns.get(t)}
    spark = next(iter(tables.values())).sparkSession
    proven, rest = [], {}
    parts = [(slot, found) for slot in SLOTS if (found := cells(tables, slot)) is not None]
    dealt = F.pmod(F.xxhash64("value"), F.lit(counters)).cast("int").alias("counter")
    counted = union_all(found.select("key", dealt) for _, found in parts).groupBy("key", "counter").agg(F.count("*").alias("n"))
    largest = Window.partitionBy("key").orderBy(F.desc("n"), "counter")
    rows = counted.withColumn("rank", F.row_number().over(largest)).where(F.col("rank") <= looked_into + 1).collect()
    beyond = {r["key"]: r["n"] for r in rows if r["rank"] > looked_into}
    chosen = spark.createDataFrame(
        [(r["key"], r["counter"]) for r in rows if r["rank"] <= looked_into], "key int, counter int"
    )
    order = Window.partitionBy("key").orderBy(F.desc("n"), "value")

    def top(found: DataFrame) -> DataFrame:
        counts = found.groupBy("key", "value").agg(F.count("*").alias("n"))
        ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return ranked.select("key", "rank", F.col("value").cast("string").alias("value"), "n")

    # a few counters of each column
    kept = pin(
        union_all(
            top(found.withColumn("counter", dealt).join(F.broadcast(chosen), ["key", "counter"]).drop("counter"))
            for _, found in parts
        )
    )
    last = {r["key"]: r["n"] for r in kept.where(F.col("rank") == k).select("key", "n").collect()}
    listing = [(table, c) for table, df in tables.items() for c in df.columns]
    for key, (table, column) in enumerate(listing):
        if key in beyond and last.get(key, 0) <= beyond[key]:
            rest.setdefault(table, []).append(column)
        else:
            proven.append(key)
    out = [named(kept.where(F.col("key").isin(proven)), tables)]
    if rest:
        open_tables = {t: tables[t].select(*[ref(c) for c in cs]) for t, cs in rest.items()}
        whole = [top(found) for slot in SLOTS if (found := cells(open_tables, slot)) is not None]
        out.append(named(union_all(whole), open_tables))
    return union_all(out).select("table", "column", "rank", "value", "n")


#: Groups of values whose least ones bound the k smallest; more than k.
BOUND_GROUPS = 8


def _year_first(moment: str) -> tuple[int, str]:
    year, rest = re.match(r"([+-]?\d+)-(.*)", moment).groups()
    return int(year), rest


#: The order of values of each type, given as text.
IN_ORDER = {"bigint": int, "double": float, "timestamp_ntz": _year_first, "string": str.encode}


def _bounds(tables: Mapping[str, DataFrame], columns: Mapping[str, list[str]], k: int) -> dict[tuple, str | None]:
    """A value that at least k distinct values of the column don't exceed, or None if fewer were seen.

    The values are dealt to a few groups by hash. The least of each group are different values of the column,
    so the k-th of them is a bound, whatever the order of the rows: one plain aggregate, one row per task."""
    groups = max(BOUND_GROUPS, k + k // 2)
    wanted = []
    for table, names in columns.items():
        for name in names:
            slot = _slot(tables[table].schema[name].dataType)
            value = f"CAST({quoted(name)} AS {slot})"
            least = {
                f"g{g}": f"CAST(min(CASE WHEN pmod(xxhash64({value}), {groups}) = {g} THEN {value} END) AS STRING)"
                for g in range(groups)
            }
            wanted.append((table, name, slot, least))
    # the least of numbers are found by compiled code, unless text is looked for in the same scan
    wanted.sort(key=lambda entry: entry[2] == "string")
    numbers = sum(slot != "string" for _, _, slot, _ in wanted)
    found = [row for part in (wanted[:numbers], wanted[numbers:]) for row in measure(tables, [(t, e) for t, _, _, e in part])]
    bounds = {}
    for (table, name, slot, least), row in zip(wanted, found):
        seen = sorted((row[g] for g in least if row[g] is not None), key=IN_ORDER[slot])
        bounds[table, name] = seen[k - 1] if len(seen) >= k else None
    return bounds


def smallest_values(
    tables: Mapping[str, DataFrame],
    columns: Mapping[str, Iterable[str]] | None = None,
    k: int = K.SAMPLE_VALUES,
) -> DataFrame:
    """The k smallest distinct values per column as text, ranked from 1.

    Two scans: the first gives a proven upper bound of the k-th value of every column; the second
    groups the few values up to it. Copies are combined before the shuffle, and what is shuffled doesn't grow
    with the number of values, in whatever order the rows lie."""
    wanted = {
        table: [
            f.name for f in df.schema.fields
            if _slot(f.dataType) and (columns is None or f.name in set(columns.get(table, ())))
        ]
        for table, df in tables.items()
    }
    bounds = _bounds(tables, {t: names for t, names in wanted.items() if names}, k)
    low = {}
    for table, names in wanted.items():
        kept = []
        for name in names:
            slot, bound = _slot(tables[table].schema[name].dataType), bounds[table, name]
            value = f"CAST({quoted(name)} AS {slot})"
            within = value if bound is None else f"CASE WHEN {value} <= CAST({literal(bound)} AS {slot}) THEN {value} END"
            kept.append(f"{within} AS {quoted(name)}")
        if kept:
            low[table] = tables[table].selectExpr(*kept)
    parts = []
    for slot in SLOTS:
        found = cells(low, slot)
        if found is not None:
            order = Window.partitionBy("key").orderBy("value")
            ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            parts.append(ranked.select("key", "rank", F.col("value").cast("string").alias("value")))
    if not parts:
        spark = next(iter(tables.values())).sparkSession
        return spark.createDataFrame([], "table string, column string, rank int, value string")
    return named(union_all(parts), low).select("table", "column", "rank", "value")


def smallest_texts(df: DataFrame, name: str, k: int = K.SAMPLE_VALUES) -> list[str]:
    """The k smallest distinct values of one long-text column, without shuffling the texts.

    Each round keeps the first rows of every task in value order and drops repeats; a value
    that fills a whole round is skipped by the next one, so at most k rounds are needed.
    """
    value = ref(name)
    found: list[str] = []
    rest = df.select(value.alias("value")).where(F.col("value").isNotNull())
    while len(found) < k:
        open_rows = rest if not found else rest.where(F.col("value") > F.lit(found[-1]))
        rows = open_rows.orderBy("value").limit(2 * k).collect()
        found += sorted({r["value"] for r in rows}, key=lambda v: v.encode())[: k - len(found)]
        if len(rows) < 2 * k:
            break
    return found
