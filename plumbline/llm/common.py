"""Small helpers the operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Python workers look at no more text than this at a time (a longer single text is one slice).
SLICE_BYTES = 1 << 20
#: Rows Spark hands to a Python worker at once; whole texts travel in them.
BATCH_ROWS = 1000
#: Shuffle files of a written table go when it is complete; nothing reads them again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A key is heavy if it has more than this share of all rows, so there are at most HEAVY_KEYS of them.
HEAVY_KEYS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other letter as it is."""
    return F.translate(text, UPPER, LOWER)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Drop the shuffle files of what is written in here as soon as it is complete."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def fresh_path(spark: SparkSession) -> str:
    """A folder of its own below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/plumbline-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it from there:
    it survives lost executors and is computed once."""
    spark = df.sparkSession
    path = fresh_path(spark)
    with shuffles_dropped(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again."""
    for df in tables:
        remove(df.sparkSession, df.written_to)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows a Python worker holds at once; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.StringArray:
    """One string array without nulls (null becomes empty) that starts at offset 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def with_text(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches whose struct column `row` holds the text, with the text as a column `text`."""
    for batch in batches:
        column = pc.struct_field(batch.column("row"), text)
        yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "text"])


def slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each piece holds about SLICE_BYTES of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes, dtype=np.int64) // SLICE_BYTES
        starts = np.flatnonzero(np.diff(piece, prepend=-1))
        for start, end in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, end - start)
    pa.default_memory_pool().release_unused()  # a worker waits for its next task


def join_counted(rows: DataFrame, found: DataFrame, keys: list[str], n: str) -> DataFrame:
    """Inner join of `rows` with `found`, which has one row per key and in `n` the number of
    rows that carry it.

    Keys with more than 1 / HEAVY_KEYS of all rows are joined by broadcast: there are at most
    HEAVY_KEYS of them at any size. Only the rows of the other keys are shuffled, so no task
    gets more than its share. Both inputs must be cheap to read again (written tables).
    """
    total = rows.count()
    heavy = found.where(F.col(n) * HEAVY_KEYS > total).withColumn("__heavy__", F.lit(True))
    light = found.where(F.col(n) * HEAVY_KEYS <= total)
    flagged = rows.join(F.broadcast(heavy), keys, "left")
    hot = flagged.where("__heavy__").drop("__heavy__")
    rest = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti").join(light, keys)
    return hot.select(*rest.columns).unionByName(rest)


#: Bits of a table of keys that all tasks get: 4 MB, whatever the number of keys.
TABLE_BITS = 25


def bit_table(keys: Column, rows: DataFrame) -> bytes:
    """One bit for each key of 64 bits that is a hash. A key without a bit isn't among them; one with a bit
    may be. Where the table fills up it tells less, and what is decided by it must be checked."""
    slot = F.shiftrightunsigned(keys, 64 - TABLE_BITS).alias("slot")
    blocks = (
        rows.select(slot)
        .selectExpr("cast(slot div 64 as int) AS at", "shiftleft(1L, cast(slot % 64 as int)) AS bits")
        .groupBy("at")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[blocks.column("at").to_numpy()] = blocks.column("bits").to_numpy()
    return table.tobytes()


def has_bit(table: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be among those of the table."""
    slot = keys.view(np.uint64) >> np.uint64(64 - TABLE_BITS)
    bits = np.frombuffer(table, np.uint8)[slot >> np.uint64(3)]
    return (bits >> (slot & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
