"""Line dedup with DataFrame functions only: explode normalised lines, hash them, count the
documents of each hash, drop repeated lines and put the rest back by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import ascii_lower, join_counted, written

BLANKS = " \t\n\x0b\f\r"
MIN_CHARS = 10


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _row_key(text: Column) -> Column:
    """Tells rows apart that share a document id."""
    return F.xxhash64(text)


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """The positions of all lines to drop: one row per row of `docs` that loses a line, with
    `id`, `row_key` and the array `at`.

    A line is known by a 128-bit hash of its key, so two different lines are confused with a
    probability below n^2 / 2^129. The minimum and maximum document id of a hash tell whether a
    second document holds it; both combine before the shuffle, so a line of a third of all
    documents is a handful of rows.
    """
    lines = written(
        docs.where(F.col(doc_id).isNotNull() & F.col(text).isNotNull())
        .select(
            F.col(doc_id).alias("id"),
            _row_key(F.col(text)).alias("row_key"),
            F.posexplode(F.split(F.col(text), "\n", -1)).alias("at", "line"),
        )
        .withColumn("key", line_key(F.col("line")))
        .where(F.char_length("key") >= min_chars)
        .select(
            "id", "row_key", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
        )
    )
    found = written(
        lines.groupBy("h1", "h2")
        .agg(F.min("id").alias("owner"), F.max("id").alias("last"), F.count("*").alias("n"))
        .where("owner < last")
        .drop("last")
    )
    return (
        join_counted(lines, found, ["h1", "h2"], "n")
        .where("id <> owner")
        .groupBy("id", "row_key")
        .agg(F.collect_set("at").alias("at"))
    )


def dedup_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS
) -> DataFrame:
    """One row per row of `docs`: struct `row` (the row as it came), `kept` (the text that
    stays), `n_lines`, `n_dropped`.

    A key of at least `min_chars` code points that two documents hold loses its lines in all
    documents but the one with the smallest id. Rows with the same id are one document. A row
    without id is compared with nothing and keeps its lines; a null text is one empty line. A
    document that loses every line keeps an empty text.
    """
    drop = repeated_lines(docs, doc_id, text, min_chars)
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(doc_id).alias("id"),
        _row_key(F.col(text)).alias("row_key"),
        F.coalesce(F.col(text), F.lit("")).alias("content"),
    ).join(drop, ["id", "row_key"], "left")
    lines = F.split("content", "\n", -1)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("at"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    return rows.select(
        "row",
        F.when(F.col("at").isNull(), F.col("content")).otherwise(kept).alias("kept"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("at"), F.lit(0)).cast("long").alias("n_dropped"),
    )
