"""Vector code compression: product codes from Ball k-means in whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import discard, join_counted, written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Whole numbers beyond this are cut to it, so that every distance and every sum is exact.
LARGEST = 1 << 25
#: Points whose distances to all candidates of a ring are held at once.
RING_ROWS = 1 << 12


@dataclass
class Codebooks:
    """`entries[p]` holds the entries of part p as rows of whole numbers. `reach[p]` bounds, for each entry, the
    squared distance to the parts assigned to it before it moved; None if nothing is assigned yet."""

    entries: np.ndarray
    reach: np.ndarray | None = None

    def sha256(self) -> str:
        """Digest of all components in decimal digits by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _vectors(batch: pa.RecordBatch, width: int | None, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are kept, and their vectors in whole numbers. Rows of another width than `width` go."""
    column = batch.column("vector")
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    numbers = pc.fill_null(flat.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    wrong = np.concatenate([[0], np.cumsum(~np.isfinite(numbers))])
    begins, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    keep = (wrong[begins] == wrong[ends]) & ~column.is_null().to_numpy(zero_copy_only=False) & (sizes > 0)
    if width is None:
        return keep, np.zeros((0, 0), np.int64)
    keep &= sizes == width
    at = begins[keep][:, None] + np.arange(width)
    whole = np.clip(np.floor(numbers[at] * scale), -LARGEST, LARGEST)
    return keep, whole.astype(np.int64)


def _finite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield batch.filter(pa.array(_vectors(batch, None, 1)[0]))


def _least(rows: DataFrame, count: int) -> pa.Table:
    """The vectors of the least ids; rows without id come last."""
    kept = rows.select("id", "vector").mapInArrow(_finite, rows.select("id", "vector").schema)
    return kept.orderBy(F.asc_nulls_last("id"), "vector").limit(count).toArrow()


def _start(rows: DataFrame, parts: int, count: int, scale: int) -> Codebooks | None:
    """The first codebooks: each part of the vectors with the least ids, at most `count` rows."""
    kept = _least(rows, count)
    if not kept.num_rows:
        return None
    widths = pc.list_value_length(kept.column("vector")).to_pylist()
    if widths[0] % parts:
        raise ValueError(f"vectors of {widths[0]} components can't be cut into {parts} equal parts")
    if set(widths) != {widths[0]}:
        kept = _least(rows.where(F.size("vector") == widths[0]), count)
    known = kept.filter(pc.is_valid(kept.column("id")))
    batch = (known if known.num_rows else kept).combine_chunks().to_batches()[0]
    vectors = _vectors(batch, widths[0], scale)[1]
    return Codebooks(vectors.reshape(len(vectors), parts, -1).transpose(1, 0, 2))


class _Balls:
    """The entries of one part as balls. Only entries that are closer to a ball's centre than twice its
    radius can take something from it: its neighbours, the nearest first."""

    def __init__(self, entries: np.ndarray, reach: np.ndarray):
        self.entries = entries
        apart = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(2)
        np.fill_diagonal(apart, -1)  # an entry itself comes first
        self.order = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.apart = np.take_along_axis(apart, self.order, axis=1)
        self.neighbours = (self.apart <= 4 * reach[:, None]).sum(1)

    def assign(self, points: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each point (ties to the lower index) and its squared distance, from the
        entry the point had before."""
        nearest = before.copy()
        distance = ((points - self.entries[before]) ** 2).sum(1)
        order = np.argsort(before, kind="stable")
        starts = np.searchsorted(before[order], np.arange(len(self.entries) + 1))
        for entry in np.flatnonzero(np.diff(starts)):
            ball = order[starts[entry] : starts[entry + 1]]
            near = self.apart[entry, : self.neighbours[entry]]
            # an entry at least as close as this one is at most twice as far from it as the point is
            ring = np.searchsorted(near, 4 * distance[ball], side="right")
            moving = ball[ring > 0]  # all others lie in the stable core
            ring, low = ring[ring > 0], 0
            while low < len(near) and len(moving):
                high = min(len(near), max(4, 2 * low))
                inside = (ring > low) & (ring <= high)
                self._ring(points, moving[inside], entry, self.order[entry, :high], nearest, distance)
                moving, ring, low = moving[~inside], ring[~inside], high
        return nearest, distance

    def _ring(self, points, at, entry, candidates, nearest, distance) -> None:
        """Points of a ring against its candidates."""
        chosen = np.append(candidates, entry)
        chosen.sort()  # the first of equal distances is the lowest index
        for a in range(0, len(at), RING_ROWS):
            some = at[a : a + RING_ROWS]
            to = ((points[some][:, None, :] - self.entries[chosen][None, :, :]) ** 2).sum(2)
            best = to.argmin(1)
            nearest[some], distance[some] = chosen[best], to[np.arange(len(some)), best]


def _nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of all entries, for points that had none before."""
    nearest, distance = np.zeros(len(points), np.int64), np.zeros(len(points), np.int64)
    for a in range(0, len(points), RING_ROWS):
        to = ((points[a : a + RING_ROWS, None, :] - entries[None, :, :]) ** 2).sum(2)
        nearest[a : a + RING_ROWS], distance[a : a + RING_ROWS] = to.argmin(1), to.min(1)
    return nearest, distance


def _assign(books: Codebooks, balls: list[_Balls] | None, vectors: np.ndarray, before: np.ndarray | None):
    parts = len(books.entries)
    points = vectors.reshape(len(vectors), parts, -1)
    codes, errors = np.zeros((len(vectors), parts), np.int64), np.zeros((len(vectors), parts), np.int64)
    for p in range(parts):
        part = np.ascontiguousarray(points[:, p])
        found = _nearest(part, books.entries[p]) if balls is None else balls[p].assign(part, before[:, p])
        codes[:, p], errors[:, p] = found
    return points, codes, errors


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1), kind))


class _Sums:
    """Sums, counts and farthest distances of all entries over one task."""

    def __init__(self, entries: np.ndarray):
        self.sums = np.zeros(entries.shape, np.int64)
        self.counts, self.far = np.zeros(entries.shape[:2], np.int64), np.zeros(entries.shape[:2], np.int64)

    def add(self, points: np.ndarray, codes: np.ndarray, errors: np.ndarray) -> None:
        for p in range(codes.shape[1]):
            order = np.argsort(codes[:, p], kind="stable")
            used, starts = np.unique(codes[order, p], return_index=True)
            self.sums[p, used] += np.add.reduceat(points[order, p], starts)
            self.counts[p, used] += np.diff(np.append(starts, len(order)))
            self.far[p, used] = np.maximum(self.far[p, used], np.maximum.reduceat(errors[order, p], starts))

    def rows(self) -> tuple[np.ndarray, ...]:
        p, e = np.nonzero(self.counts)
        return p, e, self.counts[p, e], self.far[p, e], self.sums[p, e]


def _round(books: Codebooks, scale: int, kept: pa.Schema, first: bool, last: bool):
    """One pass over the vectors: assign, and hand on the rows and, but for the last, one row of sums for each
    entry of the task."""
    width = books.entries.shape[0] * books.entries.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = None if first else [_Balls(*pair) for pair in zip(books.entries, books.reach, strict=True)]
        totals = _Sums(books.entries)
        for batch in batches:
            if not batch.num_rows:
                continue
            if first:
                keep, vectors = _vectors(batch, width, scale)
                rows, before = batch.column("row").filter(pa.array(keep)), None
            else:
                rows = batch.column("row")
                vectors = batch.column("vector").flatten().to_numpy().reshape(-1, width).astype(np.int64)
                before = batch.column("code").flatten().to_numpy().reshape(len(rows), -1).astype(np.int64)
            if not len(rows):
                continue
            points, codes, errors = _assign(books, balls, vectors, before)
            out = {"row": rows, "code": _lists(codes, pa.int32())}
            if last:
                out["error"] = pa.array(errors.sum(1))
            else:
                totals.add(points, codes, errors)
                out["vector"] = _lists(vectors, pa.int32())
            yield _batch(kept, out, len(rows))
        if not last:
            p, e, count, far, sums = totals.rows()
            out = {"part": pa.array(p, pa.int32()), "entry": pa.array(e, pa.int32()), "count": pa.array(count)}
            yield _batch(kept, out | {"far": pa.array(far), "sums": _lists(sums, pa.int64())}, len(p))

    return run


def _batch(schema: pa.Schema, columns: dict, n: int) -> pa.RecordBatch:
    """A batch of some columns of the schema; the others are null."""
    return pa.RecordBatch.from_arrays(
        [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in schema], schema.names
    )


def _moved(books: Codebooks, passed: DataFrame) -> Codebooks:
    """Entries at the mean (rounded down) of what is assigned to them, and how far that can be from the new
    place: the farthest distance before plus the way the entry moved."""
    size = books.entries.shape[2]
    totals = [F.sum(F.col("sums")[j].cast("decimal(38,0)")).alias(f"s{j}") for j in range(size)]
    found = (
        passed.where("part IS NOT NULL")
        .groupBy("part", "entry")
        .agg(F.sum("count").alias("n"), F.max("far").alias("far"), *totals)
        .collect()  # one row for each entry: parts * entries
    )
    entries, reach = books.entries.copy(), np.zeros(books.entries.shape[:2], np.int64)
    for row in found:
        place = row["part"], row["entry"]
        entries[place] = [int(row[f"s{j}"]) // row["n"] for j in range(size)]
        step = int(((entries[place] - books.entries[place]) ** 2).sum())
        reach[place] = (isqrt(row["far"]) + isqrt(step) + 2) ** 2
    return Codebooks(entries, reach)


def compress(
    vectors: DataFrame,
    vector: str = "embedding",
    vec_id: str = "vec_id",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> tuple[DataFrame, Codebooks | None]:
    """A product code for every vector: `row` (the other columns), `code` (an entry for each part) and `error` (the
    squared distances to those entries, added up), and the codebooks (None without vectors).

    A component x counts as floor(scale * x). Rows whose vector is null or empty, or holds a null or a number
    that is not finite, go; so do vectors that are not as long as the one with the least id, and
    numbers beyond LARGEST count as LARGEST. Each part's codebook starts with the vectors of the least
    ids, at most `entries` rows (ties in order of their vectors; repeated rows count each; rows without id
    take part in everything else, and start the codebooks only if there are no ids). In each round all parts
    go to their nearest entry, ties to the lower index, and each used entry moves to their mean, rounded
    down. At last they are assigned again.

    The method is Ball k-means. An entry is a ball whose radius bounds the distance of its parts: the
    farthest one seen before the entry moved plus the way it moved. Only neighbours, entries closer
    to the centre than twice the radius, are looked at; a part closer to the centre than half way to the first of
    them lies in the stable core and stays; each ring beyond restricts the candidates of its parts.
    Comparisons are of whole numbers, so the codes are those of the plain method. Each pass writes the
    vectors with their codes for the next one; a task adds one row for each entry with sums, count and radius.
    """
    names = [name for name in vectors.columns if name != vector]
    rows = vectors.select(
        F.struct(*(F.col(f"`{name}`") for name in names)).alias("row"),
        F.col(vec_id).alias("id"),
        F.col(vector).alias("vector"),
    )
    row = rows.schema["row"].dataType.simpleString()
    books = _start(rows, parts, entries, scale)
    result = "row {row}, code array<int>, error long".format(row=row)
    if books is None:
        return vectors.sparkSession.createDataFrame([], result), None
    at = rows.select("row", "vector")
    passing = f"row {row}, vector array<int>, code array<int>, part int, entry int, count long, far long, sums array<long>"
    before = None
    for turn in range(rounds + 1):
        last = turn == rounds
        schema = result if last else passing
        arrow = _arrow_schema(vectors.sparkSession, schema)
        found = written(at.mapInArrow(_round(books, scale, arrow, turn == 0, last), schema))
        if before is not None:
            discard(before)
        if last:
            return found, books
        books, before = _moved(books, found), found
        at = found.where("part IS NULL").select("row", "vector", "code")


def _arrow_schema(spark, schema: str) -> pa.Schema:
    return spark.createDataFrame([], schema).toArrow().schema


def hex_code(code: str = "code"):
    """Two hexadecimal digits for each part."""
    return F.lower(F.array_join(F.transform(code, lambda e: F.lpad(F.hex(e.cast("long")), 2, "0")), ""))


def summed_over(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """`rows` with the sum of a column over all rows of equal keys, nulls together, as one more column. Keys
    with many rows are joined by broadcast; all but the sums stay where they are for them."""
    null, text = "__null__", "__key__"
    keyed = rows.select("*", F.col(key).isNull().alias(null), F.coalesce(F.col(key).cast("string"), F.lit("")).alias(text))
    sums = keyed.groupBy(null, text).agg(F.sum(value).alias(name), F.count("*").alias("__n__"))
    found = join_counted(keyed, sums, [null, text], "__n__")
    return reduce(DataFrame.drop, (null, text, "__n__"), found)
