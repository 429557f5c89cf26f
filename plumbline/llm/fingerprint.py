"""Document fingerprints: a digest of the quartiles of hashed byte triplets, with a bounded
difference score."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import slices, small_batches, strings
from plumbline.llm.shingles import PIECE

#: Buckets that triplets are counted in.
BUCKETS = 256
#: Differences from here on count as unlike.
BOUND = 300
#: Odd multipliers of the three bytes of a triplet.
_MIX = (40503, 30011, 10427)


def counts(raw: bytes) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(raw) - 2, PIECE):
        b = np.frombuffer(raw, np.uint8, min(PIECE + 2, len(raw) - at), at).astype(np.uint16)
        mixed = b[:-2] * np.uint16(_MIX[0]) + b[1:-1] * np.uint16(_MIX[1]) + b[2:] * np.uint16(_MIX[2])
        mixed ^= mixed >> np.uint16(7)
        mixed *= np.uint16(_MIX[0])
        total += np.bincount(mixed >> np.uint16(8), minlength=BUCKETS)
    return total


def fingerprint(raw: bytes) -> str:
    """Hex: one byte for the length on a logarithmic scale, one for the ratios of the quartiles,
    then two bits for the quartile of each bucket. Equal texts have equal fingerprints."""
    n = counts(raw)
    q1, q2, q3 = np.sort(n)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (n > q1).astype(np.uint8) + (n > q2) + (n > q3)
    packed = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    size = min(255, round(16 * math.log2(len(raw) + 1) / 2))
    ratios = (int(15 * q1 / q3) << 4 | int(15 * q2 / q3)) if q3 else 0
    return bytes([size, ratios]).hex() + packed.astype(np.uint8).tobytes().hex()


#: Difference of two bytes that hold four quartile codes: 0, 1, 2, and 6 for opposite ends.
_codes = np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3
_apart = np.abs(_codes[:, None, :] - _codes[None, :, :])
_DIFFERENCE = np.where(_apart == 3, 6, _apart).sum(axis=2)


def difference(a: str, b: str) -> int:
    """0 for equal fingerprints. Length counts one per step of its scale above the first, the
    quartile ratios one per step."""
    x, y = np.frombuffer(bytes.fromhex(a), np.uint8), np.frombuffer(bytes.fromhex(b), np.uint8)
    size = abs(int(x[0]) - int(y[0]))
    ratio = abs((int(x[1]) >> 4) - (int(y[1]) >> 4)) + abs((int(x[1]) & 15) - (int(y[1]) & 15))
    return int(_DIFFERENCE[x[2:], y[2:]].sum()) + max(0, size - 1) + ratio


def likeness(a: str, b: str, bound: int = BOUND) -> float:
    """1 for equal fingerprints, 0 from a difference of `bound` on."""
    return 1 - min(difference(a, b), bound) / bound


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as much of the beginning of the following one."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _bucket(ids: pa.Array, cuts: np.ndarray) -> np.ndarray:
    """0 for the largest ids; rows without id go to the last bucket."""
    known = np.array(ids.is_valid())
    place = len(cuts) - np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False))
    return np.where(known, place, len(cuts)).astype(np.int32)


def _heads(cuts: np.ndarray):
    """(bucket, largest id) for each bucket of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            place = _bucket(ids, cuts)
            out = {int(k): ids.filter(pa.array(place == k)) for k in np.unique(place)}
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(out), pa.int32()), pa.array([pc.max(v).as_py() for v in out.values()], pa.int64())],
                ["bucket", "head"],
            )

    return run


def _deal(cuts: np.ndarray, guests: dict):
    """Give every row its bucket; rows with the largest id of a bucket also visit the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = pa.array([k for k in guests if k is not None], pa.int64())
        for batch in batches:
            ids = batch.column("id")
            own = pa.array(_bucket(ids, cuts))
            yield _dealt(own, pa.array(np.zeros(len(ids), bool)), batch)
            visits = pc.is_in(ids, value_set=heads)
            if None in guests:
                visits = pc.or_(pc.fill_null(visits, False), pc.is_null(ids))
            visiting = batch.filter(visits)
            if visiting.num_rows:
                to = pa.array([guests[k] for k in visiting.column("id").to_pylist()], pa.int32())
                yield _dealt(to, pa.array(np.ones(len(to), bool)), visiting)

    return run


def _dealt(bucket: pa.Array, guest: pa.Array, batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [bucket, guest, batch.column("id"), batch.column("text")], ["bucket", "guest", "id", "text"]
    )


_OUT = (
    "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(bound: int):
    def row(at, following) -> tuple:
        _, doc, text, digest = at
        changed = edited(text, following[2]).encode()
        own = fingerprint(changed)
        return (
            doc, len(text), hashlib.sha256(changed).hexdigest(), digest, own,
            likeness(digest, own, bound), likeness(digest, following[3], bound),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = None
        out: list[tuple] = []
        for batch in slices(batches, "text"):
            for bucket, guest, doc, text in zip(
                batch.column("bucket").to_pylist(),
                batch.column("guest").to_pylist(),
                batch.column("id").to_pylist(),
                strings(batch.column("text")).to_pylist(),
                strict=True,
            ):
                if pending is not None or not guest:
                    now = (bucket, doc, text, fingerprint(text.encode()))
                    if pending is not None:
                        out.append(row(pending, now))
                    pending = None if guest else now
            if out:
                yield _rows(out)
                out = []

    return run


def _rows(out: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [part.split()[0] for part in _OUT.split(", ")]
    columns = zip(*out, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bound: int = BOUND
) -> DataFrame:
    """One row per row of `docs`: id, `n_chars`, `fingerprint`, and the comparison with the next
    document by descending id (after the last the first) and with the edited text made from it.

    Documents are dealt to buckets of neighbouring ids and sorted there, so each meets the next one
    in its own task; the first document of every bucket also visits the bucket before. The cut
    points and first ids, one per shuffle partition, are all that reaches the driver. Ids are
    integers; rows that share an id are ordered by text, rows without id come last. A null text is
    empty. A single row is its own next document.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = [k / (2 * n) for k in range(1, 2 * n)]
    found = docs.select(F.percentile_approx(F.col(doc_id).cast("long"), parts, 100 * n)).first()[0]
    cuts = np.unique(np.array(found or [], dtype=np.int64))
    per_task = rows.select("id").mapInArrow(_heads(cuts), "bucket int, head long")
    heads = {r["bucket"]: r["head"] for r in per_task.groupBy("bucket").agg(F.max("head").alias("head")).collect()}
    ring = sorted(heads)
    guests = {heads[b]: ring[i - 1] for i, b in enumerate(ring)}
    dealt = rows.mapInArrow(_deal(cuts, guests), "bucket int, guest boolean, id long, text string")
    order = ["bucket", "guest", F.desc_nulls_last("id"), "text"]
    met = dealt.repartition(n, "bucket").sortWithinPartitions(*order)
    return met.mapInArrow(_compare(bound), _OUT).withColumnRenamed("id", doc_id)
