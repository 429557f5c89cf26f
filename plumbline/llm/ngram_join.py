"""N-gram Jaccard join: near duplicates by rare-first prefix filtering with length, positional and
suffix filters, joined on prefix shingles and verified exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import (
    bit_table, discard, has_bit, join_counted, slices, small_batches, strings, written,
)
from plumbline.llm.components import components
from plumbline.llm.shingles import SHINGLE, mix, shingle_sets

PERCENT = 80
#: Share of the shingles, the ones with the smallest hashes, that the first filter counts.
PROBE = 0.3
#: In how many of its longest prefix lists a document is compared with all others.
LISTS = 3
#: Documents of one side of a comparison of two blocks.
BLOCK = 256
#: Leading bits of the shingle hash by which the suffix filter counts; columns of a matrix product.
RANGE_BITS = 4
COLUMNS = 8192

_U = np.uint64


def prefix_length(n: Column, percent: int) -> Column:
    """Two sets can only be alike if they share one of these many first shingles."""
    return n - F.floor((n * percent + 99) / 100) + 1


def _hashed(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Set hashes, offsets and a 128-bit digest of each set."""
    hashes, ends = shingle_sets(strings(batch.column("text")), size)
    n = np.diff(ends)
    digests = []
    for salt in (_U(0), _U(0x5851F42D4C957F2D)):
        sums = np.concatenate([np.zeros(1, _U), np.cumsum(mix(hashes ^ salt), dtype=_U)])
        digests.append(mix(sums[ends[1:]] - sums[ends[:-1]] + n.astype(_U)).view(np.int64))
    return hashes, ends, *digests


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            _, ends, c, d = _hashed(batch, size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(np.diff(ends)), pa.array(c), pa.array(d)], ["id", "n", "c", "d"]
            )

    return run


def _probes(size: int, share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, ends, c, _ = _hashed(batch, size)
            low = hashes < _U(int(share * 2**64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[low].view(np.int64)), pa.array(np.repeat(c, np.diff(ends))[low])], ["h", "c"]
            )

    return run


def _sets(size: int, wanted):
    """The sets of the rows whose key may be in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            maybe = has_bit(wanted.value, whole.column("key").to_numpy())
            for batch in slices(iter([whole.filter(pa.array(maybe))]), "text"):
                hashes, ends, c, _ = _hashed(batch, size)
                arrays = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(c), pa.array(np.diff(ends)), arrays], ["id", "c", "n", "hashes"]
                )

    return run


def _forest(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that hold the same nodes together, as stars: (least node, node)."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = top(x), top(y)
        up[max(x, y)] = min(x, y)
    for x in up:
        if top(x) != x:
            yield top(x), x


def _verify_block(percent: int):
    """All pairs of the documents of a block pair by their exact overlap, as matrix products."""

    def run(block: pa.Table) -> pa.Table:
        c = block.column("c").to_numpy()
        n = block.column("n").to_numpy()
        lists = block.column("hashes").combine_chunks()
        doc = np.repeat(np.arange(len(c)), np.diff(lists.offsets.to_numpy()))
        _, token, held = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
        many = held[token] > 1
        _, token = np.unique(token[many], return_inverse=True)
        doc = doc[many]
        order = np.argsort(token, kind="stable")
        doc, token = doc[order], token[order]
        shared = np.zeros((len(c), len(c)), np.float32)
        total = int(token[-1]) + 1 if len(token) else 0
        for at in range(0, total, COLUMNS):
            a, b = np.searchsorted(token, [at, at + COLUMNS])
            part = np.zeros((len(c), min(COLUMNS, total - at)), np.float32)
            part[doc[a:b], token[a:b] - at] = 1
            shared += part @ part.T
        both = shared.astype(np.int64)
        like = (100 + percent) * both >= percent * (n[:, None] + n[None, :])
        x, y = np.nonzero(np.triu(like, 1))
        found = list(_forest(c[x], c[y]))
        return pa.table(
            {
                "a": pa.array([f[0] for f in found], pa.int64()),
                "b": pa.array([f[1] for f in found], pa.int64()),
            }
        )

    return run


def _classes(sets: DataFrame) -> DataFrame:
    """Equal sets: their least id and their number."""
    known = sets.where("n > 0 AND id IS NOT NULL")
    return known.groupBy("c", "d", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))


def _candidates(rows: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Classes that may be like another one. A shingle no other class has can't be shared, so a
    class with as many of them as its prefix is long is like none. Counting only shingles with
    small hashes, in all documents alike, finds most such classes at a part of the cost."""
    probes = rows.select("text").mapInArrow(_probes(size, PROBE), "h long, c long")
    alone = (
        probes.groupBy("h")
        .agg(F.min("c").alias("c"), F.max("c").alias("other"))
        .where("c = other")
        .groupBy("c")
        .agg(F.count("*").alias("alone"))
    )
    enough = F.coalesce("alone", F.lit(0)) >= prefix_length(F.col("n"), percent)
    return classes.join(alone, "c", "left").where(~enough).select("c", "rep")


def _prefixes(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Shared shingles of each class, rarest first, and the postings of its prefix.

    A class is left out if its unique shingles fill its prefix. `alone` is the number of unique
    shingles, `place` the rank among the shared ones."""
    tokens = sets.select("c", "n", F.explode("hashes").alias("h"))
    counts = written(tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"))
    shared = (
        join_counted(tokens, counts, ["h"], "df")
        .groupBy("c", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "h")))["h"].alias("hashes"))
        .withColumn("alone", F.col("n") - F.size("hashes"))
        .withColumn("open", (prefix_length(F.col("n"), percent) - F.col("alone")).cast("int"))
        .where("open > 0")
    )
    shared = written(shared)
    discard(counts)
    postings = written(
        shared.select("c", "n", "alone", F.posexplode(F.slice("hashes", F.lit(1), F.col("open"))).alias("place", "h"))
    )
    lists = written(postings.groupBy("h").agg(F.count("*").alias("m")).where("m > 1"))
    counted = written(join_counted(postings, lists, ["h"], "m"))
    discard(postings, lists)
    return shared, counted


def _block_links(shared: DataFrame, longest: DataFrame, percent: int) -> DataFrame:
    """Links among the documents of the same list, for the few longest lists of each document.

    A list of m documents is cut into blocks of about BLOCK and each pair of blocks is a task of its
    own: a document is shipped once for each block, pairs are never rows, and no task holds more
    than two blocks. Near copies by the thousand share their longest lists and end here."""
    rows = longest.select("c", F.explode("lists").alias("list")).select("c", "list.h", "list.m")
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = (
        rows.withColumn("own", F.pmod(F.xxhash64("c", "h"), parts).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
        .select("c", "h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    )
    blocks = rows.join(shared.select("c", "n", "hashes"), "c")
    return blocks.groupBy("h", "i", "j").applyInArrow(_verify_block(percent), "a long, b long")


def _other_links(shared: DataFrame, postings: DataFrame, longest: DataFrame, percent: int) -> DataFrame:
    """Links between documents that share a prefix shingle but none of their longest lists."""
    place = F.transform("hashes", lambda h: F.shiftrightunsigned(h, 64 - RANGE_BITS).cast("int"))
    ranges = F.transform(
        F.sequence(F.lit(0), F.lit(2**RANGE_BITS - 1)), lambda r: F.size(F.filter("at", lambda p: p == r))
    )
    profile = shared.select("c", place.alias("at")).select("c", ranges.alias("ranges"))
    names = F.transform("lists", lambda x: x["h"])
    rows = postings.join(longest.select("c", names.alias("lists")), "c").join(profile, "c")
    rows = rows.withColumn("listed", F.array_contains("lists", F.col("h")))
    # two documents that both have the list among their longest were compared there: one side is unlisted
    x, y = rows.where(~F.col("listed")).alias("x"), rows.alias("y")
    nx, ny = F.col("x.n"), F.col("y.n")
    least = F.floor((percent * (nx + ny) + 99 + percent) / (100 + percent))
    after = F.least(*(F.col(f"{r}.n") - F.col(f"{r}.alone") - F.col(f"{r}.place") - 1 for r in "xy"))
    within = F.aggregate(
        F.zip_with("x.ranges", "y.ranges", lambda p, q: F.least(p, q)), F.lit(0), lambda s, v: s + v
    )
    fits = (
        (F.col("x.h") == F.col("y.h"))
        & ((F.col("x.c") < F.col("y.c")) | (F.col("y.listed") & (F.col("x.c") > F.col("y.c"))))
        & (100 * nx >= percent * ny)  # length filter
        & (100 * ny >= percent * nx)
        & (F.least("x.place", "y.place") + 1 + after >= least)  # positional filter
        & ~F.arrays_overlap("x.lists", "y.lists")
        & (within >= least)  # suffix filter: overlap by ranges of the hash
    )
    ends = (f(F.col("x.c"), F.col("y.c")).alias(name) for f, name in ((F.least, "a"), (F.greatest, "b")))
    pairs = x.join(y, fits).select(*ends).distinct()
    left = shared.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("hashes").alias("ha"))
    right = shared.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("hashes").alias("hb"))
    both = F.size(F.array_intersect("ha", "hb"))
    checked = pairs.join(left, "a").join(right, "b")
    return checked.where((100 + percent) * both >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def similar_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """`doc_id`, `n_shingles` (size of the set) and `component_id` (the least id that can be reached
    by links, itself included), one row per row of `docs`.

    Two documents are linked if their sets of `size`-word shingles have a Jaccard similarity of at
    least `percent` in a hundred. Fewer words than `size` are one shingle. Null texts and texts
    without words have no set and no link. Rows without id have no component. Rows that share
    an id are compared each by its own text.

    Equal sets are one class with one copy of the set. Classes with enough shingles of their own are
    set aside without being compared; the others are ordered rare-first by exact counts. Which rows may hold
    one of them tasks know from a table of fixed size; the join that follows is exact. Shingles
    are 64-bit hashes and classes 64-bit digests of them, so results are exact but for collisions
    (a probability below n^2 / 2^65 for n classes).
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    id_type = docs.schema[doc_id].dataType.simpleString()
    sets = written(rows.mapInArrow(_digests(size), f"id {id_type}, n long, c long, d long"))
    classes = written(_classes(sets))
    maybe = written(_candidates(rows, classes, size, percent))
    key = F.xxhash64(F.lit(9), "id").alias("key")
    wanted = spark.sparkContext.broadcast(bit_table(key, maybe.select(F.col("rep").alias("id"))))
    found = rows.where("id IS NOT NULL").select("id", "text", key).mapInArrow(
        _sets(size, wanted), f"id {id_type}, c long, n long, hashes array<long>"
    )
    held = written(found.join(maybe, "c").where("id = rep").select("c", "n", "hashes").dropDuplicates(["c"]))
    shared, postings = _prefixes(held, percent)
    by_length = F.array_sort(F.collect_list(F.struct((-F.col("m")).alias("short"), "h", "m")))
    longest = written(postings.groupBy("c").agg(F.slice(by_length, 1, LISTS).alias("lists")))
    within = written(_block_links(shared, longest, percent))
    across = written(_other_links(shared, postings, longest, percent))
    member = components(within.unionByName(across))
    discard(maybe, held, shared, postings, longest, within, across)
    linked = classes.join(member, classes["c"] == member["node"]).drop("node")
    least = linked.groupBy("component").agg(F.min("rep").alias("least"))
    least_of = linked.join(least, "component").select("c", "least")
    labelled = written(
        classes.join(least_of, "c", "left").select("c", "d", "n", F.coalesce("least", "rep").alias("component_id"), "copies")
    )
    discard(classes)
    known = F.expr("n > 0 AND id IS NOT NULL")
    grouped = join_counted(sets.where(known), labelled, ["c", "d", "n"], "copies")
    alone = sets.where(~known).withColumn("component_id", F.col("id"))
    return grouped.select("id", "n", "component_id").unionByName(alone.select("id", "n", "component_id")).select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id"
    )
