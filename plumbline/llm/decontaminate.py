"""Benchmark decontamination: one Aho-Corasick automaton over the word windows of all benchmark
items, run once over every document."""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.llm.common import slices, small_batches, strings, with_text
from plumbline.session import union_all

WINDOW = 10
#: Bytes of benchmark text in one automaton; a larger benchmark is scanned in blocks of it.
BLOCK_BYTES = 256 << 10

#: A-Z lower-cased, digits, a-z and everything beyond ASCII as they are, all else a blank. Byte by
#: byte, so offsets stay those of the original text.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def windows(text: str, size: int = WINDOW) -> set[bytes]:
    """The windows of an item: `size` consecutive words, or all words if there are fewer."""
    found = words(text)
    if not found:
        return set()
    return {b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def automaton(items: Iterable[tuple[object, str]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Bytes are kept as the 256 first code points: the automaton then counts in bytes."""
    of: dict[bytes, list] = defaultdict(list)
    for item, text in items:
        for window in windows(text or "", size):
            of[window].append(str(item))
    machine = ahocorasick.Automaton()
    for window, names in of.items():
        key = f" {window.decode('latin-1')} "
        machine.add_word(key, (len(key), tuple(names)))
    machine.make_automaton()
    return machine


def scan(machine: ahocorasick.Automaton, text: str) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit stretches as (first word, end) and the items that occur."""
    found = words(text)
    if not found or not len(machine):
        return len(found), [], set()
    joined = f" {b' '.join(found).decode('latin-1')} "
    stretches: list[list[int]] = []
    items: set[str] = set()
    for last, (length, names) in machine.iter(joined):
        start, end = last + 1 - length, last + 1
        items.update(names)
        while stretches and start < stretches[-1][1]:  # a shared blank makes two windows one stretch
            start = min(start, stretches.pop()[0])
        stretches.append([start, end])
    if not stretches:
        return len(found), [], items
    hits, word, before = [], 0, 0
    for start, end in stretches:
        word += joined.count(" ", before, start)
        inside = joined.count(" ", start, end) - 1
        hits.append((word, word + inside))
        before, word = end, word + inside + 1
    return len(found), hits, items


def spans(text: str, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Hit stretches as offsets in code points of the original text."""
    if not hits:
        return []
    raw = text.encode()
    at = [m.span() for m in _WORD.finditer(raw.translate(_FOLD))]
    chars = lambda end: len(raw[:end].decode())
    return [(chars(at[a][0]), chars(at[b - 1][1])) for a, b in hits]


_PAIR = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_FOUND = "n_words long, hits array<struct<start:int,end:int>>, items array<string>, spans array<struct<start:int,end:int>>"
_machines: dict[str, ahocorasick.Automaton] = {}


def _scan_with(block, size: int, keep: list[str], only_hits: bool, text: str):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _machines:  # once for all tasks of a worker
            _machines.clear()
            _machines[name] = automaton(block.value, size)
        machine = _machines[name]
        given = with_text(batches, text) if "row" in keep else batches
        for batch in slices(given, "text"):
            texts = strings(batch.column("text")).to_pylist()
            found = [scan(machine, content) for content in texts]
            pairs = lambda part: [{"start": a, "end": b} for a, b in part]
            out = pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in keep),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([pairs(hits) for _, hits, _ in found], pa.list_(_PAIR)),
                    pa.array([sorted(items) for _, _, items in found], pa.list_(pa.string())),
                    pa.array(
                        [pairs(spans(t, f[1])) for t, f in zip(texts, found, strict=True)],
                        pa.list_(_PAIR),
                    ),
                ],
                [*keep, "n_words", "hits", "items", "spans"],
            )
            yield out.filter(pa.array([bool(f[1]) for f in found])) if only_hits else out

    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str, limit: int) -> Iterator[list]:
    """The items in blocks of about `limit` bytes; the driver holds one block at a time."""
    items = benchmark.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // limit) or 1
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64(F.col("item").cast("string")), F.lit(n)) == k)
        yield [tuple(r) for r in part.collect()]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of `docs`: struct `row`, `n_words`, `n_hit`, `items` (ids as sorted strings)
    and `spans` (hit stretches as code point offsets of the text).

    The benchmark goes to the workers by broadcast in blocks of about `block_bytes`, whatever its
    size. With one block, the usual case, the documents are read once and nothing is shuffled;
    with more, each block is scanned for and only the rows with hits are shuffled to be merged.
    Null texts and texts without words have no hit; items without words or id never occur.
    """
    spark = docs.sparkSession
    small_batches(spark)
    blocks = [
        spark.sparkContext.broadcast(block)
        for block in _blocks(benchmark, item_id, item_text, block_bytes)
    ]
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("row_key"),
        F.col(text).alias("text"),
    )
    def scanned(block, keep: list[str], only_hits: bool) -> DataFrame:
        part = rows.select(*keep) if "row" in keep else rows.select(*keep, "text")
        schema = StructType([*part.select(*keep).schema, *StructType.fromDDL(_FOUND)])
        return part.mapInArrow(_scan_with(block, size, keep, only_hits, text), schema)

    if len(blocks) == 1:
        found = scanned(blocks[0], ["row"], False)
    else:
        key = ["id", "row_key"]
        hits = union_all([scanned(block, key, True) for block in blocks])
        merged = hits.groupBy(*key).agg(
            *(F.flatten(F.collect_set(c)).alias(c) for c in ("hits", "items", "spans"))
        )
        counted = scanned(spark.sparkContext.broadcast([]), ["row", *key], False)
        same = [counted[c].eqNullSafe(merged[c]) for c in key]
        found = counted.select("row", "n_words", *key).join(merged, same, "left")
    words_hit = F.array_distinct(
        F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["end"] - 1)))
    )
    n_hit = F.when(F.size("hits") > 0, F.size(words_hit)).otherwise(0)
    return found.select(
        "row",
        "n_words",
        n_hit.cast("long").alias("n_hit"),
        F.coalesce(F.array_sort(F.array_distinct("items")), F.array().cast("array<string>")).alias("items"),
        F.coalesce(F.array_sort(F.array_distinct("spans")), F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
    )
