"""Phrase collocation mining: phrases counted in burst tries of word ids and scored by their weakest cut."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import discard, slices, small_batches, strings, written
from plumbline.llm.shingles import mix, text_bytes, word_spans
from plumbline.session import union_all

LONGEST = 3
LEAST = 10
COVER = 50
TOP = 2000
UNKNOWN = "und"
#: Entries of a container that becomes a node with a container for each next word.
BURST = 1 << 12
#: Phrases a task holds before it spills its largest subtrees, until an eighth is left.
SPILL = 1 << 20
#: Spilled runs are cut into parts by the first two words of the phrase.
PARTS = 1 << 16
#: Parts of a language that are ranked for themselves; their best are ranked together.
RANK_PARTS = 16
#: Bits of the table of frequent phrases that tasks get: 4 MB at every size.
TABLE_BITS = 25
#: Further seeds that are tried if two words get the same id.
SEEDS = 4

_U = np.uint64
_STOP = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_BREAK = _STOP | np.isin(np.arange(256), [0x20, 0x09])
_FACTOR = mix(np.arange(1, 65, dtype=_U)) | _U(1)


class Node(dict):
    """The subtrees of a trie by their next word id. Every other dict is a container, which holds the
    counts of phrases by what is left of them: an id, or a tuple of ids."""


class HatTrie:
    """Counts of phrases of `depth` word ids. A container that outgrows `burst` entries becomes a node."""

    def __init__(self, depth: int, burst: int = BURST):
        self.depth, self.burst, self.entries = depth, burst, 0
        self.root: dict = {}

    def add(self, columns: list[list[int]], counts: list[int]) -> None:
        """Add phrases in ascending order: a list of ids for each place."""
        self.root = self._add(self.root, columns, counts)

    def _add(self, tree: dict, columns: list[list[int]], counts: list[int]) -> dict:
        if isinstance(tree, Node) and len(columns) == 2:  # containers of single ids never burst
            head, box, new = None, {}, 0
            for word, key, n in zip(*columns, counts, strict=True):
                if word != head:
                    head, box = word, tree.setdefault(word, {})
                if key in box:
                    box[key] += n
                else:
                    box[key] = n
                    new += 1
            self.entries += new
            return tree
        if isinstance(tree, Node):
            first, at = columns[0], 0
            while at < len(first):
                end = bisect_right(first, first[at], at)
                rest = [column[at:end] for column in columns[1:]]
                tree[first[at]] = self._add(tree.get(first[at], {}), rest, counts[at:end])
                at = end
            return tree
        before = len(tree)
        for key, n in zip(columns[0] if len(columns) == 1 else zip(*columns, strict=True), counts, strict=True):
            tree[key] = tree.get(key, 0) + n
        self.entries += len(tree) - before
        if len(columns) > 1 and len(tree) > self.burst:
            node = Node()
            for key, n in tree.items():
                node.setdefault(key[0], {})[key[1] if len(key) == 2 else key[1:]] = n
            return node
        return tree

    def spill(self, left: int) -> tuple[list[np.ndarray], np.ndarray]:
        """Take whole subtrees out, the largest first, until `left` entries are left."""
        if not isinstance(self.root, Node) or left == 0:
            out, self.root, self.entries = _flat(self.root, self.depth), {}, 0
            return out
        taken = Node()
        for size, word in sorted(((_size(tree), word) for word, tree in self.root.items()), reverse=True):
            if self.entries <= left:
                break
            taken[word] = self.root.pop(word)
            self.entries -= size
        return _flat(taken, self.depth)


def _size(tree: dict) -> int:
    return sum(map(_size, tree.values())) if isinstance(tree, Node) else len(tree)


def _flat(tree: dict, depth: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The phrases of a subtree as one array of ids for each place, and their counts."""
    if not tree:
        return [np.zeros(0, _U)] * depth, np.zeros(0, np.int64)
    if not isinstance(tree, Node):
        counts = np.fromiter(tree.values(), np.int64, len(tree))
        if depth == 1:
            return [np.fromiter(tree, _U, len(tree))], counts
        ids = np.fromiter(chain.from_iterable(tree), _U, len(tree) * depth)
        return list(ids.reshape(-1, depth).T), counts
    if depth == 2:  # all subtrees are containers of single ids
        sizes = [len(box) for box in tree.values()]
        heads = np.repeat(np.fromiter(tree, _U, len(tree)), sizes)
        rest = np.fromiter(chain.from_iterable(tree.values()), _U, len(heads))
        counts = np.fromiter(chain.from_iterable(box.values() for box in tree.values()), np.int64, len(heads))
        return [heads, rest], counts
    parts = [_flat(child, depth - 1) for child in tree.values()]
    heads = np.repeat(np.fromiter(tree, _U, len(tree)), [len(counts) for _, counts in parts])
    columns = [np.concatenate([ids[place] for ids, _ in parts]) for place in range(depth - 1)]
    return [heads, *columns], np.concatenate([counts for _, counts in parts])


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    total = np.zeros(len(columns[0]), _U)
    for place, ids in enumerate(columns):
        total += ids * _FACTOR[place]
    return mix(total)


def _slot(columns: list[np.ndarray]) -> np.ndarray:
    """The bit that a phrase has in the table of frequent phrases."""
    return _mixed(columns) >> _U(64 - TABLE_BITS)


def _seed(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed} {lang}".encode(), digest_size=8).digest(), "little")


class _Words:
    """The words of a batch: where they are, their ids, and whether each follows the one before in its piece.
    The id of a word is a hash of the word and its language."""

    def __init__(self, batch: pa.RecordBatch, seed: int):
        self.raw, ends = text_bytes(strings(batch.column("text")))
        self.begins, self.lengths, hashes = word_spans(self.raw, ends, _BREAK)
        doc = np.searchsorted(ends, self.begins, side="right") - 1
        langs = pc.fill_null(batch.column("lang").cast(pa.large_string()), UNKNOWN).dictionary_encode()
        self.langs, self.lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()[doc]
        seeds = np.array([_seed(lang, seed) for lang in self.langs], _U)
        self.ids = mix(hashes ^ seeds[self.lang]) if len(doc) else hashes
        piece = np.searchsorted(np.flatnonzero(_STOP[self.raw]), self.begins)
        self.follows = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])

    def text(self, at: int) -> str:
        begin = self.begins[at]
        word = self.raw[begin : begin + self.lengths[at]].tobytes()
        return word.lower().decode("utf-8", "replace")  # bytes: A-Z only


def _vocabulary(seed: int, limit: int):
    """Occurrences of every word: one row for each word of a spilled container."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, names = HatTrie(1), {}

        def spilled() -> pa.RecordBatch:
            (ids,), counts = trie.spill(0)
            known = [names[key] for key in ids.tolist()]
            names.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids.view(np.int64)),
                    pa.array([lang for lang, _ in known], pa.string()),
                    pa.array([word for _, word in known], pa.string()),
                    pa.array(counts),
                ],
                ["id", "lang", "word", "n"],
            )

        for batch in slices(batches, "text"):
            words = _Words(batch, seed)
            ids, first, counts = np.unique(words.ids, return_index=True, return_counts=True)
            keys = ids.tolist()
            for key, at in zip(keys, first.tolist(), strict=True):
                if key not in names:
                    names[key] = words.langs[words.lang[at]], words.text(at)
            trie.add([keys], counts.tolist())
            if trie.entries > limit:
                yield spilled()
        yield spilled()

    return run


def _run(columns: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
    """A spilled run in order: a row for each part, its phrases as lists."""
    part = _mixed(columns[:2]) % _U(PARTS)
    order = np.lexsort([*columns[::-1], part])
    part = part[order]
    starts = np.flatnonzero(np.diff(part, prepend=_U(PARTS)))
    ends = pa.array(np.append(starts, len(part)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(ends, pa.array(ids[order].view(np.int64))) for ids in columns]
    lists.append(pa.ListArray.from_arrays(ends, pa.array(counts[order])))
    names = [*_names(len(columns)), "n"]
    return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), *lists], ["part", *names])


def _names(depth: int) -> list[str]:
    return [f"w{place}" for place in range(1, depth + 1)]


def _phrases(depth: int, table, seed: int, limit: int):
    """Runs of the phrases of `depth` words whose first and last words but one are in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(table.value, np.uint8)
        trie = HatTrie(depth)
        for batch in slices(batches, "text"):
            words = _Words(batch, seed)
            ids, n = words.ids, len(words.ids)
            if n < depth:
                continue
            shorter = [ids[place : n - depth + 2 + place] for place in range(depth - 1)]
            slot = _slot(shorter)
            known = (bits[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8) & 1).astype(bool)
            fits = known[:-1] & known[1:]
            for place in range(depth - 1):
                fits &= words.follows[place : n - depth + 1 + place]
            at = np.flatnonzero(fits)
            if not len(at):
                continue
            # numbers in the order of the ids, put together to numbers in the order of the phrases
            used, local = np.unique(np.concatenate([ids[at + place] for place in range(depth)]), return_inverse=True)
            local = local.reshape(depth, -1)
            code = local[0]
            for place in range(1, depth):
                code = code * len(used) + local[place]
                if place < depth - 1:
                    _, code = np.unique(code, return_inverse=True)
            _, first, counts = np.unique(code, return_index=True, return_counts=True)
            trie.add([ids[at[first] + place].tolist() for place in range(depth)], counts.tolist())
            if trie.entries > limit:
                yield _run(*trie.spill(limit // 8))
        if trie.entries:
            yield _run(*trie.spill(0))

    return run


def _bits(depth: int):
    """The table of frequent phrases as words of 64 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << (TABLE_BITS - 6), _U)
        for batch in batches:
            columns = [batch.column(place).to_numpy().view(_U) for place in range(depth)]
            slot = _slot(columns)
            np.bitwise_or.at(table, slot >> _U(6), _U(1) << (slot & _U(63)))
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(table[used].view(np.int64))], ["at", "bits"]
        )

    return run


def _frequent_table(found: DataFrame, depth: int) -> bytes:
    """One bit for each frequent phrase, by hash: 2^TABLE_BITS bits, whatever the number of phrases.
    A phrase without a bit isn't frequent; one with a bit may be."""
    rows = found.select(*_names(depth)).mapInArrow(_bits(depth), "at int, bits long")
    blocks = rows.groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << (TABLE_BITS - 6), np.int64)
    table[blocks.column("at").to_numpy()] = blocks.column("bits").to_numpy()
    return table.tobytes()


def _words(rows: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Every word with its id, language and number of occurrences, and the seed that gives no two
    words the same id."""
    for seed in range(SEEDS):
        found = rows.mapInArrow(_vocabulary(seed, limit), "id long, lang string, word string, n long")
        words = written(found.repartition("id").groupBy("id", "lang", "word").agg(F.sum("n").alias("n")))
        if words.groupBy("id").count().where("count > 1").isEmpty():
            return words, seed
        discard(words)
    raise ValueError(f"words share an id under each of {SEEDS} seeds")


def _counted(rows: DataFrame, depth: int, table, seed: int, least: int, limit: int) -> DataFrame:
    """Frequent phrases of `depth` words: sorted runs merged part by part."""
    names = _names(depth)
    lists = ", ".join(f"{name} array<long>" for name in names)
    runs = rows.mapInArrow(_phrases(depth, table, seed, limit), f"part int, {lists}, n array<long>")
    cells = runs.repartition("part").select("part", F.inline(F.arrays_zip(*names, "n")))
    merged = cells.groupBy("part", *names).agg(F.sum("n").alias("f"))
    return written(merged.where(F.col("f") >= least).drop("part"))


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)) in whole numbers of 38 digits."""
    wide = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * wide(a) * wide(a), wide(left) * wide(right))


def _scored(tables: list[DataFrame], words: DataFrame, depth: int, cover: int) -> DataFrame:
    """The candidates of `depth` words with their weakest cut, without those that longer ones cover.
    `tables[k - 1]` holds the frequent phrases of k words."""
    names = _names(depth)
    rows = tables[depth - 1].withColumnRenamed("f", "a")
    longer = []
    for other in range(depth + 1, len(tables) + 1):
        for shift in range(other - depth + 1):
            inside = [F.col(f"w{shift + place}").alias(f"w{place}") for place in range(1, depth + 1)]
            longer.append(tables[other - 1].select(*inside, "f"))
    if longer:
        best = union_all(longer).groupBy(*names).agg(F.max("f").alias("within"))
        covered = F.coalesce(100 * F.col("within") >= cover * F.col("a"), F.lit(False))
        rows = rows.join(best, names, "left").where(~covered).drop("within")
    for place, name in enumerate(names, 1):
        about = words.select(F.col("id").alias(name), F.col("word").alias(f"word{place}"), F.col("n").alias(f"f{place}_1"), "lang")
        rows = rows.join(about if place == 1 else about.drop("lang"), name)
    for size in range(2, depth):
        for start in range(1, depth - size + 2):
            if start == 1 or start + size - 1 == depth:
                part = tables[size - 1].select(
                    *(F.col(f"w{place}").alias(f"w{start + place - 1}") for place in range(1, size + 1)),
                    F.col("f").alias(f"f{start}_{size}"),
                )
                rows = rows.join(part, [f"w{start + place}" for place in range(size)])
    cuts = []
    for k in range(1, depth):
        left, right = F.col(f"f1_{k}"), F.col(f"f{k + 1}_{depth - k}")
        cuts.append(F.struct(_score(F.col("a"), left, right).alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    phrase = F.concat_ws(" ", *(f"word{place}" for place in range(1, depth + 1)))
    return rows.select("lang", phrase.alias("phrase"), "a", F.array_min(F.array(*cuts)).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    cover: int = COVER,
    top: int = TOP,
    spill: int = SPILL,
) -> DataFrame:
    """The `top` phrases of each language: `lang`, `rank` (from 1), `phrase`, its occurrences `a`, those of
    the two sides of its weakest cut `l` and `r`, all words of the language `n`, and `score`.

    Texts, A-Z lower-cased, are split into pieces at `.,;:!?` and line ends, and these into words at spaces and
    tabs; a phrase is 2 to `longest` words in a row of one piece that occur at least `least` times. Cut
    in two, it scores floor(1000000 * a * a / (l * r)); the least score counts. Phrases inside a longer one
    that has at least `cover` in a hundred of their occurrences are left out. Order: score, occurrences
    (both descending), phrase. A null language is `und`, null and empty texts have no words, each repeated
    row counts, further columns are not looked at; no words give no rows.

    Each task counts in a trie of word ids and spills whole subtrees as sorted runs, which are merged by parts
    that the first two words name, so a task holds at most `spill` phrases and those of one slice of text.
    A phrase can only be frequent if both phrases one word shorter are: words, pairs and so on are
    counted one after another, and tasks get a table of fixed size with a bit for each frequent one;
    where it fills up it lets more pass, and results stay the same. Word ids are hashes of 64 bits; if
    two words of the whole vocabulary share one, all is counted anew with another seed (only two words
    that share one and never occur in different tasks go unnoticed, below n^2 / 2^65 for n words a task).
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    everything, seed = _words(rows, spill)
    frequent = everything.where(F.col("n") >= least)
    tables = [frequent.select(F.col("id").alias("w1"), F.col("n").alias("f"))]
    for depth in range(2, longest + 1):
        table = spark.sparkContext.broadcast(_frequent_table(tables[-1], depth - 1))
        tables.append(_counted(rows, depth, table, seed, least, spill))
        table.unpersist()
    scored = union_all(_scored(tables, frequent, depth, cover) for depth in range(2, longest + 1))
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # no language's candidates come together in one task: first the best of each of its parts
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))).orderBy(*order)
    best = scored.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    last = Window.partitionBy("lang").orderBy(*order)
    ranked = best.withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    totals = everything.groupBy("lang").agg(F.sum("n").alias("n"))
    out = written(ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))
    discard(everything, *tables[1:])
    return out
