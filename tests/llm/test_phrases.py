"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import helpers as H
from plumbline.llm import phrases


def by_hand(rows, longest=3, least=10, cover=50, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(H.LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang][tuple(words[i : i + size])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in candidates.items():
            within = [
                q for q in candidates if len(q) > len(p)
                and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if any(100 * candidates[q] >= cover * a for q in within):
                continue
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def texts(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "Ünder", "a\xa0b", "—", "x'y", "\x0b", "z" * 300, "token=", "1"]
    out = []
    for _ in range(n):
        parts = rng.choices(words, [9, 3, 5, 4, 4, 4, 3, 2, 1, 1, 1, 1, 1, 1, 2], k=rng.randint(0, 60))
        if rng.random() < 0.4:
            parts += ["new", "york", "city"] * rng.randint(1, 3)
        out.append("".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " ; ", "\r\n"]) for w in parts))
    return out


def rows_of(seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["en", "de", None, "und", ""]), t) for t in texts(seed, 300)]
    return rows + [(None, None), ("en", ""), ("fr", "..."), ("xx", "a b c " * 5000)] + rows[:3] * 4


@pytest.mark.parametrize("seed,longest,top,spill", [(1, 3, 2000, 1 << 20), (2, 3, 7, 40), (3, 4, 2000, 200), (4, 2, 50, 5)])
def test_collocations(spark, monkeypatch, seed, longest, top, spill):
    rows = rows_of(seed)
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "lang string, text string, n long, word string").repartition(4)
    got = phrases.collocations(docs, longest=longest, top=top, spill=spill)
    assert sorted(map(tuple, got.collect())) == sorted(by_hand(rows, longest, top=top))


def test_no_documents(spark):
    for rows in ([], [("en", None)], [("en", "one two three")]):
        docs = spark.createDataFrame(rows, "lang string, text string")
        assert phrases.collocations(docs).collect() == []


def test_ids_in_common_are_counted_anew(spark, monkeypatch):
    """The first seed gives all words of a language the same id."""
    rows = rows_of(5)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    found = phrases._vocabulary

    def clashing(seed, limit):
        run = found(seed, limit)

        def same(batches):
            import pyarrow as pa

            for batch in run(batches):
                ids = pa.array([1] * batch.num_rows, pa.int64()) if seed == 0 else batch.column("id")
                yield pa.RecordBatch.from_arrays([ids, *batch.columns[1:]], batch.schema.names)

        return same

    monkeypatch.setattr(phrases, "_vocabulary", clashing)
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == sorted(by_hand(rows))


@pytest.mark.parametrize("depth,burst", [(1, 3), (2, 3), (3, 2), (4, 1), (3, 10**6)])
def test_trie_counts_what_a_counter_counts(depth, burst):
    rng = random.Random(depth)
    trie, expected, spilled = phrases.HatTrie(depth, burst), Counter(), Counter()

    def keep(columns, counts):
        for *key, n in zip(*(c.tolist() for c in columns), counts.tolist(), strict=True):
            spilled[tuple(key)] += n

    for _ in range(30):
        some = Counter(tuple(rng.randint(0, 2**64 - 1) if rng.random() < 0.1 else rng.randint(0, 6) for _ in range(depth)) for _ in range(50))
        keys = sorted(some)
        trie.add([[k[place] for k in keys] for place in range(depth)], [some[k] for k in keys])
        expected += some
        if trie.entries > 120:
            keep(*trie.spill(60))
            assert trie.entries <= 60
    assert trie.entries == phrases._size(trie.root)
    keep(*trie.spill(0))
    assert spilled == expected and trie.entries == 0


def test_large_counts_are_exact(spark):
    a, left, right = 10**9 + 7, 10**12 + 39, 10**12 + 61
    row = spark.createDataFrame([(a, left, right), (a, a, a)], "a long, l long, r long")
    score = [r[0] for r in row.select(phrases._score(row["a"], row["l"], row["r"])).collect()]
    assert score == [10**6 * a * a // (left * right), 10**6]


def test_huge_text_is_one_slice(spark):
    """Phrases run on where a long text is worked on piece by piece."""
    from plumbline.llm import shingles

    rng = random.Random(9)
    text = " ".join(rng.choices(["a", "b", "c", "dd"], k=6_000_000))
    assert len(text) > 2 * shingles.PIECE
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    got = [tuple(r) for r in phrases.collocations(docs, cover=1000).collect()]
    words = np.array(text.split(" "))
    pairs = Counter(zip(words.tolist(), words[1:].tolist(), strict=False))
    assert {r[2]: r[3] for r in got if r[2].count(" ") == 1} == {" ".join(k): n for k, n in pairs.items()}
