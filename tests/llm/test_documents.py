"""Fingerprints, near duplicates, quality, languages and the pipeline."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import helpers as H
from plumbline.llm import components as C
from plumbline.llm import (
    decontaminate, fingerprint, langid, ngram_join, quality, queries, sentencepiece, shingles,
)

SF = "/root/testdata/sf0.001"


def arrow(texts):
    return pa.array(texts, pa.large_string())


# Fingerprints


def by_hand(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for (doc, text), (_, after) in zip(order, [*order[1:], *order[:1]], strict=True):
        text, after = text or "", after or ""
        k = len(text) // 3
        changed = text[: len(text) - k] + after[:k]
        a, b, c = (fingerprint.fingerprint(x.encode()) for x in (text, changed, after))
        out.append(
            (doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b,
             fingerprint.likeness(a, b), fingerprint.likeness(a, c))
        )
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 2, 40, 333])
def test_fingerprints_meet_the_next_document(spark, n):
    rng = random.Random(n)
    rows = [(rng.randint(-(10**12), 10**12), "é words " * rng.randint(0, 30) + str(rng.random())) for _ in range(n)]
    if n > 2:
        rows += [(None, "no id"), (None, None), rows[0], (rows[1][0], "the same id"), (5, ""), (6, None), (7, "x" * 200000)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, bucket string").repartition(5)
    got = [tuple(r) for r in fingerprint.fingerprints(docs).collect()]
    assert sorted(got, key=str) == by_hand(rows)


def test_fingerprints_of_nothing(spark):
    assert fingerprint.fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_fingerprint_likeness():
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(400)]
    text = " ".join(rng.choices(words, k=600))
    close = text.replace(words[3], words[4])
    other = " ".join("".join(rng.choices("ijklmnopq", k=5)) for _ in range(600))
    prints = [fingerprint.fingerprint(t.encode()) for t in (text, close, other, "", "ab")]
    assert fingerprint.likeness(prints[0], prints[0]) == 1
    assert fingerprint.likeness(prints[0], prints[1]) > 0.8 > 0.3 > fingerprint.likeness(prints[0], prints[2])
    assert all(0 <= fingerprint.likeness(a, b) == fingerprint.likeness(b, a) <= 1 for a in prints for b in prints)
    assert len({len(p) for p in prints}) == 1


# Near duplicates


def near_rows(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 3000))
    rows, passage = [], " ".join(word() for _ in range(60))
    for base in range(12):
        words = [word() for _ in range(rng.choice([3, 5, 8, 40, 120]))]
        for _ in range(rng.choice([1, 2, 25])):
            copy = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy).upper() if rng.random() < 0.2 else " ".join(copy))
        rows.append(passage + " " + " ".join(word() for _ in range(base * 6)))
    rows += ["", None, " \t", "One", "one", rows[0], rows[0], "w " * 4000, "w " * 4001, "é é x y z"]
    ids = rng.sample(range(1000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize("lists", [ngram_join.LISTS, 1])
def test_near_duplicates_as_brute_force(spark, monkeypatch, lists):
    monkeypatch.setattr(ngram_join, "LISTS", lists)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    rows = [*near_rows(4), (None, "One"), (3, "same id"), (3, "other text of the same id here")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, n int, c int")
    got = [tuple(r) for r in ngram_join.similar_documents(docs).collect()]
    assert sorted(got, key=str) == sorted(H.components(rows), key=str)


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_documents(empty).collect() == []
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, ngram_join.similar_documents(blank).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_shingles_of_a_slice():
    texts = [t or "" for _, t in near_rows(9)] + ["a b c d", "a b c d e", "A B C D", " a  b\tc\nd ", "abcd"]
    hashes, ends = shingles.shingle_sets(arrow(texts))
    sets = [frozenset(hashes[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    plain = [H.shingle_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in plain]
    for i, a in enumerate(plain):
        assert all((sets[i] == sets[j]) == (a == plain[j]) for j in range(i))


@pytest.mark.parametrize("n", range(7))
def test_shingles_of_a_slice_with_few_words(n):
    texts = ["", " ".join("abcdefg"[:n]), None]
    hashes, ends = shingles.shingle_sets(pa.array([t or "" for t in texts], pa.large_string()))
    assert list(np.diff(ends)) == [0, len(H.shingle_set(texts[1])), 0] and len(hashes) == ends[-1]


@pytest.mark.parametrize("n", [2, 3])
def test_near_duplicates_of_one_short_document(spark, n):
    one = spark.createDataFrame([(1, " ".join("abcde"[:n]))], "doc_id long, text string")
    assert [tuple(r) for r in ngram_join.similar_documents(one).collect()] == [(1, 1, 1)]


def test_components(spark):
    rng = random.Random(8)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 180)] + [(7, 7), (200, 199), (199, 200)]
    links += [tuple(rng.sample(range(1000, 1400), 2)) for _ in range(200)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        if a != b:
            up[max(top(a), top(b))] = min(top(a), top(b))
    found = C.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r["node"], r["component"]) for r in found} == {(x, top(x)) for x in list(up)}
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []


# Quality


GOOD = ["the words of this line are calm", "and then it went on for a while", "a thing that was said, and more."]
BAD = ["buy### now$$$ best&&&", "WIN!! WIN!! MONEY!!", "aa aa aa aa aa aa aa", "x | y | z | w |"]


def quality_rows(n):
    rng = random.Random(6)
    make = lambda parts: "\n".join(rng.choices(parts, k=rng.randint(2, 60)))
    return [(k, make(BAD if k % 3 == 0 else GOOD), int(k % 3 != 0)) for k in range(n)]


def test_quality_on_held_out_documents(spark):
    rows = quality_rows(300)
    docs = spark.createDataFrame([(k, t, "x") for k, t, _ in rows], "doc_id long, text string, score string")
    more = [(1000, None, "x"), (1001, "", "x"), (None, "a", "x"), (1002, "word " * 60000, "x")]
    more = spark.createDataFrame(more, docs.schema)
    marks = [(k, y, 0) for k, _, y in rows] + [(None, 1, 0), (5, None, 0), (4, 1, 1), (4, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = quality.train(docs.union(more), labels)
    found = quality.score_quality(docs.union(more), model).collect()
    assert len(found) == len(rows) + 4 and all(0 <= r["score"] <= 1 for r in found)
    truth = {k: y for k, _, y in rows}
    held = [r for r in found if r["row"]["doc_id"] in truth and zlib.crc32(str(r["row"]["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 30
    assert np.mean([(r["score"] >= 0.3) == truth[r["row"]["doc_id"]] for r in held]) > 0.95


def test_quality_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.train(docs, none)
    assert {r["score"] for r in quality.score_quality(docs, model).collect()} == {0.5}
    assert quality.score_quality(docs.limit(0), model).collect() == []
    one = spark.createDataFrame([(k, 1) for k in range(9)], "doc_id long, quality int")
    assert quality.score_quality(docs, quality.train(docs, one)).first()["score"] > 0.9


def test_quality_sample_is_bounded(spark, monkeypatch):
    """An id held by thousands of rows, the same text or others, does not go beyond the bound."""
    seen = []
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, offsets, y: (seen.append((len(y), np.diff(offsets).max())), plain(x, offsets, y))[1])
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    kept = [k for k in range(60) if zlib.crc32(str(k).encode()) % 5 != 0]
    base = [(k, f"text number {k}") for k in range(60)]
    same = spark.createDataFrame(base + [(kept[0], "held by many rows")] * 3000, "doc_id long, text string")
    quality.train(same, labels)
    assert seen.pop()[0] == len(kept) + 1
    monkeypatch.setattr(quality, "TRAIN", 100)
    other = [(kept[0], f"one of many {k}") for k in range(3000)] + [(kept[1], "word " * 40_000)]
    quality.train(spark.createDataFrame(base + other, "doc_id long, text string"), labels)
    count, longest = seen.pop()
    assert count <= 2 * 100 and longest == quality.TRAIN_PASSAGES


def test_fit_separates_a_small_sample():
    rng = np.random.default_rng(0)
    x, offsets = rng.normal(size=(30, quality.FEATURES)), np.array([0, 4, 5, 12, 30])
    label = np.array([0.0, 1, 1, 0])
    model = quality.fit(x, offsets, label)
    score, _ = model.forward(x, offsets)
    assert ((score > 0.5) == label).all()


def test_passages_do_not_depend_on_the_slice():
    texts = [t for _, t, _ in quality_rows(20)] + ["", " \n", "é", "one", "w " * 200, " lead"]
    whole, ends = quality.passages(arrow(texts))
    for k, text in enumerate(texts):
        alone, _ = quality.passages(arrow([text]))
        assert np.allclose(whole[ends[k] : ends[k + 1]], alone)


@pytest.mark.parametrize("size", [64, 100, 1000])
def test_very_long_texts_are_worked_on_in_parts(monkeypatch, size):
    rng = random.Random(1)
    make = lambda n: " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(n))
    texts = arrow([make(rng.randint(0, 700)) + "\nline é" for _ in range(8)] + ["", "x" * 5000, " " * 3000, "a"])
    model = sentencepiece.encoder(public_tokenizers.path("piece_bpe_32k.model"))

    def all_of():
        hashes, ends = shingles.shingle_sets(texts)
        digests = [fingerprint.fingerprint(t.encode()) for t in texts.to_pylist()]
        return hashes.tolist(), ends.tolist(), langid.presence(texts).tolist(), digests, model.encode(texts).to_pylist()

    whole, (x, ends) = all_of(), quality.passages(texts)
    for module in (shingles, langid, fingerprint, sentencepiece, quality):
        monkeypatch.setattr(module, "PIECE", size)
    monkeypatch.setattr(shingles.pieces, "__defaults__", (size,))
    assert all_of() == whole
    parts, more = quality.passages(texts)  # a part begins a passage of its own
    assert len(parts) >= len(x) and len(more) == len(ends)
    assert (np.diff(more) >= np.diff(ends)).all()


# Languages


def test_languages_on_held_out_documents(spark):
    rng = random.Random(7)
    words = {"aa": "the and of this with", "bb": "der und die nicht auf", "cc": "les des une être où"}
    rows = []
    for k in range(240):
        lang = rng.choice(list(words))
        rows.append((k, " ".join(rng.choices(words[lang].split(), k=rng.randint(3, 80))), lang))
    odd = [(900, None, "aa"), (901, "12 ... 34", "aa"), (902, "", "aa"), (903, "the and of", None), (None, "und die", "bb"), (904, "der und " * 20000, "bb")]
    docs = spark.createDataFrame([(*r, "x") for r in rows + odd], "doc_id long, text string, lang string, lang_pred string")
    found = langid.identify_languages(docs, langid.learnable(F.col("doc_id"))).collect()
    got = {r["row"]["doc_id"]: (r["lang_pred"], r["score"]) for r in found}
    held = [(k, lang) for k, _, lang in rows if zlib.crc32(str(k).encode()) % 3 == 1]
    assert np.mean([got[k][0] == lang for k, lang in held]) > 0.98
    assert got[900] == got[901] == got[902] == ("und", 0.0)
    assert got[903][0] == "aa" and got[904][0] == "bb" and got[None][0] == "bb"
    assert all(0 <= s <= 1 for _, s in got.values())


def test_languages_of_few_texts_held_by_many_rows(spark, monkeypatch):
    """Copies count once: no language is lost, and none fills the sample."""
    seen = []
    plain = langid.fit
    monkeypatch.setattr(langid, "fit", lambda x, names: (seen.append(list(names)), plain(x, names))[1])
    rows = [(f"the text of number {k}", "en") for k in range(2000)]
    rows += [(f"der text der nummer {k % 4}", "de") for k in range(5000)] + [("un texte", "fr")] * 3000
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    model = langid.train(docs, F.lit(True))
    assert set(model.names) == {"en", "de", "fr"}
    assert seen[0].count("en") == langid.TRAIN and seen[0].count("de") == 4 and seen[0].count("fr") == 1
    many = [(f"word{k} some text {k}", f"l{k % 700}") for k in range(2800)]
    assert len(set(langid.train(spark.createDataFrame(many, "text string, lang string"), F.lit(True)).names)) == 700


def test_languages_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    found = langid.identify_languages(docs, F.lit(True)).collect()
    assert {(r["lang_pred"], r["score"]) for r in found} == {("und", 0.0)}
    assert langid.identify_languages(docs.limit(0), F.lit(True)).collect() == []


def test_presence_kernel():
    x = langid.presence(arrow(["abc", "ABC", "abd", "", "1"]))
    assert (x[0] == x[1]).all() and x[3].sum() == 0
    assert x[0, :256].nonzero()[0].tolist() == [97, 98, 99]
    k = langid.kernel(x, x)
    assert np.allclose(np.diag(k)[:3], 1) and k[0, 2] < 1 and np.allclose(k, k.T)


# The pipeline


def test_pipeline_stages_as_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(5000, None, "en", "s", 0), (5001, "", None, None, None), (None, "no id at all", "en", "s", 12)], docs.schema
    )
    docs = docs.unionByName(odd).withColumn("row", F.lit("x")).withColumn("score", F.lit("y"))
    rows = lambda df: {(r["doc_id"], r["text"]) for r in df.collect()}
    columns = docs.columns

    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = corpus_pipeline.keep_good(spark, docs, SF)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"), "text").collect()
    scores = model.scores(arrow([r["t"] for r in texts]))
    assert good.columns == columns
    assert rows(good) == {(r["doc_id"], r["text"]) for r, s in zip(texts, scores, strict=True) if s >= 0.3}

    lines = corpus_pipeline.drop_repeated_lines(spark, good, SF)
    assert lines.columns == columns
    source = list(rows(good))
    wanted = {(d, kept if n else t) for (d, t), (_, _, n, kept) in zip(source, H.dedup_lines(source), strict=True)}
    assert rows(lines) == wanted
    changed = lines.where(F.col("n_chars") != F.char_length("text")).count()
    assert changed == docs.where(F.col("n_chars") != F.char_length("text")).count()

    single = corpus_pipeline.drop_near_duplicates(spark, lines, SF)
    source = list(rows(lines))
    label = H.components(source)
    assert single.columns == columns
    assert rows(single) == {r for r, (d, _, c) in zip(source, label, strict=True) if d is None or c == d}

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = corpus_pipeline.drop_leaks(spark, single, SF)
    assert clean.columns == columns
    assert rows(clean) == {(d, t) for d, t in rows(single) if H.leaks(t, items)[1] == 0}

    tokens = corpus_pipeline.tokenise(spark, clean, SF).collect()
    assert {r["doc_id"] for r in tokens} == {d for d, _ in rows(clean)}
    assert all(r["lossless"] and len(r["ids"]) == r["n_tokens"] for r in tokens)


def test_near_duplicates_are_dropped_row_by_row(spark):
    """Of two rows with one id only the copy goes; rows without id stay."""
    a = " ".join(f"word{k}" for k in range(40))
    rows = [(1, a), (5, a), (5, "a clean text of its own"), (7, a.upper()), (9, None), (None, a), (2, "x"), (2, "x")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, mark int")
    found = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert found.columns == docs.columns
    kept = sorted((r["mark"], r["doc_id"], r["text"]) for r in found.collect())
    assert [k[0] for k in kept] == [0, 2, 4, 5, 6, 7]


def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == []


def test_stages_use_the_operators_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"
    assert decontaminate.WINDOW == 10 and ngram_join.PERCENT == 80 and len(queries.QUERIES) == 13
