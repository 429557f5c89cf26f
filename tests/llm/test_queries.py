"""Every registered query of the subpackage on the smallest tables: against its SQL, or for whole
rows where SQL can't express it."""

import zlib
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
import helpers as H
from plumbline.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def in_order(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", [n for n in QUERIES if n in entry.oracle_sql()])
def test_query_as_sql(spark, oracle, name):
    found = QUERIES[name](spark, FOLDER)
    result = oracle.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    assert sorted(found.columns) == sorted(columns)
    assert in_order(found.collect(), found.columns) == in_order(expected, columns)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in entry.oracle_sql()])
def test_query_returns_every_document(spark, oracle, name):
    found = QUERIES[name](spark, FOLDER)
    ids = [r["doc_id"] for r in found.select("doc_id").collect()]
    assert sorted(ids) == [r[0] for r in oracle.execute("SELECT doc_id FROM documents ORDER BY 1").fetchall()]


def test_near_duplicates_of_the_documents(spark, oracle):
    rows = oracle.execute("SELECT doc_id, text FROM documents").fetchall()
    found = [tuple(r) for r in QUERIES["op9_ngram_join"](spark, FOLDER).collect()]
    assert sorted(found) == sorted(H.components(rows))


def test_classifiers_on_held_out_documents(spark, oracle):
    quality = {r["doc_id"]: r for r in QUERIES["op7_quality"](spark, FOLDER).collect()}
    labels = oracle.execute("SELECT doc_id, quality FROM labels").fetchall()
    assert all(quality[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in quality)
    held = [(d, y) for d, y in labels if quality[d]["held_out"]]
    assert sum(quality[d]["predicted"] == y for d, y in held) >= 0.9 * len(held)
    langs = {r["doc_id"]: r for r in QUERIES["op10_language_id"](spark, FOLDER).collect()}
    truth = oracle.execute("SELECT doc_id, lang FROM documents").fetchall()
    assert all(langs[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d in langs)
    held = [(d, y) for d, y in truth if langs[d]["held_out"]]
    assert sum(langs[d]["lang_pred"] == y for d, y in held) >= 0.9 * len(held)


def test_pipeline_returns_what_its_stages_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    found = entry.queries()["pipeline"](spark, FOLDER)
    assert found.exceptAll(corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)).isEmpty()
    assert found.count() == docs.count() > 0
