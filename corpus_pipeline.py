"""The corpus pipeline: documents go through five stages, each of which works on all that the one
before has kept. All stages but the last return the columns of documents.

Rows without an id, null and empty texts, repeated rows and further columns pass through every
stage; what an operator does with them is said in its own docstring. An empty table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import quality
from plumbline.llm.common import discard, table, written
from plumbline.llm.decontaminate import find_leaks
from plumbline.llm.line_dedup import dedup_lines
from plumbline.llm.ngram_join import similar_documents
from plumbline.llm.sentencepiece import encode_texts


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose quality score is below the threshold."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).where(F.col("score") >= quality.THRESHOLD).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier document holds, and their new lengths. A document
    that loses every line stays, with an empty text."""
    found = dedup_lines(docs)
    row = F.col("row").withField("text", F.col("kept"))
    if "n_chars" in docs.columns:
        length = F.char_length("kept").cast(docs.schema["n_chars"].dataType)
        row = row.withField("n_chars", length)
    return found.select(F.when(F.col("n_dropped") > 0, row).otherwise(F.col("row")).alias("row")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links hold together, the one with the least id stays. Rows are told
    apart by id and text: of rows that share an id, each is kept or dropped by its own text. Repeated rows
    of one id and one text stay or go together; rows without id stay."""
    mark = F.struct(F.xxhash64("text").alias("text"), F.hash("text").alias("more"))
    row = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", mark.alias("mark")))
    found = similar_documents(docs.select(row.alias("doc_id"), "text"))
    later = written(found.where("component_id <> doc_id").select("doc_id.doc_id", "doc_id.mark").distinct())
    marked = docs.select(F.struct("*").alias("row"), "doc_id", mark.alias("mark"))
    return marked.join(later, ["doc_id", "mark"], "left_anti").select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of the benchmark."""
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).where("n_hit = 0").select("row.*")


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, and whether they decode to its text."""
    found = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    same = F.col("decoded") == F.translate(F.coalesce("row.text", F.lit("")), "▁", " ")
    return found.select("row.doc_id", "n_tokens", "ids", same.alias("lossless"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("SentencePiece encoding", tokenise),
]

#: SQL can't express the first and the last stage; tests hold the rows against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for documents; every stage is written to the shared folder."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return docs
