"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import langid, quality, warc
from plumbline.llm.common import discard, fresh_path, remove, table, written
from plumbline.llm.decontaminate import find_leaks
from plumbline.llm.fingerprint import fingerprints
from plumbline.llm.licenses import scan_licences
from plumbline.llm.line_dedup import dedup_lines
from plumbline.llm.ngram_join import similar_documents
from plumbline.llm.phrases import collocations
from plumbline.llm.sentencepiece import encode_texts
from plumbline.llm.token_counts import count_tokens
from plumbline.llm.url_filter import Rule, judge_urls
from plumbline.llm.vector_codes import compress, hex_code, summed_over

URL_RULES = [
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
    Rule("block", "*.casino*", is_glob=True),
    Rule("block", "*.free-bets.*", is_glob=True),
    Rule("block", "*.cheap-pills.*", is_glob=True),
    Rule("block", "*.spam-farm.*", is_glob=True),
    Rule("block", "*.adult-?.*", is_glob=True),
    Rule("block", "*.ads-*.*", is_glob=True),
]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    same = F.col("decoded").eqNullSafe(F.translate(F.coalesce("row.text", F.lit("")), "▁", " "))
    return found.select(
        "row.doc_id",
        "n_tokens",
        F.col("n_bytes").alias("n_byte_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
        same.alias("lossless"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"])


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(docs).select(
        "row.doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licences", ",").alias("licences"),
        "n_unused",
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).select("row.page_id", "host", "path", "rule", "verdict")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model).select(
        "row.doc_id",
        (~quality.learnable(F.col("row.doc_id"))).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify_languages(docs, langid.learnable(F.col("doc_id")))
    return found.select(
        "row.doc_id", (~langid.learnable(F.col("row.doc_id"))).alias("held_out"), "lang_pred", "score"
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    crawled, kept = fresh_path(spark), fresh_path(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), crawled, "page_id", "url", "html")
    warc.deduplicate_archive(spark, crawled, kept)
    records = written(warc.read_archive(spark, kept, payload=False).drop("payload"))
    found = warc.resolved(records)
    discard(records)
    for folder in (crawled, kept):
        remove(spark, folder)
    return found.select(
        F.col("source_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_source").cast("long").alias("refers_to"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    rows = found.select("row.vec_id", "row.label", hex_code().alias("code"), "error")
    digest = F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    return summed_over(rows, "label", "error", "label_error").select("vec_id", "code", "error", "label_error", digest)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_token_counts,
        op3_license_scan,
        op4_url_filter,
        op5_line_dedup,
        op6_decontaminate,
        op7_quality,
        op8_fingerprints,
        op9_ngram_join,
        op10_language_id,
        op11_collocations,
        op12_warc_revisits,
        op13_vector_codes,
    )
}
