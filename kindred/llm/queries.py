"""The operators over the given tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kindred.llm import bpe, packing
from kindred.llm.alignment import align_tokenizers
from kindred.llm.cell_dedup import near_duplicate_vectors
from kindred.llm.dom_model import extract_text
from kindred.llm.exact_dedup import DigestIndex, deduplicate
from kindred.llm.line_crf import fit_field, score_documents
from kindred.llm.quality_rules import judge
from kindred.llm.registry import query, table
from kindred.llm.repeats import remove_repeats
from kindred.llm.simhash import near_duplicates
from kindred.llm.sql import EXACT_DEDUP_SQL, QUALITY_RULES_SQL, URL_FILTER_SQL, VECTOR_DEDUP_SQL, WARC_SQL
from kindred.llm.url_filter import UrlRule, filter_urls
from kindred.llm.warc import archive_folder, read_archives, write_archives
from kindred.llm.whitening import whiten

URL_RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


@query()
def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query(QUALITY_RULES_SQL)
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query(EXACT_DEDUP_SQL)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return deduplicate(table(spark, sf_dir, "documents"), DigestIndex(spark, buckets=buckets))


@query()
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query(URL_FILTER_SQL)
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES, keep=("page_id",))


@query()
def op6_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit_field(docs, table(spark, sf_dir, "labels")))


@query()
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


@query(WARC_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = write_archives(table(spark, sf_dir, "pages"), archive_folder(spark))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query()
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query()
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query()
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")
    return align_tokenizers(table(spark, sf_dir, "documents"), *paths)


@query(VECTOR_DEDUP_SQL)
def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
