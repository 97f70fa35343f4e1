"""One registered query per operator: the operator over its whole table, digest columns derived from its output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.llm.common import read
from tempora.session import scratch_path


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.html_text import extract_text

    return extract_text(read(spark, sf_dir, "pages"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.ann import nearest

    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.simhash import simhash_near_dedup

    return simhash_near_dedup(read(spark, sf_dir, "documents"), shingle=4, budget=4).select(
        "doc_id", "fingerprint", "component_id")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.langid import identify

    return identify(read(spark, sf_dir, "documents"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.embedding_dedup import embedding_near_dedup

    return embedding_near_dedup(read(spark, sf_dir, "embeddings"), cosine=0.9)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.suffix import remove_repeats

    return remove_repeats(read(spark, sf_dir, "documents"), length=200).drop("kept")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.mixing import mix_sources, quality_weights

    weights = quality_weights(read(spark, sf_dir, "labels"))
    return mix_sources(read(spark, sf_dir, "documents"), weights).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.sentencepiece_fst import encode_documents

    return encode_documents(read(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.urls import filter_urls, rules_table

    return filter_urls(read(spark, sf_dir, "pages"), rules_table(spark))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.secret_scan import scan_secrets

    return scan_secrets(read(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.whitening import whiten_embeddings

    return whiten_embeddings(read(spark, sf_dir, "embeddings"), components=16, grid=64, offset=1_000_000)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.warc import page_of, read_archives, write_archives

    path = scratch_path(spark, "warc")
    write_archives(read(spark, sf_dir, "pages"), path, min_bytes=0)
    return read_archives(spark, path, payloads=False).select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tempora.llm.prefix_trie import prefix_trie

    return prefix_trie(read(spark, sf_dir, "conversations"), modulus=100, openings=6)


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_mix_sources": op4_mix_sources,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_url_filter": op6_url_filter,
    "op7_secret_scan": op7_secret_scan,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_html_text": op10_html_text,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_warc": op12_warc,
    "op13_prefix_trie": op13_prefix_trie,
}
