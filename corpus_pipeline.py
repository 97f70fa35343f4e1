"""A training corpus from raw documents: five stages, each on all that the one before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next
stage's docs. All but the last return the columns of documents.

1. language_id: documents in which no language can be told (null texts, no letters) go.
2. simhash_near_dedup: one document of each group of near copies stays.
3. secret_scan: secrets are masked in the text; no document goes.
4. mix_sources: every document is repeated as often as the mix takes it.
5. sentencepiece: the mix as piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tempora.llm.common import read
from tempora.llm.langid import keep_identified
from tempora.llm.mixing import mixed_documents, quality_weights
from tempora.llm.secret_scan import redact
from tempora.llm.sentencepiece_fst import encode_documents
from tempora.llm.simhash import keep_one_of_each
from tempora.session import ensure_checkpoint_dir, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, shingle=4, budget=4)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, quality_weights(read(spark, sf_dir, "labels")))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("sentencepiece", sentencepiece),
]

#: SQL cannot express the trained language model, the fingerprints and the piece ids; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written to the shared folder and reread."""
    ensure_checkpoint_dir(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
