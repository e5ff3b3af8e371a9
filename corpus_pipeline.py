"""The corpus pipeline: documents in, digests of the tokens of a clean, mixed corpus out.

Each stage is (name, function) and each function takes (spark, docs, sf_dir); what it returns is written as Parquet
and read again as the docs of the next. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from corpuloom.llm import bpe, exact_dedup, mixing, quality, simhash
from corpuloom.llm.shared import drop_tables, tables_written
from corpuloom.sources.readers import dealt
from corpuloom.sources.workspace import delete, new_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.3). Learnt from the labels beside sf_dir."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space apart) the longest, then the one of smallest id."""
    return exact_dedup.kept_rows(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, that of smallest id."""
    return simhash.representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document, copies of the mix included."""
    return bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_dedup_stage),
    ("SimHash near-dedup", near_dedup_stage),
    ("mixing sources to target weights", mixing_stage),
    ("BPE encoding and decoding", bpe_stage),
]

#: A trained classifier, XXH64 fingerprints and BPE are beyond SQL; tests/llm holds the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents; each stage's rows go through a table in the shared folder."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        mark, out = tables_written(), new_path(spark, "pipeline")
        stage(spark, dealt(docs), sf_dir).write.parquet(out)
        # What the stage stored on its way, and the stage before, aren't needed any more.
        drop_tables(spark, mark)
        if before:
            delete(spark, before)
        docs, before = spark.read.parquet(out), out
    return docs
