"""A corpus pipeline of five stages over ``documents``.

1. language: documents whose language is not recognised go.
2. quality: lines that fail a rule are removed; documents that fail the base
   rules or lose too much go.
3. near copies: one document of each group of similar texts stays.
4. mixing: all documents, in the order of the sources' target weights.
5. pieces: the ids of every document.

Each stage works on what its predecessor kept, read again from Parquet. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyfold.llm import language_id, line_quality, ngram_join, pfair_mix, piece_stream
from tallyfold.llm.common import small_batches, stored
from tallyfold.llm.queries import TARGET_WEIGHTS, language_model


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an accepted language; ``lang`` is filled in where it is null."""
    small_batches(spark)
    found = language_id.identify(docs, language_model(docs)).where("accepted")
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, without their failing lines."""
    small_batches(spark)
    found = line_quality.judge_documents(docs, cleaned=True).where("kept")
    return found.withColumns({"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group."""
    small_batches(spark)
    return ngram_join.one_of_each_class(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that follow the mixture's order."""
    small_batches(spark)
    return pfair_mix.mixed_in_order(docs, TARGET_WEIGHTS, default_weight=2, rows_per_task=20_000).select(docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_ids and ids of every document."""
    small_batches(spark)
    found = piece_stream.encode_documents(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "source", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [("language", language), ("quality", quality), ("near_copies", near_copies), ("mixing", mixing), ("pieces", pieces)]

#: Language models, line rules and searches are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
