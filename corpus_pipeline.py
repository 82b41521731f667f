"""The training-data pipeline: language, near copies, benchmark leaks, secrets, token ids.

Each stage takes all that the one before kept and returns the columns of documents, the last one the digest of its ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenloom.llm.common import WRITTEN, drop_written, free_name, table
from screenloom.llm.decontaminate import without_leaks
from screenloom.llm.encoding import round_trip_digest
from screenloom.llm.langid import held_out, predict, train
from screenloom.llm.nearcopies import one_of_each
from screenloom.llm.secrets import redacted

LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose language is told with a score of LEAST_SCORE; null texts and those without a letter go."""
    network = train(docs.where(~held_out()))
    name = free_name(docs, "language")
    told = predict(docs, network, name)
    return told.where((told[name]["label"] != "und") & (told[name]["score"] >= LEAST_SCORE)).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, the smallest doc_id's: pairs that op2's fingerprints link or that share a band, of an exact Jaccard similarity of 0.8 or more."""
    return one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes documents that contain an item of benchmark."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and masks the secrets in their texts."""
    return redacted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digest of each document's token ids and of the text they decode to."""
    return round_trip_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("language", language), ("near copies", near_copies), ("benchmark leaks", benchmark_leaks), ("secrets", secret_spans), ("token ids", token_ids)]
#: SQL can't express the first stage's network; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; a stage's table goes when the next one's is written, and what it wrote on the way with it."""
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), len(WRITTEN)
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_written(spark, since, docs)
    return STAGES[-1][1](spark, docs, sf_dir)
