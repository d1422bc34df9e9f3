"""A training corpus from raw documents: language, near-duplicates, benchmark leaks, mix, shards.

Each stage works on all rows that its predecessor kept and returns the columns
of ``documents``; the last adds the shard and the slot.  SQL can't express the
stages; tests/llm holds them against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catrec.llm import decontam, hilbert, icws, langid, mixing
from catrec.llm.common import shared_folder, table

#: Documents whose best language holds less of their letters are rejected.
LANGUAGE_SCORE = 0.5
MIX_WEIGHTS = [3, 1, 2]
SHARDS = 24


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.learn(docs.select(F.col("doc_id").alias("id"), "text", "lang"))
    named = langid.identify(docs, model, keep=[F.struct(*docs.columns).alias("row_")])
    known = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LANGUAGE_SCORE)
    return named.where(known).select("row_.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return icws.one_per_class(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~F.col("contaminated")).select("row_.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs, MIX_WEIGHTS)


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shards; a column that shares the name of an added one gives way to it."""
    carry = [c for c in docs.columns if c != "doc_id" and c not in hilbert.ADDED]
    return hilbert.shard_by_bytes(docs, SHARDS, carry=carry)


STAGES = [
    ("language_id", keep_known_language),
    ("minhash_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
    ("sharding", cut_shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
