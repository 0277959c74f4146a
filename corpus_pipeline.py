"""Training-corpus pipeline over ``documents``: five stages, each one of the llm operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as
Parquet below ``spark.checkpoint.dir`` and rereads as the next stage's input. All stages but
the last return the columns of ``documents``. Rows whose doc_id is null cannot be named by a
decision on ids alone: stages that join on ids keep them; near duplicates are told by their
text as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate as leaks
from tallyframe.llm import kd_shards, mixing, near_dedup, tables, toxicity

SHARD_BYTES = 32 << 20
# names that no table brings along
ID, TEXT, KEY, SCORE = "__first_id", "__first_text", "__text_key", "__toxicity"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the operator's threshold."""
    model = toxicity.train(docs, tables.read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, SCORE).filter(F.col(SCORE) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five words, 0.8): the text of the smallest
    doc_id. Rows that repeat a doc_id and its text count as copies; texts without words stay."""
    first = (near_dedup.near_duplicates(docs, k=5, percent=80).filter("first")
             .select(F.col("doc_id").alias(ID), F.col("text_key").alias(TEXT)).distinct())
    named = docs.withColumn(KEY, F.xxhash64("text"))
    return (named.join(first, F.col("doc_id").eqNullSafe(F.col(ID)) & (F.col(KEY) == F.col(TEXT)), "left_semi")
            .dropDuplicates(["doc_id", KEY]).select(*docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = leaks.find_leaks(docs, tables.read(spark, sf_dir, "benchmark"))
    found = tables.scratch(found.select("doc_id").distinct(), "leaks")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mixture with the operator's target weights takes."""
    return mixing.mixed_documents(docs, tables.read(spark, sf_dir, "labels"), "quality", mixing.WEIGHTS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document left."""
    return kd_shards.kd_shards(docs, target_bytes=SHARD_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Trained models, similarity components and fitted rates have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tables.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = tables.scratch(stage(spark, docs, sf_dir), name)
    return docs
