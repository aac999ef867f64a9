"""Corpus pipeline: toxicity filter, exact dedup, near dedup, source mixing, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` writes what each stage returns as Parquet and hands it on reread. All but
the last stage return the columns they were given. No SQL can express the learned and
packing stages, so ``ORACLE_SQL`` is None and tests compare with a brute-force version.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup, mixing, packing, simhash, toxicity
from tessera.llm.common import written
from tessera.llm.queries import learnable
from tessera.session import ship_package, table

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    ship_package(spark)
    model = toxicity.fit(docs, learnable(table(spark, sf_dir, "labels"), "toxic", 5, 0))
    score = toxicity.score_column(spark, model, docs["text"])
    packed = docs.select(F.struct("*").alias("_row"), score.alias("_score"))
    return packed.filter(F.col("_score") < TOXIC_FROM).select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return exact_dedup.dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return simhash.dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies),
          ("mixing sources to target weights", mix_sources), ("best-fit packing", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
