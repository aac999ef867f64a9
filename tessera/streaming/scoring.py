"""Scoring and evaluation of tensor files as they arrive (Structured Streaming).

The same operators as the batch path: the sort-free hash split (a narrow
filter, so it is stream-safe), the Arrow-batched scorer and the confusion
count, which becomes a stateful streaming aggregate. State is one row per
(actual, predicted) pair -- bounded by classes^2, whatever the stream size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.evaluation import confusion_matrix
from tessera.operators.sampling import split_hash
from tessera.operators.scoring import score_batch
from tessera.plans.models import NetSpec

TENSOR_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("label_idx", T.IntegerType()),
    T.StructField("features", T.ArrayType(T.FloatType())),
])


def read_tensor_stream(spark: SparkSession, folder: str, schema: T.StructType = TENSOR_SCHEMA,
                       max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def scored_stream(stream: DataFrame, spec: NetSpec, params: dict, test_only: bool = True,
                  train_share: float = 0.8, seed: int = 42) -> DataFrame:
    """``id, actual, probs, predicted`` for every arriving row (or only the
    rows the hash split puts in 'test')."""
    s = stream
    if test_only:
        s = split_hash(s, "id", train_share, seed).filter(F.col("split") == "test").drop("split")
    return score_batch(s.select("id", F.col("label_idx").alias("actual"), "features"),
                       spec, params, keep=["id", "actual"])


def start_scoring(stream: DataFrame, spec: NetSpec, params: dict, sink_path: str,
                  checkpoint: str, test_only: bool = True) -> StreamingQuery:
    """Append predictions to a Parquet sink; restarts resume from ``checkpoint``."""
    return (scored_stream(stream, spec, params, test_only).drop("probs")
            .writeStream.format("parquet").option("path", sink_path)
            .option("checkpointLocation", checkpoint).outputMode("append").start())


def start_confusion(stream: DataFrame, spec: NetSpec, params: dict, query_name: str,
                    checkpoint: str, test_only: bool = True) -> StreamingQuery:
    """Running confusion counts, kept as streaming state, to a memory table."""
    cm = confusion_matrix(scored_stream(stream, spec, params, test_only))
    return (cm.writeStream.format("memory").queryName(query_name)
            .option("checkpointLocation", checkpoint).outputMode("complete").start())
