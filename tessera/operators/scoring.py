"""Distributed scoring: class probabilities and arg-max for every row.

The model is one file that the workers of a host map together (``shared_model``; a small one
travels in the closure); rows stream through ``mapInArrow``, so scoring is one narrow stage with no shuffle, and the
kept columns pass through untouched (ids stay exact beside NULLs). Filter and prune *before* calling: the Python stage is
opaque to the optimizer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.shared_model import open_params, share_params
from tessera.plans.models import NetSpec, batch_input, predict


CLOSURE_BYTES = 1 << 20  # a smaller model travels with the closure


def score_batch(df: DataFrame, spec: NetSpec, params: dict, feature_col: str = "features",
                keep: list[str] | None = None, shared: str | None = None) -> DataFrame:
    """Adds ``probs ARRAY<DOUBLE>`` and ``predicted INT`` (first maximum wins)
    to the ``keep`` columns. ``shared``: the parameters' file, if ``share_params`` wrote it already."""
    keep = list(keep or [c for c in df.columns if c != feature_col])
    small = shared is None and sum(v.nbytes for v in params.values()) <= CLOSURE_BYTES
    path = None if small else shared or share_params(df.sparkSession, params)
    held = params if small else None
    # Kept columns travel under names of their own: they may repeat the feature column.
    out_schema = T.StructType(df.select(*keep).schema.fields + [
        T.StructField("probs", T.ArrayType(T.DoubleType())), T.StructField("predicted", T.IntegerType())])

    def score(batches):
        p_ = held if path is None else open_params(path)
        for b in batches:
            p = predict(spec, p_, batch_input(spec, _rows(b.column(0)))) if b.num_rows else np.zeros((0, 1))
            ends = pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32())
            probs = pa.ListArray.from_arrays(ends, pa.array(p.astype(np.float64).reshape(-1)))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], probs, pa.array(p.argmax(axis=1).astype(np.int32))],
                                             names=[*keep, "probs", "predicted"])

    cols = [F.col(feature_col).alias("_x")] + [F.col(k).alias(f"_{i}_{k}") for i, k in enumerate(keep)]
    return df.select(*cols).mapInArrow(score, out_schema)


def _rows(column: pa.Array) -> list:
    """A feature column as arrays or bytes, one per row."""
    if pa.types.is_list(column.type):
        flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
        return np.split(flat, ends[:-1])
    return column.to_pylist()


def predict_named(pred: DataFrame, vocab: DataFrame, actual_col: str = "actual",
                  predicted_col: str = "predicted") -> DataFrame:
    """Adds ``expected`` and ``predicted_name`` by joining the vocabulary twice."""
    v = vocab.select("label_idx", "label")
    e = v.select(F.col("label_idx").alias("_ai"), F.col("label").alias("expected"))
    p = v.select(F.col("label_idx").alias("_pi"), F.col("label").alias("predicted_name"))
    return (pred.join(e, F.col(actual_col) == F.col("_ai"), "left")
            .join(p, F.col(predicted_col) == F.col("_pi"), "left")
            .drop("_ai", "_pi"))
