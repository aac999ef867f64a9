"""Parameter averaging: element-wise (weighted) mean of model chunks over workers.

Input rows are ``param, chunk, values[, weight]`` -- one per worker and
chunk. Two encodings of ``values``:

* ``ARRAY<DOUBLE>``: the mean runs as a JVM vector aggregate
  (``Summarizer``) with map-side partial aggregation.
* ``BINARY`` (raw float bytes, as the training closures emit them): the
  mean runs in NumPy per ``(param, chunk)`` group. Large float arrays cross
  the Python/JVM boundary several times faster as bytes than as arrays. An
  optional ``value_bytes`` column says how each row is encoded (4: float32,
  8: float64, the default), so float32 models ship half the bytes; sums are
  kept in float64 and results are float64. With a worker id column the sum
  runs as a tree whose every group holds at most ``FANIN`` chunks, whatever
  the worker count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 65536  # values per model chunk; bounds the row size of a chunk
FANIN = 64     # most chunks one reducer group combines


def _is_binary(df: DataFrame) -> bool:
    return isinstance(df.schema["values"].dataType, T.BinaryType)


def _decode(b, value_bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=np.float32 if value_bytes == 4 else np.float64).astype(np.float64)


def _weighted_sums(keys, carry, divide=False):
    """Grouped reducer: sum of w * v and of w, and the ``carry`` ("sum" or
    "max", None for none) of the second count; with ``divide`` the mean
    sum(w * v) / sum(w) instead of the sum."""
    def reduce(key, pdf):
        # Arrival order after a shuffle varies; a fixed order makes the float
        # sum, and so a retried round, reproduce bit for bit.
        pdf = pdf.sort_values(["values", "_w"], kind="stable")
        w = pdf["_w"].to_numpy(dtype=np.float64)
        acc = None
        for wi, b, nb in zip(w, pdf["values"], pdf["_vb"]):
            v = _decode(b, nb) * wi
            acc = v if acc is None else acc + v
        if divide:
            acc = acc / w.sum()
        row = dict(zip(keys, key))
        row.update(values=acc.tobytes(), _vb=8, _w=float(w.sum()))
        if carry:
            row["_n"] = int(pdf["_n"].agg(carry))
        return pd.DataFrame([row])
    return reduce


def _binary_reduce(chunks: DataFrame, weight_col: str | None, keys: tuple, mean: bool,
                   count_col: str | None = None, fanin_col: str | None = None,
                   fanin_workers: int = 1) -> DataFrame:
    key_schema = [chunks.schema[k] for k in keys]
    carry = ("max" if mean else "sum") if count_col else None
    fields = key_schema + [T.StructField("values", T.BinaryType()), T.StructField("_vb", T.IntegerType()),
                           T.StructField("_w", T.DoubleType())]
    if count_col:
        fields.append(T.StructField("_n", T.LongType()))
    schema = T.StructType(fields)
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    vb = F.col("value_bytes").cast("int") if "value_bytes" in chunks.columns else F.lit(8)
    cols = ([*keys, "values", vb.alias("_vb"), w.alias("_w")]
            + ([F.col(count_col).cast("long").alias("_n")] if count_col else []))
    src = chunks.select(*cols, *([F.col(fanin_col)] if fanin_col else []))
    groups = -(-fanin_workers // FANIN)
    if not fanin_col or groups <= 1:
        out = src.groupBy(*keys).applyInPandas(_weighted_sums(keys, carry, mean), schema)
        return _finish(out, keys, mean, count_col)
    # A reduction tree: every level sums groups of at most FANIN rows per
    # chunk (consecutive ids), until at most FANIN partial sums are left.
    part_keys = (*keys, "_g")
    part_schema = T.StructType([*key_schema, T.StructField("_g", T.LongType()), *fields[len(keys):]])
    cur = (src.withColumn("_g", F.floor(F.col(fanin_col) / FANIN).cast("long"))
           .groupBy(*part_keys).applyInPandas(_weighted_sums(part_keys, carry), part_schema)
           .withColumnRenamed("_w", "_w0"))
    while groups > FANIN:
        cur = (cur.withColumn("_g", F.floor(F.col("_g") / FANIN).cast("long"))
               .groupBy(*part_keys).applyInPandas(_sum_partials(part_keys, carry), part_schema)
               .withColumnRenamed("_w", "_w0"))
        groups = -(-groups // FANIN)
    cur = cur.select(*keys, "values", "_vb", "_w0", *(["_n"] if count_col else []))
    return _finish(cur.groupBy(*keys).applyInPandas(_sum_partials(keys, carry, mean), schema),
                   keys, mean, count_col)


def _sum_partials(keys, carry, divide=False):
    def reduce(key, pdf):
        pdf = pdf.sort_values(["values", "_w0"], kind="stable")
        acc = None
        for b, nb in zip(pdf["values"], pdf["_vb"]):
            v = _decode(b, nb)
            acc = v if acc is None else acc + v
        if divide:
            acc = acc / float(pdf["_w0"].sum())
        row = dict(zip(keys, key))
        row.update(values=acc.tobytes(), _vb=8, _w=float(pdf["_w0"].sum()))
        if carry:
            row["_n"] = int(pdf["_n"].agg(carry))
        return pd.DataFrame([row])
    return reduce


def _finish(reduced: DataFrame, keys: tuple, mean: bool, count_col: str | None) -> DataFrame:
    if not mean:
        return reduced.select(*keys, "values", F.col("_n").alias(count_col))
    return reduced.select(*keys, "values", F.col("_w").alias("weight"),
                          *([F.col("_n").alias(count_col)] if count_col else []))


def param_average(chunks: DataFrame, weight_col: str | None = None,
                  keys: tuple = ("param", "chunk"), fanin_col: str | None = None,
                  fanin_workers: int = 1, max_col: str | None = None) -> DataFrame:
    """``param, chunk, values[, weight]`` averaged to ``param, chunk, values, weight``
    (``weight`` = summed weights). Binary values come back as float64 bytes.
    ``fanin_col`` holds ids 0..``fanin_workers``-1 that shape the reduction
    tree; without it one group takes every row of a chunk, so pass it
    whenever the number of rows per chunk is not small by construction.
    ``max_col`` (binary values only) adds the largest of a whole-number column."""
    if _is_binary(chunks):
        return _binary_reduce(chunks, weight_col, keys, True, max_col, fanin_col, fanin_workers)
    vec = array_to_vector(F.col("values"))
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    return (chunks.select(*keys, vec.alias("_v"), w.alias("_w"))
            .groupBy(*keys)
            .agg(Summarizer.mean(F.col("_v"), F.col("_w")).alias("_m"),
                 F.sum("_w").alias("weight"))
            .select(*keys, vector_to_array(F.col("_m")).alias("values"), "weight"))


def param_sum(chunks: DataFrame, count_col: str, keys: tuple = ("param", "chunk"),
              fanin_col: str | None = None, fanin_workers: int = 1) -> DataFrame:
    """Element-wise sum of chunks over workers/partitions, plus the summed count."""
    if _is_binary(chunks):
        return _binary_reduce(chunks, None, keys, False, count_col=count_col, fanin_col=fanin_col,
                              fanin_workers=fanin_workers)
    return (chunks.select(*keys, array_to_vector(F.col("values")).alias("_v"), count_col)
            .groupBy(*keys)
            .agg(Summarizer.sum(F.col("_v")).alias("_s"), F.sum(count_col).alias(count_col))
            .select(*keys, vector_to_array(F.col("_s")).alias("values"), count_col))
