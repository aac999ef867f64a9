"""Tensor tables: labelled examples stored as Parquet arrays.

The canonical example row is ``id, label, label_idx, features ARRAY<FLOAT>``.
The given ``embeddings`` table (64 values, read as 8x8x1) is such a table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.arrays import array_sum
from tessera.session import table


def read_tensors(spark: SparkSession, path: str, id_col: str = "id", feature_col: str = "features",
                 label_col: str = "label") -> DataFrame:
    """A tensor table renamed to the canonical column names; only the three
    columns are read (column pruning reaches the Parquet scan)."""
    return (spark.read.parquet(path)
            .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                    F.col(feature_col).alias("features")))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given ``embeddings`` table as examples; its integer label is the class index."""
    return (table(spark, sf_dir, "embeddings")
            .select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("label"),
                    F.col("label").cast("int").alias("label_idx"), F.col("embedding").alias("features")))


def tensor_stats(df: DataFrame, feature_col: str = "features") -> DataFrame:
    """Per row: size and element sum -- a cheap integrity check of a tensor scan."""
    return df.select(*[c for c in df.columns if c != feature_col],
                     F.size(feature_col).cast("int").alias("n_values"),
                     F.round(array_sum(feature_col), 6).alias("elem_sum"))


def _packed(arr: pa.Array) -> pa.Array:
    """list<number> -> binary of float32 values, built from Arrow buffers."""
    arr = pa.concat_arrays([arr]) if arr.offset else arr  # no slice offsets
    offsets = arr.offsets.to_numpy().astype(np.int64)
    start, end = int(offsets[0]), int(offsets[-1])
    values = np.asarray(arr.values.slice(start, end - start).to_numpy(zero_copy_only=False), dtype=np.float32)
    byte_offsets = pa.array(((offsets - start) * 4).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(arr),
                                 [arr.buffers()[0], byte_offsets.buffers()[1], pa.py_buffer(values.tobytes())],
                                 null_count=arr.null_count)


def pack_tensors(df: DataFrame, col: str = "features") -> DataFrame:
    """Numeric-array column -> flat float32 ``BINARY`` (4 bytes per value).

    Parquet writes and reads flat binary far faster than nested arrays, and
    rows shrink; the closures unpack by ``NetSpec.packed``.
    Arrow-native per batch (``mapInArrow``): no per-row Python objects."""
    if not isinstance(df.schema[col].dataType, T.ArrayType):
        return df
    idx = df.columns.index(col)
    schema = T.StructType([T.StructField(col, T.BinaryType()) if f.name == col else f for f in df.schema.fields])

    def pack(batches):
        for rb in batches:
            cols = list(rb.columns)
            cols[idx] = _packed(cols[idx])
            yield pa.RecordBatch.from_arrays(cols, names=rb.schema.names)

    return df.mapInArrow(pack, schema)
