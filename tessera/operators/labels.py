"""Label vocabulary: distinct class names in alphabetical order, 0-based."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.sampling import range_row_number


def label_vocab(df: DataFrame, label_col: str = "label", with_counts: bool = True,
                path: str | None = None) -> DataFrame:
    """``label_idx INT, label STRING[, n_examples BIGINT]``.

    Distinct first (partial + final aggregate), then a distributed global
    rank, so even a vocabulary with millions of names never sits in one task.
    ``path`` names the folder of the written names (default: a new scratch folder)."""
    agg = [F.count(F.lit(1)).alias("n_examples")] if with_counts else []
    labels = df.select(F.col(label_col).cast("string").alias("label")).filter(F.col("label").isNotNull())
    distinct = labels.groupBy("label").agg(*agg) if agg else labels.distinct()
    ranked = range_row_number(distinct, ["label"], out="_rn", path=path)
    return ranked.select((F.col("_rn") - 1).cast("int").alias("label_idx"), "label",
                         *(["n_examples"] if with_counts else []))


BROADCAST_LABELS = 100_000  # names a broadcast dictionary may hold
LABEL_SALTS = 32


def index_labels(df: DataFrame, vocab: DataFrame, label_col: str = "label", salt_col: str | None = None,
                 broadcast_labels: int = BROADCAST_LABELS) -> DataFrame:
    """Adds ``label_idx`` by an equi-join on the label name (unknown -> NULL).

    The vocabulary is counted first. Up to ``broadcast_labels`` names it is a broadcast
    dictionary, and the examples' wide rows stay where they are. A larger one is joined by
    shuffle, each name ``LABEL_SALTS`` times, with the examples dealt over the salts by a hash
    of ``salt_col`` (their id; by default all other columns but the widest types), so a label
    that holds a third of the rows is spread over as many tasks."""
    v = vocab.select(F.col("label").alias("_lbl"), "label_idx")
    name = F.col(label_col).cast("string")
    if v.count() <= broadcast_labels:
        return df.join(F.broadcast(v), name == F.col("_lbl"), "left").drop("_lbl")
    by = [salt_col] if salt_col else [f.name for f in df.schema.fields
                                      if not isinstance(f.dataType, (T.ArrayType, T.BinaryType, T.MapType, T.StructType))]
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(LABEL_SALTS)).cast("int"))
    names = v.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1))))
    return salted.join(names, (name == F.col("_lbl")) & (F.col("_salt") == F.col("_s")), "left").drop("_lbl", "_salt", "_s")
