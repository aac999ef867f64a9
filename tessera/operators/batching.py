"""Mini-batches, their spread over workers and averaging rounds, and epochs.

A batch is a set of rows with the same ``batch_id`` -- a derived column,
never a driver-side list. ``worker`` and ``round`` follow from it:
round ``r`` gives worker ``w`` the batches ``b`` with ``b % W == w`` and
``b // (W * k) == r``, i.e. at most ``k`` batches per worker and round.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Averaging rounds an epoch should take at most: more rows get more workers, not more rounds.
TARGET_ROUNDS = 20
MIN_WORKERS = 2
MAX_WORKERS = 100_000  # Spark's limit on the buckets of a table


def worker_count(n_rows: int, batch_size: int, averaging_frequency: int, target_rounds: int = TARGET_ROUNDS) -> int:
    """Workers for ``n_rows`` training rows: an epoch takes about ``target_rounds``
    rounds whatever the number of rows, so parallelism grows with the data."""
    batches = math.ceil(n_rows / batch_size)
    return min(MAX_WORKERS, max(MIN_WORKERS, math.ceil(batches / (averaging_frequency * target_rounds))))


def batch_assign(df: DataFrame, rn_col: str, batch_size: int, workers: int = 1,
                 averaging_frequency: int = 1) -> DataFrame:
    """Adds ``batch_id``, ``pos`` (row in batch), ``worker`` and ``round`` from
    a 1-based position column. All batches are full except the last."""
    if batch_size < 1 or workers < 1 or averaging_frequency < 1:
        raise ValueError("batch_size, workers and averaging_frequency must be >= 1")
    i = F.col(rn_col) - 1
    batch_id = F.floor(i / batch_size).cast("long")
    return (df.withColumn("batch_id", batch_id)
            .withColumn("pos", (i % batch_size).cast("int"))
            .withColumn("worker", (F.col("batch_id") % workers).cast("int"))
            .withColumn("round", F.floor(F.col("batch_id") / (workers * averaging_frequency)).cast("long")))


def epoch_repeat(df: DataFrame, epochs: int, n_batches_col: str | None = None) -> DataFrame:
    """Every row once per epoch (a generator, not a join); adds ``epoch`` and,
    when the per-epoch batch count is known, a global ``step``."""
    if epochs < 1:
        raise ValueError("epochs must be >= 1")
    out = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    if n_batches_col:
        out = out.withColumn("step", F.col("epoch") * F.col(n_batches_col) + F.col("batch_id"))
    return out
