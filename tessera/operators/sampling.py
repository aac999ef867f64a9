"""Seeded, repeatable ordering, capping and train/test splitting.

Every random draw comes from ``md5('<seed>:<id>')`` -- a pure function of
the row, so results do not depend on partitioning, retries or file order.

Global row numbers are computed without routing all rows through one
partition: rows are placed in order-preserving buckets (the leading hex
digits of the md5 key, uniform by construction), counted per bucket with a
partial/final aggregate, and each row gets ``offset(bucket) + local rank``.
The offsets table has at most ``2**bits`` rows -- a proven bound -- so it is
the only side that is broadcast.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

DEFAULT_SEED = 42
# 2**16 order-preserving buckets: the offsets table stays a small bounded
# broadcast (about 2 MB). A bucket's window spills to disk when it outgrows
# memory; for tables of many billions of rows raise this to spread them thinner.
BUCKET_BITS = 16


def seeded_key(id_col: str | Column, seed: int = DEFAULT_SEED) -> Column:
    """Hex md5 of '<seed>:<id>'; the random order key of a row."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws(":", F.lit(str(seed)), c.cast("string")))


def _bucket_of(key: Column, bits: int) -> Column:
    # Leading hex digits of the key: monotone in key order, uniform for md5.
    return F.conv(F.substring(key, 1, bits // 4), 16, 10).cast("int")


def _bucket_offsets(tagged: DataFrame) -> DataFrame:
    """Per non-empty bucket: ``_cnt`` rows, ``_off`` rows in earlier buckets,
    ``_total`` rows. At most ``2**bits`` rows: the broadcast side by proof."""
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", "_cnt",
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
    )
    return offsets


def _rank_in_buckets(joined: DataFrame, key_col: str, tie_col: str, out: str,
                     range_partitions: int | bool | None = None) -> DataFrame:
    """``out = _off + rank inside the bucket``. With ``range_partitions`` the
    rows are range-partitioned by bucket first (the window then needs no
    exchange of its own, and each task holds one contiguous run of positions).
    ``True`` leaves the partition count to the session (AQE may coalesce)."""
    if range_partitions is True:
        joined = joined.repartitionByRange("_bucket")
    elif range_partitions:
        joined = joined.repartitionByRange(range_partitions, "_bucket")
    local = Window.partitionBy("_bucket").orderBy(F.col(key_col), F.col(tie_col))
    # A repeated id has no repeatable place: it fails here at any size. The check
    # sits inside the number itself, so it can't be pruned while the number is read.
    again = F.lag(F.col(tie_col).cast("string")).over(local).eqNullSafe(F.col(tie_col).cast("string")) & (
        F.row_number().over(local) > 1)
    number = F.when(again, F.raise_error(F.lit("the id column repeats; ids must be unique")).cast("long")).otherwise(
        F.col("_off") + F.row_number().over(local))
    return joined.withColumn(out, number.cast("long"))


def hash_row_number(df: DataFrame, key_col: str, tie_col: str, out: str = "rn",
                    total_col: str | None = "n_total", bits: int = BUCKET_BITS,
                    max_rn: int | None = None, range_partitions: int | bool | None = None) -> DataFrame:
    """1-based global row number in ``(key_col, tie_col)`` order, where
    ``key_col`` is a hex md5 key. Adds ``total_col`` (row count) if given.

    With ``max_rn`` only rows numbered up to it are returned, and buckets
    that start after it are dropped *before* the shuffle: a cap of n rows
    moves about n + one bucket of rows, whatever the table size.

    The input is evaluated twice: once for the bucket counts (projected to
    the key, so a Parquet scan reads one column) and once for the ranking.
    Materialize an expensive input first (``session.materialize``)."""
    tagged = df.withColumn("_bucket", _bucket_of(F.col(key_col), bits))
    offsets = _bucket_offsets(tagged)
    if max_rn is not None:
        offsets = offsets.filter(F.col("_off") < max_rn)
    ranked = _rank_in_buckets(tagged.join(F.broadcast(offsets), "_bucket"), key_col, tie_col, out,
                              range_partitions)
    if max_rn is not None:
        ranked = ranked.filter(F.col(out) <= max_rn)
    if total_col:
        ranked = ranked.withColumn(total_col, F.col("_total").cast("long"))
    return ranked.drop("_bucket", "_cnt", "_off", "_total")


def range_row_number(df: DataFrame, order_cols: list[str], out: str = "rn",
                     num_partitions: int | None = None, path: str | None = None) -> DataFrame:
    """1-based global row number for any total order (ties must not occur).

    Range-partitions, sorts inside partitions and tags each row with its
    partition-local index; the tagged frame is written to the checkpoint
    folder (or ``path``) first so both passes (counts, numbering) see the same placement."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "rownum", path=path)
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"),
                                         F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first",
                            F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    # offsets has one row per partition: bounded by ``n``.
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("long"))
            .drop("_pid", "_mid", "_first", "_off"))


def seeded_shuffle(df: DataFrame, id_col: str, seed: int = DEFAULT_SEED,
                   key_col: str = "order_key", out: str = "rn") -> DataFrame:
    """Random but repeatable order: adds the md5 key and the 1-based position."""
    keyed = df.withColumn(key_col, seeded_key(id_col, seed))
    return hash_row_number(keyed, key_col, id_col, out=out, total_col=None)


def sample_cap(df: DataFrame, id_col: str, max_rows: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """At most ``max_rows`` rows drawn at random (the first ones in seeded order).

    Not ``orderBy().limit()``: its final merge takes partitions x max_rows
    rows in one task. The bucket-pruned rank moves about max_rows rows."""
    keyed = df.withColumn("_key", seeded_key(id_col, seed))
    ranked = hash_row_number(keyed, "_key", id_col, out="_rn", total_col=None, max_rn=max_rows)
    return ranked.drop("_key", "_rn")


def split_exact(df: DataFrame, id_col: str, train_share: float = 0.8,
                seed: int = DEFAULT_SEED) -> DataFrame:
    """Exact-quota split: the first ``round(share * n)`` rows of the seeded
    order are 'train', the rest 'test'. Adds ``order_key``, ``rn`` (position
    in the whole order), ``split``, ``split_rn`` (position in its split) and
    ``n_split`` (rows in its split)."""
    keyed = df.withColumn("order_key", seeded_key(id_col, seed))
    ranked = hash_row_number(keyed, "order_key", id_col, out="rn", total_col="_n")
    n_train = F.round(F.lit(float(train_share)) * F.col("_n")).cast("long")
    is_train = F.col("rn") <= n_train
    return (ranked
            .withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
            .withColumn("split_rn", F.when(is_train, F.col("rn")).otherwise(F.col("rn") - n_train))
            .withColumn("n_split", F.when(is_train, n_train).otherwise(F.col("_n") - n_train))
            .drop("_n"))


def split_side(df: DataFrame, id_col: str, side: str = "train", train_share: float = 0.8,
               seed: int = DEFAULT_SEED, positions: bool = True,
               range_partitions: int | bool | None = None) -> DataFrame:
    """The rows of one side of ``split_exact``, without moving the other side.

    Buckets wholly on the other side are dropped before any shuffle (a
    broadcast join with the bounded offsets table). With ``positions`` the
    side's rows are ranked (``rn``, ``split_rn``). Without it the rows are read
    once and not shuffled: only keys and ids of the one bucket that straddles the
    quota (about n / 65,536) are ranked, to find the last row of 'train'; that
    row's key and id decide the bucket, every other row is placed by its bucket."""
    if side not in ("train", "test"):
        raise ValueError("side must be 'train' or 'test'")
    tagged = (df.withColumn("order_key", seeded_key(id_col, seed))
              .withColumn("_bucket", _bucket_of(F.col("order_key"), BUCKET_BITS)))
    nt = F.round(F.lit(float(train_share)) * F.col("_total")).cast("long")
    offsets = _bucket_offsets(tagged).withColumn("_nt", nt)
    if side == "train":
        offsets = offsets.filter(F.col("_off") < F.col("_nt"))
    else:
        offsets = offsets.filter(F.col("_off") + F.col("_cnt") > F.col("_nt"))
    n_split = F.col("_nt") if side == "train" else F.col("_total") - F.col("_nt")
    if positions:
        in_side = (F.col("rn") <= F.col("_nt")) if side == "train" else (F.col("rn") > F.col("_nt"))
        joined = tagged.join(F.broadcast(offsets), "_bucket")
        ranked = _rank_in_buckets(joined, "order_key", id_col, "rn", range_partitions).filter(in_side)
        ranked = ranked.withColumn("split_rn", F.col("rn") if side == "train" else F.col("rn") - F.col("_nt"))
    else:
        place = F.struct(F.col("order_key"), F.col(id_col).alias("_id"))
        edge = offsets.filter((F.col("_off") < F.col("_nt")) & (F.col("_off") + F.col("_cnt") > F.col("_nt")))
        inside = _rank_in_buckets(tagged.select(id_col, "order_key", "_bucket").join(F.broadcast(edge), "_bucket"),
                                  "order_key", id_col, "rn")
        # At most one row: the last one of 'train' in the bucket of the quota.
        last = inside.filter(F.col("rn") <= F.col("_nt")).groupBy("_bucket").agg(F.max(place).alias("_last"))
        placed = tagged.join(F.broadcast(offsets.join(F.broadcast(last), "_bucket", "left")), "_bucket")
        beyond = (place <= F.col("_last")) if side == "train" else (place > F.col("_last"))
        ranked = placed.filter(F.col("_last").isNull() | beyond).drop("_last")
    return (ranked.withColumn("split", F.lit(side)).withColumn("n_split", n_split.cast("long"))
            .drop("_bucket", "_cnt", "_off", "_total", "_nt"))


def hash_threshold(share: float) -> str | None:
    """Hex threshold on the first 8 key digits for a share; None means all."""
    if share >= 1.0:
        return None
    return "%08x" % max(0, math.ceil(share * 2 ** 32))


def split_hash(df: DataFrame, id_col: str, train_share: float = 0.8,
               seed: int = DEFAULT_SEED) -> DataFrame:
    """Sort-free split: a narrow filter on the key; share holds in expectation.
    Works on streams as well as tables."""
    thr = hash_threshold(train_share)
    key8 = F.substring(seeded_key(id_col, seed), 1, 8)
    is_train = F.lit(True) if thr is None else key8 < F.lit(thr)
    return df.withColumn("split", F.when(is_train, F.lit("train")).otherwise(F.lit("test")))
