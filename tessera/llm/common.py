"""Helpers shared by the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A key with more than 1 / HOT_SHARE of the rows is hot: fewer than HOT_SHARE
# keys can be, so the hot side of a join is a bounded broadcast.
HOT_SHARE = 10_000
HOT_LEAST = 200


def text_of(col: str | Column = "text") -> Column:
    """A text column with NULL read as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does exactly that to pure ASCII (as many
    bytes as code points) and is faster than ``translate``."""
    return (F.when(F.octet_length(c) == F.length(c), F.lower(c))
            .otherwise(F.translate(c, UPPER, UPPER.lower())))


def attach_by_key(rows: DataFrame, keyed: DataFrame, key: list[str], n_rows: int,
                  count_col: str = "n") -> DataFrame:
    """Inner join of ``rows`` (many per key) with ``keyed`` (one row per key;
    ``count_col`` says how many of ``rows`` carry it). Keys are compared
    null-safely.

    Hot keys are joined by broadcast, so a key that holds a third of the rows
    never meets in one task. At most ``HOT_SHARE`` keys can be hot (each has
    more than ``n_rows / HOT_SHARE`` rows), which bounds the broadcast; all
    other keys take an ordinary shuffle join. Both inputs should be written
    tables: they are scanned twice."""
    limit = max(HOT_LEAST, n_rows // HOT_SHARE)
    right = keyed.select(*[F.col(k).alias(f"_k_{k}") for k in key],
                         *[c for c in keyed.columns if c not in key])
    hot = right.filter(F.col(count_col) > limit)
    cold = right.filter(F.col(count_col) <= limit)

    def on(r):
        cond = F.lit(True)
        for k in key:
            cond = cond & rows[k].eqNullSafe(r[f"_k_{k}"])
        return cond

    names = [f"_k_{k}" for k in key]
    cold_rows = rows.join(cold, on(cold), "inner").drop(*names)
    hot_rows = rows.join(F.broadcast(hot), on(hot), "inner").drop(*names)
    return cold_rows.unionByName(hot_rows)


def bucket_rank(df: DataFrame, key: list[str], out: str, bits: int = 12) -> DataFrame:
    """Dense 0-based integer names for the distinct rows of ``df`` (unique on
    ``key``): rows are dealt to ``2**bits`` hash buckets, sorted inside each,
    and numbered after the rows of earlier buckets. Only the bucket offsets
    (at most ``2**bits`` rows) are broadcast. ``df`` is scanned twice."""
    from pyspark.sql import Window
    # xxhash64 of the whole key: uniform, the same on every run.
    tagged = df.withColumn("_b", F.shiftrightunsigned(F.xxhash64(*key), 64 - bits).cast("int"))
    counts = tagged.groupBy("_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy("_b").orderBy(*key)
    return (tagged.join(F.broadcast(offsets), "_b")
            .withColumn(out, (F.col("_o") + F.row_number().over(inside) - 1).cast("long"))
            .drop("_b", "_o"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: a Parquet table in the shared checkpoint folder."""
    return materialize(df, f"llm-{name}")


def count_rows(df: DataFrame) -> int:
    """Rows of a written table (Parquet footers only)."""
    return df.count()


def keep_rows(docs: DataFrame, keepers: DataFrame, key: dict[str, Column]) -> DataFrame:
    """Rows of ``docs`` whose ``key`` (name -> expression over ``docs``) is in
    ``keepers``, one row per key. ``keepers`` has one row per key, with columns of
    those names, and says in ``n_tied`` how many rows share it; only rows of tied
    keys are deduplicated. ``docs`` may have any column names: its rows travel packed."""
    tagged = docs.select(F.struct("*").alias("_row"), *[c.alias(k) for k, c in key.items()])
    right = keepers.select(*[F.col(k).alias(f"_k_{k}") for k in key], F.col("n_tied").alias("_tied"))
    cond = F.lit(True)
    for k in key:
        cond = cond & tagged[k].eqNullSafe(right[f"_k_{k}"])
    kept = tagged.join(right, cond, "inner")
    once = kept.filter(F.col("_tied") == 1).select("_row")
    tied = kept.filter(F.col("_tied") > 1).dropDuplicates([f"_k_{k}" for k in key]).select("_row")
    return once.unionByName(tied).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
