"""Mixing sources to target weights (DataFrame functions only).

Words are summed per source, each source gets a target, and every document is
emitted ``floor(rate)`` times plus one more copy with probability equal to the
rate's fraction, drawn from a hash of the seed and the document id. Rows that share an id
(or have none) draw apart: from the hash of seed, id, text, source and the row's number among
rows that are equal in these.

Targets share the words of all sources by weight; a target stops at ``cap`` times
its source's words and what it can't take goes to the others by weight, until
none is above. With integer weights every step is exact integer sums and one
division, so reruns agree to the bit.

Plan at scale: one scan of the text for the word counts; sums per source are
partial/final aggregates, so a hot source costs nothing extra. The shares need
only two sums per round over the source table, so no source list meets in one
task. Rates go back to the documents by broadcast if there are at most
``BROADCAST_SOURCES`` sources, by a shuffle join with hot sources broadcast
otherwise. Only rows whose id repeats are numbered: by task first, then across tasks, so
an id or a row that a third of the table repeats is never one group.

Defined cases: NULL text has size 0; a NULL source is a source of its own, last in
order; a source without words keeps its documents once (rate 1, target 0); rows
that share a doc_id, NULL ones too, draw apart, and which of two equal rows gets which draw
makes no difference; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import HOT_LEAST, HOT_SHARE, attach_by_key, count_rows, text_of, written
from tessera.operators.sampling import range_row_number

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 42
BROADCAST_SOURCES = 100_000


def word_count(c: Column) -> Column:
    return F.regexp_count(text_of(c), F.lit(WORD)).cast("long")


def draw(key: Column, seed: int) -> Column:
    """Uniform in [0, 1): the first 52 bits of md5('<seed>:<key>')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def with_draws(rows: DataFrame, seed: int) -> DataFrame:
    """``rows`` (with ``_id``, ``source`` and ``_text``, a hash of the text) plus their draw ``_u``. Rows are read twice."""
    counts = rows.groupBy("_id").agg(F.count(F.lit(1)).alias("n"))
    tied = written(counts.filter("n > 1").withColumnRenamed("_id", "_tied"), "tied-ids")
    if tied.first() is None:
        return rows.withColumn("_u", draw(F.col("_id"), seed))
    limit = max(HOT_LEAST, rows.count() // HOT_SHARE)
    on = F.col("_id").eqNullSafe(F.col("_tied"))
    hot = rows.join(F.broadcast(tied.filter(F.col("n") > limit)), on, "left")  # at most HOT_SHARE ids
    cold = hot.filter("n IS NULL").drop("_tied", "n").join(tied.filter(F.col("n") <= limit), on, "left")
    single = cold.filter("n IS NULL").drop("_tied", "n").withColumn("_u", draw(F.col("_id"), seed))
    many = hot.filter("n IS NOT NULL").unionByName(cold.filter("n IS NOT NULL")).drop("_tied", "n")
    return single.unionByName(_numbered_draws(many, seed))


def _numbered_draws(rows: DataFrame, seed: int) -> DataFrame:
    """Draws of rows that share ids, by id, text, source and number among equals. Which of the
    equals has which number is left to the tasks: as a whole they draw the same."""
    placed = written(rows.withColumn("_pid", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "tied-rows")
    keys = ["_id", "_text", "source", "_pid"]
    before = Window.partitionBy("_id", "_text", "source").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    first = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).select(
        *[F.col(k).alias(f"_k{k}") for k in keys], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*keys).orderBy("_at")
    match = [F.col(k).eqNullSafe(F.col(f"_k{k}")) for k in keys]
    numbered = placed.withColumn("_no", F.row_number().over(inside)).join(first, match[0] & match[1] & match[2] & match[3])
    key = F.concat_ws(":", F.coalesce(F.col("_id").cast("string"), F.lit("null")), F.col("_text"),
                      F.coalesce(F.md5("source"), F.lit("null")), F.col("_first") + F.col("_no"))
    return numbered.withColumn("_u", draw(key, seed)).drop("_pid", "_at", "_no", "_first", *[f"_k{k}" for k in keys])


def source_sizes(rows: DataFrame) -> DataFrame:
    """Per source of ``rows`` (source, size): source_size and n rows. A written table."""
    return written(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")),
                   "sources")


def source_targets(per_source: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``per_source`` (source, source_size, n) plus target words and rate."""
    w = F.array(*[F.lit(int(x)) for x in weights])
    placed = range_row_number(per_source.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "rn")
    src = written(placed.select("source", "source_size", "n",
                                F.get(w, ((F.col("rn") - 1) % len(weights)).cast("int")).cast("long").alias("weight")),
                  "weights")

    def big(c):  # products of corpus-wide counts can pass 64 bits
        return c.cast("decimal(19,0)")

    def is_full(words, weight):
        return big(cap * F.col("source_size")) * big(F.lit(weight)) <= big(F.col("weight")) * big(F.lit(words))

    first = src.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    total = words = first["t"] or 0
    weight = first["w"] or 1
    # The share of one unit of weight only grows from round to round, so a full
    # source stays full; each round is one aggregate over the source table.
    while True:
        full = is_full(words, weight)
        row = src.agg(F.sum(F.when(full, cap * F.col("source_size"))).alias("full"),
                      F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        left, open_weight = total - (row["full"] or 0), row["open"] or 0
        if open_weight == 0 or (left, open_weight) == (words, weight):
            break
        words, weight = left, open_weight
    target = F.when(is_full(words, weight), (cap * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * F.lit(words)).cast("double") / F.lit(float(weight)))
    return src.select("source", "source_size", "n", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size")))
        .otherwise(F.lit(1.0)))


def _with_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    rates = written(rates, "rates")
    if count_rows(rates) <= BROADCAST_SOURCES:
        r = rates.withColumnRenamed("source", "_source")
        return rows.join(F.broadcast(r), rows["source"].eqNullSafe(r["_source"]), "inner").drop("_source")
    return attach_by_key(rows, rates, ["source"], rows.count())


def copies() -> Column:
    whole = F.floor("rate")
    return (whole + (F.col("_u") < F.col("rate") - whole).cast("long")).cast("long")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """Per input row: doc_id, size, source, source_size, target, copies, taken."""
    sizes = written(docs.select(F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
                                word_count(docs[text_col]).alias("size"), F.xxhash64(text_of(docs[text_col])).alias("_text")), "sizes")
    return (_with_rates(with_draws(sizes, seed), source_targets(source_sizes(sizes), weights, cap))
            .withColumn("copies", copies())
            .select(F.col("_id").alias("doc_id"), "size", "source", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as its draw says."""
    per = source_sizes(docs.select(F.col(source_col).cast("string").alias("source"),
                                   word_count(docs[text_col]).alias("size")))
    rates = source_targets(per, weights, cap).select("source", "rate", "n")
    # Own names for what the joins add: the documents may have any columns.
    packed = docs.select(F.struct("*").alias("_row"), F.col(source_col).cast("string").alias("source"),
                         F.col(id_col).alias("_id"), F.xxhash64(text_of(docs[text_col])).alias("_text"))
    mixed = _with_rates(with_draws(packed, seed), rates).withColumn("_copies", copies())
    out = mixed.filter("_copies > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_c"))
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
