"""Bottom-k sketches of shingle hashes (DataFrame functions only).

A sketch is the ``k`` smallest distinct 64-bit hashes of a text's word shingles (five
words; a shorter text is one shingle, a text without words has none), as a sorted
array. Sketches of parts merge to the sketch of the whole; two sketches estimate
resemblance and containment, and one the number of distinct shingles.

At scale: a sketch is a narrow expression over the text. ``with_next`` brings each
document its neighbour's text with one exchange of the texts: ids are dealt to ranges of
about equal counts (cuts from a quantile sketch), the largest id of each range is dealt to the
range above as well, and ``lead`` runs inside the ranges, so no task sees more than one range.
``merge`` reduces each group in salted parts first, so a hot group never meets in one task
with more than ``SALTS * k`` hashes.

Defined cases: NULL text counts as empty; a NULL doc_id sorts below all others; rows with
equal doc_id are neighbours in order of text; a single document is its own next one; two
empty sketches resemble each other fully, an empty and another not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of

K = 128
SHINGLE = 5
SALTS = 64
RANGES_PER_PARTITION = 4
MAX_RANGES = 4096
SPACE = r"[\x20\x09-\x0D]+"


def with_sketch(df: DataFrame, text: Column, out: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``df`` plus the sketch of ``text`` in ``out`` (array<long>)."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    step = df.withColumn("_h", F.transform(words, lambda w: F.xxhash64(w)))
    # ``_h`` is read many times, so Spark computes it once per row, below.
    at = F.sequence(F.lit(0), F.greatest(F.size("_h") - shingle, F.lit(0)))
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col("_h"), i + j) for j in range(shingle)]))
    hashes = F.when(F.size("_h") > 0, hashes).otherwise(F.expr("array()").cast("array<bigint>"))
    return step.withColumn(out, bottom(hashes, k)).drop("_h")


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merge_two(a: Column, b: Column, k: int = K) -> Column:
    return bottom(F.concat(a, b), k)


def merge(df: DataFrame, group: list[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group, from the sketches of its parts."""
    hashes = df.select(*group, F.explode(sketch).alias("_h")).dropDuplicates([*group, "_h"])
    salt = F.pmod(F.xxhash64("_h"), F.lit(SALTS)).cast("int")
    for keys in ([*group, "_s"], group):
        w = Window.partitionBy(*keys).orderBy("_h")
        hashes = hashes.withColumn("_s", salt).withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return hashes.groupBy(*group).agg(F.sort_array(F.collect_list("_h")).alias(sketch))


def _shared(a: Column, b: Column, k: int) -> tuple[Column, Column]:
    union = merge_two(a, b, k)
    return F.size(F.array_intersect(F.array_intersect(a, b), union)), F.size(union)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated |A and B| / |A or B|."""
    both, union = _shared(a, b, k)
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below k)."""
    kth = (F.get(a, F.lit(k - 1)).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(float(k - 1)) / kth)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that B has."""
    n_union = distinct_count(merge_two(a, b, k), k)
    share = resemblance(a, b, k) * n_union / distinct_count(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def as_text(a: Column) -> Column:
    """Hex digits of the hashes, 16 each."""
    return F.array_join(F.transform(a, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, next_text and _range, in descending doc_id order; the last
    row's next one is the first."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs[text_col]).alias("text"),
                      F.coalesce(F.col(id_col).cast("long"), F.lit(-2 ** 63)).alias("_id"))
    n = min(MAX_RANGES, RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = own.agg(F.percentile_approx("_id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    number = F.lit(0)
    if cuts:
        # First among every 64th cut, then among the 64 that follow it.
        coarse = F.array(*[F.lit(c) for c in cuts[::64]])
        fine = F.array(*[F.array(*[F.lit(c) for c in cuts[i:i + 64]]) for i in range(0, len(cuts), 64)])
        group = F.greatest(F.size(F.filter(coarse, lambda c: c < F.col("_id"))) - 1, F.lit(0))
        number = group * 64 + F.size(F.filter(F.get(fine, group), lambda c: c < F.col("_id")))
    own = own.withColumn("_range", number)
    heads = own.groupBy("_range").agg(F.max("_id").alias("_head"))  # at most MAX_RANGES rows
    rows = sorted((r["_range"], r["_head"]) for r in heads.collect())
    above = [(head, rows[(i + 1) % len(rows)][0]) for i, (_, head) in enumerate(rows)]
    extra = F.broadcast(spark.createDataFrame(above, "_head long, _also int"))
    copies = F.when(F.col("_also").isNull(), F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy"))))
    copies = copies.otherwise(F.array(F.struct(F.col("_range").alias("r"), F.lit(0).alias("copy")),
                                      F.struct(F.col("_also").alias("r"), F.lit(1).alias("copy"))))
    dealt = (own.join(extra, own["_id"] == extra["_head"], "left")
             .select("doc_id", "_id", "text", F.explode(copies).alias("_c"))
             .select("doc_id", "_id", "text", F.col("_c.r").alias("_range"), F.col("_c.copy").alias("_copy")))
    order = Window.partitionBy("_range").orderBy("_copy", F.desc("_id"), "text")
    return dealt.withColumn("next_text", F.lead("text").over(order))


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K,
               shingle: int = SHINGLE) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, sketch, edited_sketch, next_sketch.
    The edited text has its last third replaced by the start of the next text."""
    near = with_next(docs, id_col, text_col)
    near = near.withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    near = near.withColumn("_edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut))).drop("next_text")
    near = with_sketch(near, F.col("text"), "sketch", k, shingle)
    order = Window.partitionBy("_range").orderBy("_copy", F.desc("_id"), "text")
    near = near.withColumn("next_sketch", F.lead("sketch").over(order)).filter("_copy = 0")
    near = near.withColumn("edited_sha256", F.sha2("_edited", 256))
    near = with_sketch(near, F.col("_edited"), "edited_sketch", k, shingle)
    return near.select("doc_id", "n_chars", "edited_sha256", "sketch", "edited_sketch", "next_sketch")
