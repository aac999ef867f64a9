"""Exact dedup by deterministic block naming (DataFrame functions only).

Each normalised text is cut into fixed-size byte blocks. Equal blocks get the
same integer name and different blocks different names; adjacent names are then
paired and the pairs named again, halving the sequence each round, until each
text has one integer. Texts with the same number of blocks and the same final
name are equal byte for byte: no digest decides equality.

Plan at scale: block contents are shuffled once, pre-aggregated by map task (a
block text copied a million times leaves each task once). Later steps move only
integers. Names go back to their occurrences by the 64-bit hash of the block;
hashes that two different blocks share are found exactly and those few blocks
are named by content instead. Hot names are joined by broadcast
(``common.attach_by_key``). Rounds: log2 of the longest text in blocks, over the
texts that still have more than one name.

Defined cases: NULL text counts as empty; an empty table gives an empty result;
a NULL doc_id sorts below every other; rows tied on the largest doc_id keep
exactly one row; extra columns are ignored by ``duplicate_groups`` and carried by
``dedup``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, attach_by_key, bucket_rank, count_rows, keep_rows, text_of, written

BLOCK_BYTES = 4096


def _normalised(docs: DataFrame, text_col: str) -> Column:
    return ascii_lower(text_of(docs[text_col])).cast("binary")


def _block_array(c: str, block: int) -> Column:
    # ``c`` must be a column computed below (it is read once per block).
    last = F.floor((F.greatest(F.octet_length(c), F.lit(1)) - 1) / block).cast("int")
    return F.transform(F.sequence(F.lit(0), last),
                       lambda i: F.substring(F.col(c), i * block + 1, F.lit(block)))


def block_hash(c: Column) -> Column:
    return F.xxhash64(c)


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               block: int = BLOCK_BYTES, hash_fn=block_hash) -> DataFrame:
    """One row per input row: ``rid`` (row number of this call), ``doc_id``,
    ``text_sha256`` (for reports only), ``n_blocks`` and ``name``; two rows have
    equal ``(n_blocks, name)`` exactly when their normalised texts are equal."""
    norm = docs.select(F.col(id_col).alias("doc_id"), _normalised(docs, text_col).alias("norm"))
    blocks = norm.select(F.explode(_block_array("norm", block)).alias("b")).select(hash_fn(F.col("b")).alias("h"), "b")
    # The only exchange of text: distinct blocks, pre-aggregated per map task.
    distinct = blocks.groupBy("h", "b").agg(F.count(F.lit(1)).alias("n"))
    by_hash = written(distinct.groupBy("h").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("variants")), "names")
    clashing = by_hash.filter("variants > 1").select("h")
    n_blocks_total = by_hash.agg(F.sum("n")).first()[0] or 0
    names = bucket_rank(by_hash, ["h"], "name").select("h", "name", "n", "variants")
    seqs = written(norm.select(
        "doc_id", F.sha2("norm", 256).alias("text_sha256"),
        F.transform(_block_array("norm", block), hash_fn).alias("hs"),
        F.monotonically_increasing_id().alias("rid")), "blocks")
    occ = seqs.select("rid", F.posexplode("hs").alias("pos", "h"))
    named = attach_by_key(occ, names, ["h"], n_blocks_total).select("rid", "pos", "h", "name", "variants")
    if not clashing.isEmpty():
        named = _by_content(norm, seqs, named, clashing, block, hash_fn, count_rows(by_hash))
    cur = written(seqs.select("rid", F.size("hs").alias("n_blocks"))
                  .join(named.select("rid", "pos", "name"), "rid"), "level0")
    done = [cur.filter("n_blocks = 1").select("rid", "n_blocks", "name")]
    width, longest = 1, cur.agg(F.max("n_blocks")).first()[0] or 1
    while width < longest:
        live = cur.filter(F.col("n_blocks") > width)
        pairs = (live.groupBy("rid", "n_blocks", F.floor(F.col("pos") / 2).alias("pos"))
                 .agg(F.min(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      # A last block without a partner pairs with -1, which is no name.
                      F.coalesce(F.min(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b")))
        pairs = written(pairs, "pairs")
        seen = written(pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")), "pairnames")
        cur = written(attach_by_key(pairs, bucket_rank(seen, ["a", "b"], "name"), ["a", "b"], count_rows(pairs))
                      .select("rid", "n_blocks", "pos", "name"), "level")
        width *= 2
        done.append(cur.filter(F.col("n_blocks") <= width).select("rid", "n_blocks", "name"))
    final = done[0]
    for d in done[1:]:
        final = final.unionByName(d)
    return written(seqs.select("rid", "doc_id", "text_sha256").join(final, "rid"), "identities")


def _by_content(norm, seqs, named, clashing, block, hash_fn, base):
    """Names for blocks whose hash another block shares: found by content,
    numbered after all other names (``base`` of them)."""
    few = F.broadcast(clashing)  # hashes with two texts: about rows**2 / 2**65 of them
    rows = norm.select(F.posexplode(_block_array("norm", block)).alias("pos", "b"), F.sha2("norm", 256).alias("sha"),
                       "doc_id").withColumn("h", hash_fn(F.col("b"))).join(few, "h", "left_semi")
    texts = written(rows.groupBy("h", "b").agg(F.count(F.lit(1)).alias("n")), "clash")
    exact = bucket_rank(texts, ["h", "b"], "name").withColumn("name", F.col("name") + base)
    # The block at a position of a text is the same for all rows with that text.
    at = rows.select("h", "b", "pos", "sha").distinct().join(exact.select("h", "b", "name"), ["h", "b"]).select(
        "sha", "pos", F.col("name").alias("exact"))
    again = (named.filter("variants > 1").select("rid", "pos")
             .join(seqs.select("rid", F.col("text_sha256").alias("sha")), "rid")
             .join(at, ["sha", "pos"]).select("rid", "pos", F.col("exact").alias("name")))
    return named.filter("variants = 1").select("rid", "pos", "name").unionByName(again)


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    ident = identities(docs, id_col, text_col, **kw)
    groups = written(ident.groupBy("n_blocks", "name").agg(
        F.max(F.struct("doc_id", "rid")).alias("top"), F.count(F.lit(1)).alias("n")), "groups")
    return attach_by_key(ident, groups, ["n_blocks", "name"], count_rows(ident)).select(
        "doc_id", F.col("top.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` with one row of each group of equal texts (the largest doc_id)."""
    groups = duplicate_groups(docs, id_col, text_col, **kw)
    tied = groups.filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    keepers = tied.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).agg(
        F.count(F.lit(1)).alias("n_tied"))
    return keep_rows(docs, keepers, {"_id": docs[id_col], "_sha": F.sha2(_normalised(docs, text_col), 256)})
