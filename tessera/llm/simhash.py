"""SimHash near-dedup by meet-in-the-middle ball hashing.

Fingerprints link when at most three of their 64 bits differ. The bits are cut
into three blocks. Of the bits in which two linked fingerprints differ, at least
one lies in some block (or none differ); with that block masked out at most two
are left, and half that radius is one: both fingerprints emit the masked value
and all its one-bit variants, and the two sets meet. So each distinct fingerprint
emits 131 variants (44 + 44 + 43) instead of the 2,081 of a full two-bit ball.
Variants are shuffled and sorted natively; each key's members are compared with
XOR and popcount, so every link met is verified and every link is met.

A key with many members never emits its pairs: verified links inside it are
reduced to a spanning forest (one row per member at most), which keeps the
components and needs no more rows than members. Components come from alternating
large-star / small-star rounds over distinct fingerprints, each round a written
table. Equal fingerprints are collapsed before anything is emitted, so exact copies
cost one fingerprint whatever their number.

Defined cases: NULL text counts as empty; a text without words has fingerprint zero
and links like any other; texts of fewer words than a shingle have one shingle, the
whole sequence; a NULL doc_id sorts first (so it names its component); an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import attach_by_key, count_rows, keep_rows, text_of, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BLOCKS = ((0, 21), (21, 42), (42, 64))  # bit ranges; one more than half the radius, rounded up


def shingle_hashes(text: str, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of each word shingle (repeats included) of the A-Z lower-cased text."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and \\x20 \\x09-\\x0D only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    end = np.cumsum(size)
    first = (end - size)[: len(words) - shingle + 1].tolist()
    last = (end[shingle - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], seed) for a, b in zip(first, last)), np.uint64, len(first))


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded memory for very long texts
        part = hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * ones > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str, shingle: int, seed: int) -> DataFrame:
    """``docs`` plus the fingerprint of ``text_col`` in ``_fp`` (long)."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([fingerprint(shingle_hashes(t, shingle, seed)) for t in batch],
                                     np.uint64).view(np.int64))
    return docs.withColumn("_fp", fp(text_of(docs[text_col])))


def _variant_masks() -> list[tuple[np.uint64, np.ndarray]]:
    """Per block: the mask of the other bits, and what to XOR: the block's
    number (in the masked bits) with no or one other bit flipped."""
    out = []
    for number, (lo, hi) in enumerate(BLOCKS):
        keep = np.uint64(sum(1 << b for b in range(64) if not lo <= b < hi))
        tag = number << lo
        flips = [tag] + [tag | 1 << b for b in range(64) if not lo <= b < hi]
        out.append((keep, np.array(flips, np.uint64)))
    return out


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    masks = _variant_masks()
    for batch in batches:
        all_fp = batch.column(0).to_numpy().view(np.uint64)
        for at in range(0, len(all_fp), 4096):
            fp = all_fp[at:at + 4096]
            for keep, flips in masks:
                keys = ((fp & keep)[:, None] ^ flips[None, :]).ravel()
                yield pa.record_batch([pa.array(keys.view(np.int64)),
                                       pa.array(np.repeat(fp, len(flips)).view(np.int64))], ["key", "fp"])


def _forest(fps: np.ndarray, max_bits: int) -> tuple[list, list]:
    """Edges (member, root) of a spanning forest of the verified links."""
    n = len(fps)
    root = np.arange(n)
    for i in range(n):  # one row of distances at a time: memory is linear in the key
        near = np.flatnonzero(np.bitwise_count(fps[i] ^ fps[i + 1:]) <= max_bits) + i + 1
        if len(near):
            labels = np.unique(np.append(root[near], root[i]))
            if len(labels) > 1:
                root[np.isin(root, labels)] = labels[0]
    moved = np.flatnonzero(root != np.arange(n))
    return fps[moved].tolist(), fps[root[moved]].tolist()


def _meet(max_bits: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(keys, fps):
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            sizes = np.diff(np.append(starts, len(keys)))
            two = starts[sizes == 2]
            a, b = fps[two], fps[two + 1]
            ok = np.bitwise_count(a ^ b) <= max_bits
            left, right = [a[ok]], [b[ok]]
            for s, n in zip(starts[sizes > 2], sizes[sizes > 2]):
                u, v = _forest(fps[s:s + n], max_bits)
                left.append(np.array(u, np.uint64))
                right.append(np.array(v, np.uint64))
            # The same link meets at several keys: deduplicate early.
            pairs = np.unique(np.stack([np.concatenate(left), np.concatenate(right)], 1).view(np.int64), axis=0)
            return pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

        keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:  # sorted by key; the last key of a batch may go on in the next
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if cut:
                yield links(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield links(keys, fps)
    return meet


def link_forest(distinct_fp: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that keep every component
    of the link graph. ``distinct_fp``: one long column."""
    if max_bits != MAX_BITS:
        raise ValueError("the blocks are made for links of at most 3 bits")
    variants = distinct_fp.mapInArrow(_emit, "key long, fp long")
    met = (variants.repartition("key").sortWithinPartitions("key", "fp")
           .mapInArrow(_meet(max_bits), "u long, v long"))
    return met.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u > v); root is the smallest
    node of the component. Alternating stars; both steps join a small table of
    minima back by key with hot nodes broadcast."""
    def mark(e):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        return r[0], r[1]

    cur = written(edges, "edges")
    seen = mark(cur)
    while seen[0]:
        both = written(cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        low = written(low.select("u", F.least("u", "m").alias("m"), "n"), "low")
        large = (attach_by_key(both, low, ["u"], count_rows(both)).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = written(large, "large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")), "low")
        small = attach_by_key(large, low, ["u"], count_rows(large))
        nxt = (small.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        nxt = written(nxt, "edges")
        now = mark(nxt)
        if now == seen:
            break
        cur, seen = nxt, now
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _grouped(keyed: DataFrame, shingle: int, max_bits: int, seed: int) -> DataFrame:
    """``keyed`` (text and any other columns, one of them doc_id) without its text, plus fp,
    component_id, n (rows of this fingerprint) and root (smallest fingerprint of the component)."""
    fps = written(fingerprints(keyed, "text", shingle, seed).withColumnRenamed("_fp", "fp").drop("text"), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min(F.struct("doc_id")).alias("low"), F.count(F.lit(1)).alias("n")),
                       "distinct")
    roots = written(components(link_forest(distinct.select("fp"), max_bits)), "roots")
    member = written(distinct.join(roots, distinct["fp"] == roots["node"], "left")
                     .select("fp", "low", "n", F.coalesce("root", "fp").alias("root")), "member")
    named = member.groupBy("root").agg(F.min("low").alias("first"), F.count(F.lit(1)).alias("size")).alias("c")
    named = written(named, "components")
    label = written(attach_by_key(member, named, ["root"], count_rows(member), "size")
                    .select("fp", "n", "root", F.col("first.doc_id").alias("component_id")), "labels")
    return attach_by_key(fps, label, ["fp"], count_rows(fps))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """Per input row: doc_id, fp (long), component_id, n (rows of this fingerprint)."""
    keyed = docs.select(F.col(id_col).alias("doc_id"), text_of(docs[text_col]).alias("text"))
    return _grouped(keyed, shingle, max_bits, seed).select("doc_id", "fp", "component_id", "n")


def hex_fingerprint(c: str) -> Column:
    """16 lowercase hex digits of an unsigned 64-bit value held in a long."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
          max_bits: int = MAX_BITS, seed: int = SEED) -> DataFrame:
    """``docs`` with one row of each group: of the rows with its smallest doc_id the one
    whose text has the smallest SHA-256. Groups that share a doc_id (repeated or NULL
    ids) keep a row each."""
    digest = F.sha2(text_of(docs[text_col]), 256)
    keyed = docs.select(F.col(id_col).alias("doc_id"), digest.alias("sha"), text_of(docs[text_col]).alias("text"))
    first = _grouped(keyed, shingle, max_bits, seed).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    same = first.groupBy("root", "doc_id", "sha").agg(F.count(F.lit(1)).alias("n_tied"))
    keepers = (same.groupBy("root").agg(F.min(F.struct("sha", "doc_id", "n_tied")).alias("k"))
               .select(F.col("k.doc_id").alias("_id"), F.col("k.sha").alias("_sha"), F.col("k.n_tied").alias("n_tied")))
    return keep_rows(docs, keepers, {"_id": docs[id_col], "_sha": digest})
