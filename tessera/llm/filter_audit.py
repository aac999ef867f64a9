"""How five quality filters interact, decided from a sparse document-term matrix.

Each task cuts its texts into shards of about ``SHARD_BYTES`` and builds a CSR matrix per
shard (row: document, column: word, value: count) over the shard's own words. The distinct
words of all shards are dealt by a hash to buckets of about ``BUCKET_WORDS``, and each bucket
numbers its words in order: the global dictionary. The numbers go back to the shards, whose
columns become global once per (shard, word) rather than once per word of a text. Row sums
are a document's words, nonzero entries its distinct words; they decide filters A and B. The
remaining flags travel with the shard's documents; identical texts are found table-wide by
their SHA-256.

Failure conditions (words: runs of other than ASCII white space, case-sensitive): A: fewer
than ``min_words`` words; B: 100 * distinct < ``distinct_percent`` * words; C: 100 * ``[A-Z]`` >
``capital_percent`` * code points; D: holds a ``SYMBOLS`` character; E: the text of some smaller
id. A document is then one of 32 sets of failed filters, so the counts for every order and step
follow from at most 32 cells per part.

At scale: texts are read once and never shuffled. Moved are the shards' words (in blocks, one a
bucket) with their numbers, the matrices (once, compressed) and one thin row per document. A
word meets at most one entry per shard, so a word in every text is no hot key; the number of
buckets follows the words. A digest that many texts share
is joined by broadcast (``attach_by_key``); rows are pre-aggregated before labels join, so
neither a repeated nor a NULL id is hot.

Defined cases: NULL text is empty; NULL part is the empty string; rows with a NULL id come
after all others (they fail E if their text has an id) and have no labels; rows with the same
id don't fail E by each other; labels that repeat count as their largest; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import attach_by_key, count_rows, text_of, written

LETTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
SYMBOLS = "#$%&*|"
SHARD_BYTES = 4 << 20
BUCKET_WORDS = 1 << 18
SHARDS_PER_TASK = 4
_MIX = np.random.default_rng(0).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)

DOC = "struct<doc_id:bigint,part:string,digest:string,chars:bigint,capitals:bigint,symbols:bigint>"
_LOCAL = f"shard long, n_words long, words array<string>, indptr binary, indices binary, counts binary, docs array<{DOC}>"
_CSR = f"shard long, indptr binary, indices binary, counts binary, docs array<{DOC}>"


# -- shards --------------------------------------------------------------------

def csr(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, indptr, indices, counts) of the texts over their own words."""
    parts = pc.ascii_split_whitespace(texts)
    flat = pc.dictionary_encode(parts.flatten())
    codes, words = flat.indices.to_numpy(), flat.dictionary
    row = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    gap = pc.index(words, "").as_py()  # around white space at a text's ends
    if gap >= 0:
        codes, row = codes[codes != gap], row[codes != gap]
        codes = codes - (codes > gap)
        words = words.filter(pc.not_equal(words, ""))
    width = max(1, len(words))
    small = np.int32 if len(texts) * width < 1 << 31 else np.int64
    cells, counts = np.unique(row.astype(small) * small(width) + codes, return_counts=True)
    row, indices = np.divmod(cells, small(width))
    return words, np.searchsorted(row, np.arange(len(texts) + 1)), indices, counts


def packed(values: np.ndarray) -> bytes:
    return pa.compress(values.astype("<i4").tobytes(), codec="zstd", asbytes=True)


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw, 4 * n, codec="zstd", asbytes=True), "<i4")


def character_counts(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points, ``[A-Z]`` characters and symbols of each text."""
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1]
    b = np.frombuffer(data or b"", np.uint8)[ends[0]:ends[-1]]
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True

    some = np.diff(ends) > 0

    def per_text(hit):
        out = np.zeros(len(texts), np.int64)
        if some.any():
            out[some] = np.add.reduceat(hit, (ends[:-1] - ends[0])[some], dtype=np.int64)
        return out

    return per_text((b & 0xC0) != 0x80), per_text((b >= 65) & (b <= 90)), per_text(symbol[b])


def local_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: its words, its matrix over them (``indices`` as packed differences,
    ``counts`` packed), and its documents."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32  # tasks number their own shards
        for batch in batches:
            text = pc.cast(batch.column(0), pa.string())
            size = pc.binary_length(text).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff((np.cumsum(size) - size) // shard_bytes)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(text)]):
                if a == b:
                    continue
                part = pa.concat_arrays([text.slice(a, b - a)])
                words, indptr, indices, counts = csr(part)
                infos = pa.StructArray.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in (1, 2, 3)), *map(pa.array, character_counts(part))],
                    ["doc_id", "part", "digest", "chars", "capitals", "symbols"])
                yield pa.record_batch([
                    pa.array([shard], pa.int64()), pa.array([len(words)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words),
                    pa.array([indptr.astype("<i8").tobytes()], pa.binary()),
                    pa.array([packed(np.diff(indices, prepend=0))], pa.binary()), pa.array([packed(counts)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), infos)],
                    ["shard", "n_words", "words", "indptr", "indices", "counts", "docs"])
                shard += 1
            pa.default_memory_pool().release_unused()

    text = text_of(docs[text_col])
    return docs.select(text.alias("text"), F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.sha2(text, 256).alias("digest")).mapInArrow(build, _LOCAL)


# -- global dictionary ---------------------------------------------------------------

def bucket_of(words: pa.StringArray, buckets: int) -> np.ndarray:
    """Each (non-empty) word's bucket, by a hash of its bytes."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].astype(np.int64)
    size = np.diff(ends)
    place = np.arange(size.sum()) - np.repeat(ends[:-1] - ends[0], size)
    h = np.add.reduceat((np.frombuffer(data, np.uint8)[ends[0]:ends[-1]].astype(np.uint64) + np.uint64(1)) * _MIX[place % 64],
                        ends[:-1] - ends[0])
    h = (h ^ (h >> np.uint64(29))) * _MIX[0]
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def word_blocks(local: DataFrame, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """``bucket, n_buckets, shard, words, codes``: each shard's words and their local columns, by bucket."""
    pairs = local.agg(F.sum("n_words")).first()[0] or 0
    buckets = -(-pairs // bucket_words) or 1

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, words in zip(b.column(0), b.column(1)):
                words = words.values
                if not len(words):
                    continue
                to = bucket_of(words, buckets)
                order = np.argsort(to, kind="stable")
                which, first = np.unique(to[order], return_index=True)
                ends = pa.array([*first, len(order)], pa.int32())
                yield pa.record_batch([
                    pa.array(which), pa.array([buckets] * len(which), pa.int64()), pa.array([shard.as_py()] * len(which), pa.int64()),
                    pa.ListArray.from_arrays(ends, words.take(pa.array(order))),
                    pa.array([c.astype("<i4").tobytes() for c in np.split(order, first[1:])], pa.binary())],
                    ["bucket", "n_buckets", "shard", "words", "codes"])

    # Partitions follow the buckets, so a task's share doesn't grow with the corpus.
    return local.select("shard", "words").mapInArrow(
        deal, "bucket long, n_buckets long, shard long, words array<string>, codes binary").repartition(buckets, "bucket")


def _numbers(group: pa.Table) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """A bucket's words in order, the number of each, and the number of every entry."""
    words = pa.concat_arrays([c.flatten() for c in group["words"].chunks])
    flat = pc.dictionary_encode(words)
    order = pc.sort_indices(flat.dictionary).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order)) * group["n_buckets"][0].as_py() + group["bucket"][0].as_py()
    return flat.dictionary, number, number[flat.indices.to_numpy()]


def dictionary(blocks: DataFrame) -> DataFrame:
    """``word, word_id``: the global dictionary; equal for equal blocks however they are dealt out."""
    def run(group: pa.Table) -> pa.Table:
        words, number, _ = _numbers(group)
        return pa.table({"word": words, "word_id": number})

    return blocks.groupBy("bucket").applyInArrow(run, "word string, word_id long")


def csr_shards(local: DataFrame, blocks: DataFrame | None = None) -> DataFrame:
    """Shards of the document-term matrix over the global dictionary: ``indptr`` (int64),
    ``indices`` (int64 word ids) and ``counts`` (int32), and the rows' ``docs``.
    ``local``: written ``local_shards``; ``blocks``: its ``word_blocks``, made here if not given."""
    def look_up(group: pa.Table) -> pa.Table:
        _, _, ids = _numbers(group)
        pa.default_memory_pool().release_unused()
        size = pc.list_value_length(group["words"]).to_numpy()
        return pa.table({"_shard": group["shard"], "codes": group["codes"],
                         "ids": pa.array([i.astype("<i8").tobytes() for i in np.split(ids, np.cumsum(size)[:-1])], pa.binary())})

    def renumber(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, ids = (np.frombuffer(b"".join(right[c].to_pylist()), t) for c, t in (("codes", "<i4"), ("ids", "<i8")))
        by_code = np.zeros(len(ids), np.int64)
        by_code[codes] = ids
        out = []
        for raw, ptr, counts in zip(*(left[c].to_pylist() for c in ("indices", "indptr", "counts"))):
            n = int(np.frombuffer(ptr, "<i8")[-1])
            at = by_code[np.cumsum(unpacked(raw, n), dtype=np.int64)] if n else ids
            out.append((at.astype("<i8").tobytes(), unpacked(counts, n).tobytes()))
        return pa.table({"shard": left["shard"], "indptr": left["indptr"], "indices": pa.array([o[0] for o in out], pa.binary()),
                         "counts": pa.array([o[1] for o in out], pa.binary()), "docs": left["docs"]})

    tasks = -(-local.count() // SHARDS_PER_TASK) or 1
    columns = (blocks or word_blocks(local)).groupBy("bucket").applyInArrow(look_up, "_shard long, codes binary, ids binary") \
        .repartition(tasks, "_shard")
    matrix = local.select("shard", "indptr", "indices", "counts", "docs").repartition(tasks, "shard")
    return matrix.groupBy("shard").cogroup(columns.groupBy("_shard")).applyInArrow(renumber, _CSR)


def row_statistics(shards: DataFrame) -> DataFrame:
    """One row per document of the shards: row sum ``n_words`` and nonzero count ``n_distinct``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ptrs, counts = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("indptr", "counts"))
            docs = b.column(b.schema.get_field_index("docs")).flatten()
            sums, nonzero = [], []
            for ptr, c in zip(ptrs, counts):
                ptr = np.frombuffer(ptr, "<i8")
                upto = np.concatenate([[0], np.cumsum(np.frombuffer(c, "<i4"), dtype=np.int64)])
                sums.append(np.diff(upto[ptr]))
                nonzero.append(np.diff(ptr))
            if sums:
                yield pa.record_batch([*docs.flatten(), pa.array(np.concatenate(sums)), pa.array(np.concatenate(nonzero))],
                                      ["doc_id", "part", "digest", "chars", "capitals", "symbols", "n_words", "n_distinct"])

    return shards.select("indptr", "counts", "docs").mapInArrow(
        run, "doc_id long, part string, digest string, chars long, capitals long, symbols long, n_words long, n_distinct long")


# -- flags and counts ------------------------------------------------------------

def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
             min_words: int = MIN_WORDS, distinct_percent: int = DISTINCT_PERCENT, capital_percent: int = CAPITAL_PERCENT,
             shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``doc_id, part, n_words, n_distinct`` and ``mask``: bit i is set if the document fails ``LETTERS[i]``."""
    local = written(local_shards(docs, id_col, text_col, part_col, shard_bytes), "local-shards")
    rows = written(row_statistics(csr_shards(local)), "row-statistics")
    texts = written(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")), "texts")
    flagged = attach_by_key(rows, texts, ["digest"], count_rows(rows))
    earlier = F.col("first_id").isNotNull() & (F.col("doc_id").isNull() | (F.col("first_id") < F.col("doc_id")))
    fails = [F.col("n_words") < min_words, 100 * F.col("n_distinct") < distinct_percent * F.col("n_words"),
             100 * F.col("capitals") > capital_percent * F.col("chars"), F.col("symbols") > 0, earlier]
    return flagged.select("doc_id", "part", "n_words", "n_distinct",
                          sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0)).alias("mask"))


def cells(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the set of filters they fail."""
    per_id = failed.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    known = (labels.select(F.col(id_col).cast("long").alias("_id"), "quality", "toxic").filter("_id IS NOT NULL")
             .groupBy("_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic")))
    return (per_id.join(known, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), *[F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0)).alias(o)
                                          for c, o in (("quality", "good"), ("toxic", "toxic"))]))


def interactions(by_mask: DataFrame) -> DataFrame:
    """Counts for every part, filter order and step from the cells of ``cells``."""
    orders = ["".join(p) for p in permutations(LETTERS)]

    def mask_of(text):
        return sum(((F.instr(text, c) > 0).cast("int") * (1 << i) for i, c in enumerate(LETTERS)), F.lit(0))

    steps = (by_mask.withColumn("filter_order", F.explode(F.lit(orders)))
             .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))))
             .withColumn("_own", mask_of(F.substring("filter_order", F.col("step"), F.lit(1))))
             .withColumn("_before", mask_of(F.substring("filter_order", F.lit(1), F.col("step") - 1))))
    mask, own, before = F.col("mask"), F.col("_own"), F.col("_before")
    fails, gone = mask.bitwiseAND(own) != 0, mask.bitwiseAND(before) != 0
    # Over all orders, each filter that a document fails comes first among them equally often.
    share = (F.lit(len(orders)) / F.bit_count(mask)).cast("long") * F.col("n")

    def total(cond, value, name):
        return F.sum(F.when(cond, value).otherwise(0)).cast("long").alias(name)

    return steps.groupBy("part", "filter_order", "step").agg(
        total(~gone & ~fails, F.col("n"), "kept"), total(~gone & fails, F.col("n"), "removed"),
        total(gone & fails, F.col("n"), "redundant"), total(mask == own, F.col("n"), "unique_fails"),
        total(~gone & fails, F.col("good"), "good_lost"), total(~gone & fails, F.col("toxic"), "toxic_lost"),
        total(fails, share, "shapley"))


def audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The whole audit; ``options`` go to ``failures``."""
    return interactions(written(cells(failures(docs, **options), labels), "filter-cells"))
