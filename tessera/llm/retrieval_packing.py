"""Lexical retrieval packing: BM25 neighbours of each seed document fill its window.

Documents become token ids. Whole windows of a long document are sequences by themselves;
what is left of each document (its tail, shorter than a window) is indexed. The index is
sharded: a shard holds the postings of its tails with their BM25 weights, and the document
frequencies behind the weights are those of all documents. Inside a shard, a seed is scored
against all unused tails by its terms' postings. Walking down the ranking, neighbours that
fit are taken whole; if none of the next ``LOOK`` closes the window, the best one that was
too long is cut to fill it exactly. The rest of that document seeds the next window, so its
text goes on there; without a rest the longest unused tail is the seed. Only a shard's last
window can stay open; it is cut into sequences of power-of-two lengths, which need no padding.

At scale: texts are read once, and their ids written with one row per piece. Tails are dealt
to shards by two min-hashes of their document's tokens, so that like documents meet; a
min-hash bucket with more than ``shard_docs`` tails is split further by row number, so copies
of one document, or rows that are equal in every column, spread over many shards and no
group outgrows ``shard_docs`` on average. Frequencies are aggregated by Spark; they and the
bucket table (2**16 rows at most) are bounded by the vocabulary and that number. Only tails
are shuffled, once.

Defined cases: NULL text counts as empty (its only token is the end id); repeated rows are
packed each; a NULL doc_id is kept; ties in the ranking go to the earlier row; terms in more
than half of the documents weigh nothing; tails without a common term rank last but are still
used; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of, written
from tessera.llm.tokens import batches, encoder

CAPACITY = 2048
END_ID = 1
SHARD_DOCS = 512
LOOK = 16
MAX_BUCKET_BITS = 16
K1, B = 1.2, 0.75

PIECES = ("doc_id long, tag long, start long, length int, doc_tokens long, ids_crc32 long, key long, ids binary, "
          "terms array<int>, found array<long>")
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# -- pieces and statistics --------------------------------------------------------

def id_type(tokenizer_path: str, end_id: int) -> tuple[int, str]:
    """Number of ids, and the type they are stored in."""
    size = max(encoder(tokenizer_path).tokenizer.get_vocab_size(), end_id + 1)
    return size, "<u2" if size <= 1 << 16 else "<u4"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per whole window (with its checksum) and per tail (with its min-hash ``key``);
    ``tag`` numbers the rows. A task's last row has no length and says in how many of its
    documents each term was ``found``; term -1 stands for the documents themselves."""
    vocabulary, stored = id_type(tokenizer_path, end_id)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tag, n_docs = encoder(tokenizer_path), TaskContext.get().partitionId() << 33, 0
        found, mark = np.zeros(vocabulary, np.int64), np.zeros(vocabulary, bool)
        first, second = (np.random.default_rng(i).permutation(vocabulary) for i in (1, 2))

        def table(rows_, terms=None):
            cols = list(zip(*rows_))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            stats = [pa.array([t] if terms else [None] * len(rows_), pa.list_(u))
                     for t, u in zip(terms or (0, 0), (pa.int32(), pa.int64()))]
            return pa.record_batch([*(pa.array(c, t) for c, t in zip(cols, types)), *stats],
                                   ["doc_id", "tag", "start", "length", "doc_tokens", "ids_crc32", "key", "ids", "terms", "found"])

        for batch in rows:
            doc, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in batches(texts):
                out = []
                for d, ids in zip(doc[a:b], enc.encode(texts[a:b])):
                    mark[ids] = True
                    terms = np.flatnonzero(mark)
                    found[terms] += 1
                    mark[terms] = False
                    n_docs += 1
                    key = int(first[terms].min()) << 32 | int(second[terms].min()) if len(terms) else -1
                    ids = np.append(ids, np.uint32(end_id))
                    n = len(ids)
                    for s in range(0, n, capacity):
                        part = ids[s:s + capacity]
                        whole = len(part) == capacity
                        out.append((d, tag, s, len(part), n, crc(part) if whole else None, None if whole else key,
                                    part.astype(stored).tobytes()))
                        tag += 1
                yield table(out)
        if n_docs:
            terms = np.flatnonzero(found)
            yield table([(None,) * 8], ([-1, *terms.tolist()], [n_docs, *found[terms].tolist()]))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs[text_col]).alias("text")).mapInArrow(run, PIECES)


def term_weights(pieces: DataFrame, vocabulary: int) -> np.ndarray:
    """BM25's inverse document frequency of each id over all documents, zero at least."""
    each = pieces.filter("length IS NULL").select(F.explode(F.arrays_zip("terms", "found")).alias("e"))
    total = each.groupBy(F.col("e.terms").alias("t")).agg(F.sum("e.found").alias("n")).collect()  # one row a term
    n = next((r["n"] for r in total if r["t"] == -1), 0)
    df = np.zeros(vocabulary)
    for r in total:
        if r["t"] >= 0:
            df[r["t"]] = r["n"]
    return np.maximum(0, np.log((n - df + 0.5) / (df + 0.5))).astype(np.float32)


# -- one shard ------------------------------------------------------------------------

class ShardIndex:
    """Postings of a shard's tails, by term, with the BM25 weight of each."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean_length: float):
        n = self.n = len(tails)
        length = np.array([len(t) for t in tails])
        flat = np.concatenate(tails).astype(np.int64) if n else np.zeros(0, np.int64)
        row = np.repeat(np.arange(n), length)
        telling = idf[flat] > 0
        cells, tf = np.unique(flat[telling] * max(1, n) + row[telling], return_counts=True)
        term, self.doc = np.divmod(cells, max(1, n))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[self.doc] / mean_length))
        self.names, self.term = np.unique(term, return_inverse=True)
        by_doc = np.argsort(self.doc, kind="stable")
        self._terms, self._of = self.term[by_doc], np.searchsorted(self.doc[by_doc], np.arange(n + 1))
        self._lists()

    def _lists(self) -> None:
        self.size = np.bincount(self.term, minlength=len(self.names))
        self.start = np.cumsum(self.size) - self.size

    def keep(self, docs: np.ndarray) -> None:
        """Drop the postings of all but the marked documents."""
        on = docs[self.doc]
        self.doc, self.weight, self.term = self.doc[on], self.weight[on], self.term[on]
        self._lists()

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every indexed document for the seed's terms."""
        terms = self._terms[self._of[seed]:self._of[seed + 1]]
        size = self.size[terms]
        upto = np.cumsum(size)
        if not len(upto):
            return np.zeros(self.n)
        at = np.arange(upto[-1]) + np.repeat(self.start[terms] - upto + size, size)
        return np.bincount(self.doc[at], self.weight[at], minlength=self.n)


def fill_windows(tails: list[np.ndarray], idf: np.ndarray, mean_length: float, capacity: int = CAPACITY,
                 look: int = LOOK) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (tail, from, to); all but the last are full."""
    index = ShardIndex(tails, idf, mean_length)
    length = [len(t) for t in tails]
    unused, n_unused, n_indexed = np.ones(len(tails), bool), len(tails), len(tails)
    longest = iter(sorted(range(len(tails)), key=lambda i: (-length[i], i)))
    windows, rest = [], None
    while rest or n_unused:
        seed, at = rest or (next(i for i in longest if unused[i]), 0)
        if not rest:
            unused[seed], n_unused = False, n_unused - 1
        window, room, rest = [(seed, at, length[seed])], capacity - length[seed] + at, None
        if room and n_unused:
            if n_unused < n_indexed // 2:
                index.keep(unused)
                n_indexed = n_unused
            open_ = np.flatnonzero(unused)
            ranking = open_[np.argsort(-index.scores(seed)[open_], kind="stable")].tolist()
            too_long = None
            for tried, i in enumerate(ranking):
                if not room or (tried >= look and too_long is not None):
                    break
                if length[i] <= room:
                    window.append((i, 0, length[i]))
                    unused[i], n_unused, room = False, n_unused - 1, room - length[i]
                elif too_long is None:
                    too_long = i
            if room and too_long is not None:
                window.append((too_long, 0, room))
                unused[too_long], n_unused, rest = False, n_unused - 1, (too_long, room)
        windows.append(window)
    return windows


def powers_of_two(window: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """The window's text in sequences whose lengths are its size's binary digits."""
    left = sum(b - a for _, a, b in window)
    out, todo = [], list(reversed(window))
    while left:
        room = 1 << left.bit_length() - 1
        left -= room
        out.append([])
        while room:
            i, a, b = todo.pop()
            cut = min(b, a + room)
            out[-1].append((i, a, cut))
            room -= cut - a
            if cut < b:
                todo.append((i, cut, b))
    return out


# -- the whole table ---------------------------------------------------------------------

def shards(pieces: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """The tails of written ``pieces`` with their ``shard``."""
    tails = pieces.filter(F.col("length") < capacity)
    n = tails.count()
    bits = min(MAX_BUCKET_BITS, max(0, math.ceil(math.log2(max(1, n / shard_docs)))))
    bucket = F.shiftrightunsigned(F.xxhash64("key"), 64 - bits) if bits else F.lit(0).cast("long")
    tails = tails.withColumn("_bucket", bucket)
    # One row per bucket, 2**MAX_BUCKET_BITS at most: a bounded broadcast.
    split = tails.groupBy("_bucket").agg(F.ceil(F.count(F.lit(1)) / shard_docs).alias("_splits"))
    return (tails.join(F.broadcast(split), "_bucket")
            .withColumn("shard", F.shiftleft("_bucket", 24) + F.pmod(F.xxhash64("tag"), F.col("_splits")))
            .drop("_bucket", "_splits"))


def place(pieces: DataFrame, idf: np.ndarray, stored: str, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS,
          look: int = LOOK, with_ids: bool = False) -> DataFrame:
    """``PACKED`` columns (and the piece's ``ids`` in the stored type) for written ``pieces``."""
    tails = shards(pieces, capacity, shard_docs)
    size = pieces.filter(F.col("length") < capacity).agg(F.avg("length")).first()[0]
    schema = PACKED + (", ids binary" if with_ids else "")

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("tag")
        doc, start, total, raw = (group[c].to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids"))
        ids = [np.frombuffer(r, stored) for r in raw]
        windows = fill_windows(ids, idf, size, capacity, look)
        if windows and sum(b - a for _, a, b in windows[-1]) < capacity:
            windows += powers_of_two(windows.pop())
        first = group["shard"][0].as_py() << 20
        out = []
        for k, window in enumerate(windows):
            offset = 0
            for i, a, b in window:
                part = ids[i][a:b]
                out.append((doc[i], start[i] + a, b - a, crc(part), total[i], first + k, offset,
                            *([part.tobytes()] if with_ids else [])))
                offset += b - a
        types = [pa.int64()] * 7 + [pa.binary()] * with_ids
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in schema.split(", ")])

    packed = tails.select("shard", "tag", "doc_id", "start", "doc_tokens", "ids").groupBy("shard").applyInArrow(run, schema)
    whole = pieces.filter(F.col("length") == capacity).select(
        "doc_id", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (-1 - F.col("tag")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *(["ids"] if with_ids else []))
    return whole.unionByName(packed)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", shard_docs: int = SHARD_DOCS, look: int = LOOK, with_ids: bool = False) -> DataFrame:
    """Per piece: ``PACKED`` columns, with ``with_ids`` also its token ids."""
    vocabulary, stored = id_type(tokenizer_path, end_id)
    pieces = written(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "retrieval-pieces")
    return place(pieces, term_weights(pieces, vocabulary), stored, capacity, shard_docs, look, with_ids)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` of ``pack(..., with_ids=True)`` (at most ``capacity`` tokens a group)."""
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    return packed.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p)).alias("ids"))
