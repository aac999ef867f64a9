"""Best-fit packing with patterns fitted by non-negative least squares.

Only the histogram of piece lengths (at most ``capacity`` numbers) decides how
lengths combine, so it alone reaches the driver. Lengths are grouped into bins; the
patterns of up to ``depth`` bins that together fill a sequence are enumerated, and
their repeat counts are fitted to the histogram by non-negative least squares
(Lawson-Hanson on the normal equations, so at most one pattern per bin has a
count). The counts are rounded; each pattern then takes real lengths from its bins,
the last place and what room is left being filled best-fit. Lengths that no pattern
took are packed best-fit, longest first. The plan says for each length which ranks go
to which pattern, sequence and place; its size depends on ``capacity``, not on the
number of documents.

At scale: the text is read once and pieces are written with their token ids (as
``capacity``-bounded rows). Ranks inside a length are dealt over ``RANK_BUCKETS`` hash
buckets, so a length that holds a third of all pieces is ranked by many tasks; bucket
offsets (``capacity * RANK_BUCKETS`` rows at most) and the plan are the only broadcasts.
Nothing but lengths, ranks and digests is shuffled. Pieces of exactly ``capacity``
tokens fill a sequence each.

Defined cases: NULL text counts as empty (its only token is the end id); repeated rows
are packed each; a NULL doc_id is kept; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of, written
from tessera.llm.tokens import batches, encoder

CAPACITY = 2048
END_ID = 0
BIN = 32
DEPTH = 4
RANK_BUCKETS = 64
PIECE_COLUMNS = ["doc_id", "piece", "start", "length", "ids_crc32"]


# -- pieces ----------------------------------------------------------------

def tokenize_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, ids (little-endian uint32 bytes) and a number of the
    row (``tag``); only documents longer than ``capacity`` are cut."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tag = encoder(tokenizer_path), TaskContext.get().partitionId() << 33
        for batch in rows:
            doc, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in batches(texts):
                out = []
                for d, ids in zip(doc[a:b], enc.encode(texts[a:b])):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for p, s in enumerate(range(0, len(ids), capacity)):
                        raw = ids[s:s + capacity].tobytes()
                        out.append((d, p, s, len(raw) // 4, zlib.crc32(raw), raw, tag))
                        tag += 1
                cols = list(zip(*out))
                yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()),
                                       pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
                                       pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.binary()), pa.array(cols[6], pa.int64())],
                                      ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "tag"])
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs[text_col]).alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, tag long")


# -- the plan, from the histogram alone -------------------------------------

def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """min |ax - b| for x >= 0 by the active-set method on the normal equations."""
    ata, atb = a.T @ a, a.T @ b
    x, free = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    barred = np.zeros(a.shape[1], bool)  # left at once when let in; until others move
    for _ in range(rounds):
        slope = np.where(free | barred, -np.inf, atb - ata @ x)
        j = int(np.argmax(slope))
        if slope[j] <= 1e-6 * max(1.0, np.abs(atb).max()):
            break
        free[j] = True
        while free.any():
            on = np.flatnonzero(free)
            z = np.linalg.solve(ata[np.ix_(on, on)] + 1e-9 * np.eye(len(on)), atb[on])
            down = z <= 1e-12
            if not down.any():
                x[:] = 0
                x[on] = z
                break
            step = np.min(x[on][down] / np.maximum(x[on][down] - z[down], 1e-12))
            x[on] = np.maximum(x[on] + step * (z - x[on]), 0)
            gone = on[down][x[on][down] <= 1e-10]
            free[gone if len(gone) else on[down][:1]] = False
            x[~free] = 0
        if free[j]:
            barred[:] = False
        else:
            barred[j] = True
    return x


def enumerate_patterns(n_bins: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of at most ``depth`` bins that fill ``n_bins``."""
    out = []

    def grow(prefix, left, most):
        if left == 0:
            out.append(prefix)
        elif len(prefix) < depth:
            for b in range(min(most, left), 0, -1):
                grow((*prefix, b), left - b, b)
    grow((), n_bins, n_bins)
    return out


class _Stock:
    """Counts by length with fast 'longest length of at most x that is left'."""

    def __init__(self, counts: np.ndarray):
        self.left = [int(c) for c in counts]
        # union-find towards shorter lengths; 0 stands for none
        self.below = [i if c else max(0, i - 1) for i, c in enumerate(self.left)]

    def longest(self, x: int) -> int:
        root = x
        while self.below[root] != root:
            root = self.below[root]
        while self.below[x] != root:
            self.below[x], x = root, self.below[x]
        return root

    def fill(self, pattern: list[int], room: int) -> list[int]:
        """Best fit: add the longest length that fits until none does."""
        taken = {x: pattern.count(x) for x in pattern}
        at = room
        while at > 0:
            x = self.longest(min(at, room))
            if x == 0:
                break
            if self.left[x] > taken.get(x, 0):
                pattern.append(x)
                taken[x] = taken.get(x, 0) + 1
                room -= x
                at = room
            else:
                at = x - 1
        return pattern

    def take(self, pattern: list[int], most: int) -> int:
        """Use the pattern as often as the counts allow, at most ``most`` times."""
        uses = {x: pattern.count(x) for x in pattern}
        times = min(most, *(self.left[x] // n for x, n in uses.items()))
        for x, n in uses.items():
            self.left[x] -= n * times
            if self.left[x] == 0:
                self.below[x] = x - 1
        return times


def plan_patterns(counts: np.ndarray, capacity: int = CAPACITY, bin_width: int = BIN,
                  depth: int = DEPTH) -> list[tuple[list[int], int]]:
    """(lengths, repeats) that use up the histogram ``counts`` (index = length)."""
    stock, plan = _Stock(np.asarray(counts, np.int64)), []
    n_bins = capacity // bin_width
    hist = np.zeros(n_bins + 1)
    # A length belongs to the nearest bin: a pattern's real lengths then sum to
    # about the capacity, and the best-fit last place makes them fit.
    lengths = np.flatnonzero(counts[:capacity])
    bins = np.clip(np.rint(lengths / bin_width).astype(int), 1, n_bins)
    np.add.at(hist, bins, np.asarray(counts)[lengths])
    if stock.left[capacity]:  # full pieces are sequences as they are
        plan.append(([capacity], stock.take([capacity], stock.left[capacity])))
    patterns = [p for p in enumerate_patterns(n_bins, depth) if all(hist[b] for b in p)]
    if patterns:
        a = np.zeros((n_bins + 1, len(patterns)))
        for j, p in enumerate(patterns):
            for b in p:
                a[b, j] += 1
        # Bins of many documents must not drown the others.
        scale = 1 / np.sqrt(np.maximum(hist, 1))
        repeats = np.rint(nnls(a * scale[:, None], hist * scale)).astype(np.int64)
        for j in sorted(np.flatnonzero(repeats), key=lambda j: patterns[j], reverse=True):
            todo = int(repeats[j])
            while todo > 0:
                made, room = [], capacity
                for place, b in enumerate(patterns[j]):
                    last = place == len(patterns[j]) - 1
                    top = min(room, capacity if last else b * bin_width + bin_width // 2)
                    x = stock.longest(top)
                    while x and stock.left[x] <= made.count(x):
                        x = stock.longest(x - 1)
                    if x == 0 or x < (b - 1) * bin_width:
                        break
                    made.append(x)
                    room -= x
                if len(made) < len(patterns[j]):
                    break
                made = stock.fill(made, room)
                times = stock.take(made, todo)
                plan.append((made, times))
                todo -= times
    while (x := stock.longest(capacity)) > 0:  # residuals
        made = stock.fill([x], capacity - x)
        plan.append((made, stock.take(made, stock.left[x])))
    return plan


def plan_table(plan: list[tuple[list[int], int]]) -> dict[str, np.ndarray]:
    """Places sorted by (length, first rank): where the ranks of a length go."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for x in lengths:
            rows.append((x, used.get(x, 0), sequence, offset))
            used[x] = used.get(x, 0) + times
            offset += x
        sequence += times
    t = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": t[:, 0] << 44 | t[:, 1], "rank": t[:, 1], "sequence": t[:, 2], "offset": t[:, 3]}


# -- assignment ---------------------------------------------------------------

def _ranked(pieces: DataFrame) -> DataFrame:
    """0-based rank of each piece among those of its length. Row tags deal the ranks out, so
    rows that are equal in every other column spread too."""
    tagged = pieces.withColumn("_b", F.pmod(F.xxhash64("tag"), F.lit(RANK_BUCKETS)).cast("int"))
    before = Window.partitionBy("length").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tagged.groupBy("length", "_b").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col("length").alias("_len"), F.col("_b").alias("_bb"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("length", "_b").orderBy("tag")
    return (tagged.withColumn("_rn", F.row_number().over(inside))
            .join(F.broadcast(offsets), (F.col("length") == F.col("_len")) & (F.col("_b") == F.col("_bb")))
            .withColumn("rank", (F.col("_off") + F.col("_rn") - 1).cast("long"))
            .drop("_b", "_bb", "_len", "_off", "_rn", "tag"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text", bin_width: int = BIN, depth: int = DEPTH) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    ``sequences`` joins the token ids back."""
    return assign(written(tokenize_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), "pieces"),
                  capacity, bin_width, depth)


def assign(pieces: DataFrame, capacity: int = CAPACITY, bin_width: int = BIN, depth: int = DEPTH) -> DataFrame:
    """Sequence and offset for a written table of pieces."""
    thin = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "tag")
    counts = np.zeros(capacity + 1, np.int64)
    for r in thin.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    table = plan_table(plan_patterns(counts, capacity, bin_width, depth))
    shared = pieces.sparkSession.sparkContext.broadcast(table)

    def place(batches_: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for b in batches_:  # ids pass through as they are: beside NULLs pandas would make them doubles
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(t["key"], (length << 44) | rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(b.column(b.schema.get_field_index(c)) for c in PIECE_COLUMNS),
                 pa.array(t["sequence"][at] + rank - t["rank"][at]), pa.array(t["offset"][at])],
                names=[*PIECE_COLUMNS, "sequence_id", "offset"])

    return _ranked(thin).mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                                           "sequence_id long, offset long")


def sequences(assigned: DataFrame, pieces: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences (at most ``capacity`` tokens a group)."""
    j = assigned.select("doc_id", "piece", "sequence_id", "offset").join(
        pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])
    return j.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda acc, p: F.concat(acc, p)).alias("ids"))
