"""Averaging rounds inside one Spark job: a barrier stage whose tasks exchange the model
through files in the shared folder.

Barrier mode starts all tasks together and fails them together. Each task runs several
workers (its slot's). In a round every task fits its workers from the current model and
writes the sum of their vectors; once all sums are there, task t adds up slice t of them,
divides by the summed weights and writes the slice; once all slices are there, every task
reads them. Tasks wait for each other's files (``BarrierTaskContext.barrier`` wakes up in
whole seconds, too slow for small rounds). The model never passes the driver, and no task
reads more than two models a round.

Files are sealed with a checksum, and a repeated round writes equal bytes, so what a failed
attempt left behind is as good as new. A round is complete when all its slices are there; a
failed stage starts again after the last complete round, and so does a restarted driver
that names the same folder. Metrics are the stage's output; those of earlier rounds are read
back from the folder when it restarts.
"""

from __future__ import annotations

import struct
import time
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame, SparkSession

from tessera.plans.models import NetSpec
from tessera.sources.files import HEAD_BYTES, Folder, sealed, unsealed
from tessera.sources.metrics import ARROW_SCHEMA, METRICS_SCHEMA

_SUMS = struct.Struct("<dq")  # summed weight, largest step


class Layout:
    """The model and its updater state as one vector of doubles."""

    STATE = {"sgd": (), "rmsprop": ("s:",), "nesterovs": ("v:",)}  # what each updater keeps per parameter

    def __init__(self, spec: NetSpec, shapes: dict):
        names = sorted(shapes)
        self.dtype = spec.dtype
        self.shapes = {p + n: shapes[n] for p in ("", *self.STATE[spec.rules.updater]) for n in names}
        self.size = sum(int(np.prod(s)) for s in self.shapes.values())

    def pack(self, params: dict, state: dict) -> np.ndarray:
        arrays = {**params, **state}
        return np.concatenate([np.asarray(arrays[n], np.float64).reshape(-1) if n in arrays else np.zeros(int(np.prod(s)))
                               for n, s in self.shapes.items()])

    def unpack(self, vector: np.ndarray) -> tuple[dict, dict]:
        params, state, at = {}, {}, 0
        for n, s in self.shapes.items():
            size = int(np.prod(s))
            (state if ":" in n else params)[n] = vector[at:at + size].reshape(s).astype(self.dtype)
            at += size
        return params, state


class RoundStore:
    """The rounds of a run: ``epoch/round/slice-t-of-n``, and while a round runs ``sums-t-of-n``."""

    KEEP = 2  # complete rounds kept

    def __init__(self, root: str):
        self.folder = Folder(root)

    @staticmethod
    def name(epoch: int, round_: int) -> str:
        return f"e{epoch:06d}/r{round_ + 1:09d}"  # round -1: the model an epoch starts from

    def have(self, epoch: int, round_: int, kind: str, n: int | None = None) -> list[str]:
        """All ``n`` file names of a kind (of any number if None) in order, or none while some are missing."""
        names = [x for x in self.folder.names(self.name(epoch, round_)) if x.startswith(kind)]
        for of, found in Counter(int(x.rsplit("-", 1)[1]) for x in names).items():
            if found == of and n in (None, of):
                return [f"{kind}-{t}-of-{of}" for t in range(of)]
        return []

    def wait(self, epoch: int, round_: int, kind: str, n: int) -> None:
        """Until all ``n`` tasks have written their file. If one is lost, Spark ends them all."""
        pause = 0.002
        while not self.have(epoch, round_, kind, n):
            time.sleep(pause)
            pause = min(0.5, pause * 1.5)

    def last(self) -> tuple[int, int] | None:
        """(epoch, round) of the newest complete round."""
        for e in reversed([n for n in self.folder.names() if n.startswith("e")]):
            for r in reversed(self.folder.names(e)):
                at = int(e[1:]), int(r[1:]) - 1
                if self.have(*at, "slice"):
                    return at
        return None

    def write_slice(self, epoch: int, round_: int, t: int, n: int, values: np.ndarray, step: int) -> None:
        self.folder.write(f"{self.name(epoch, round_)}/slice-{t}-of-{n}", sealed(_SUMS.pack(0, step) + values.tobytes()))

    def read_model(self, epoch: int, round_: int) -> tuple[np.ndarray, int]:
        at = self.name(epoch, round_)
        parts = [unsealed(self.folder.read(f"{at}/{n}")) for n in self.have(epoch, round_, "slice")]
        return np.concatenate([np.frombuffer(p, np.float64, offset=_SUMS.size) for p in parts]), _SUMS.unpack_from(parts[0])[1]

    def read_range(self, epoch: int, round_: int, lo: int, hi: int) -> bytes:
        """Values lo..hi of a complete round's model, from the slices that hold them."""
        at, out, start = self.name(epoch, round_), [], 0
        head = HEAD_BYTES + _SUMS.size
        for n in self.have(epoch, round_, "slice"):
            info = self.folder.fs.get_file_info(f"{self.folder.base}/{at}/{n}")
            size = (info.size - head) // 8
            a, b = max(lo, start) - start, min(hi, start + size) - start
            if a < b:
                out.append(self.folder.read(f"{at}/{n}", head + 8 * a, 8 * (b - a)))
            start += size
        return b"".join(out)

    def write_sums(self, epoch: int, round_: int, t: int, n: int, sums: np.ndarray, weight: float, step: int) -> None:
        self.folder.write(f"{self.name(epoch, round_)}/sums-{t}-of-{n}", sealed(_SUMS.pack(weight, step) + sums.tobytes()))

    def read_sums(self, epoch: int, round_: int, t: int, n: int, lo: int, hi: int) -> tuple[np.ndarray, float, int]:
        """Values lo..hi of a task's sums, its weight and step: only these bytes are read."""
        name = f"{self.name(epoch, round_)}/sums-{t}-of-{n}"
        weight, step = _SUMS.unpack(self.folder.read(name, HEAD_BYTES, _SUMS.size))
        raw = self.folder.read(name, HEAD_BYTES + _SUMS.size + 8 * lo, 8 * (hi - lo))
        if len(raw) != 8 * (hi - lo):
            raise ValueError("a task's sums are cut off")
        return np.frombuffer(raw, np.float64), weight, step

    def write_metrics(self, epoch: int, round_: int, t: int, table: pa.Table) -> None:
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, ARROW_SCHEMA) as w:
            w.write_table(table)
        self.folder.write(f"m{epoch:06d}/{round_:09d}-{t}", out.getvalue().to_pybytes())

    def read_metrics(self, epoch: int, upto: int, t: int) -> Iterator[pa.RecordBatch]:
        """A task's metrics of the epoch's rounds up to ``upto``."""
        for n in self.folder.names(f"m{epoch:06d}"):
            r, task = map(int, n.split("-"))
            if r <= upto and task == t:
                yield from pa.ipc.open_stream(self.folder.read(f"m{epoch:06d}/{n}"))


def barrier_slots(spark: SparkSession, workers: int) -> int | None:
    """Tasks of a barrier stage for that many workers: as many as run at once. None where a
    barrier stage can't run (executors come and go by dynamic allocation)."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") == "true":
        return None
    return min(workers, spark.sparkContext.defaultParallelism)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.Table]]:
    """(round, worker, rows) of rows sorted by round and worker."""
    key, parts = None, []
    for b in batches:
        r, w = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("round", "worker"))
        cuts = (np.flatnonzero((np.diff(r) != 0) | (np.diff(w) != 0)) + 1).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, len(r)]):
            if lo == hi:
                continue
            if key != (r[lo], w[lo]):
                if parts:
                    yield (*key, pa.Table.from_batches(parts))
                key, parts = (int(r[lo]), int(w[lo])), []
            parts.append(b.slice(lo, hi - lo))
    if parts:
        yield (*key, pa.Table.from_batches(parts))


def epoch_metrics(spec: NetSpec, layout: Layout, rows: DataFrame, root: str, epoch: int, n_rounds: int, fit_worker: Callable,
                  run_id: str, slots: int, weighted: bool = False, on_round: Callable | None = None) -> DataFrame:
    """All rounds of an epoch as one barrier stage; its rows are the epoch's metrics.

    ``rows``: training rows, slot by slot in one partition each, sorted by round and worker.
    ``fit_worker(params, state, step, table, epoch, round, worker)`` gives
    ``(params, state, step, examples, metrics)``. ``on_round(epoch, round, task, started)``
    is called in each task after each round; ``started`` is the round this attempt began with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx, store = BarrierTaskContext.get(), RoundStore(root)
        t, n = ctx.partitionId(), len(ctx.getTaskInfos())
        # A task that looks later may find one more round complete: the others are still at it.
        e, done = store.last()
        vector, step = store.read_model(e, done)
        if e == epoch:
            yield from store.read_metrics(epoch, done, t)
        else:
            done = -1
        lo, hi = (layout.size * i // n for i in (t, t + 1))
        groups, started, slot = _groups(batches), done + 1, None
        ahead = next(groups, None)
        for r in range(n_rounds):
            sums, weight, top, metrics = np.zeros(layout.size), 0.0, step, []
            while ahead is not None and ahead[0] == r:
                if slot not in (None, ahead[1] % n):
                    raise ValueError("workers of several slots in one task")
                slot = ahead[1] % n
                if r > done:
                    params, state = layout.unpack(vector)
                    params, state, at, examples, told = fit_worker(params, state, step, ahead[2], epoch, r, ahead[1])
                    w = float(examples) if weighted else 1.0
                    sums += w * layout.pack(params, state)
                    weight, top = weight + w, max(top, at)
                    metrics += [(run_id, epoch, r, ahead[1], *m) for m in told]
                ahead = next(groups, None)
            if r <= done:
                continue
            store.write_sums(epoch, r, t, n, sums, weight, top)
            table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*metrics), ARROW_SCHEMA)], schema=ARROW_SCHEMA) \
                if metrics else ARROW_SCHEMA.empty_table()
            store.write_metrics(epoch, r, t, table)
            store.wait(epoch, r, "sums", n)
            total, weight = np.zeros(hi - lo), 0.0
            for task in range(n):  # always in this order: a retried round is equal bit for bit
                part, w, at = store.read_sums(epoch, r, task, n, lo, hi)
                total, weight, top = total + part, weight + w, max(top, at)
            store.write_slice(epoch, r, t, n, total / weight if weight else vector[lo:hi], top)
            store.wait(epoch, r, "slice", n)
            vector, step = store.read_model(epoch, r)
            # All tasks have written their sums of this round: they are done with earlier ones.
            if r >= store.KEEP and t == 0:
                store.folder.remove(store.name(epoch, r - store.KEEP))
            if on_round:
                on_round(epoch, r, t, started)
            yield from table.to_batches()

    placed = rows.sortWithinPartitions("round", "worker", "batch_id", "pos")
    if placed.rdd.getNumPartitions() != slots:
        raise ValueError(f"training rows lie in {placed.rdd.getNumPartitions()} partitions, not in {slots} slots")
    return placed.mapInArrow(run, METRICS_SCHEMA, barrier=True)


def metrics_wait(root: str, epoch: int) -> bool:
    """Whether an epoch left metrics in the folder that are not committed."""
    return f"m{epoch:06d}" in Folder(root).names()


def told_metrics(spark: SparkSession, root: str, epoch: int) -> DataFrame:
    """The metrics an epoch's tasks left in the folder, one file per round and worker, read by executors."""
    names = RoundStore(root).folder.names(f"m{epoch:06d}")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = Folder(root)
        for b in batches:
            for n in b.column(0).to_pylist():
                yield from pa.ipc.open_stream(folder.read(f"m{epoch:06d}/{n}"))

    return spark.createDataFrame([(n,) for n in names], "name string").repartition("name").mapInArrow(read, METRICS_SCHEMA)


def model_chunks(spark: SparkSession, layout: Layout, root: str, chunk: int) -> DataFrame:
    """The newest complete round's model as (param, chunk, values), read by executors."""
    epoch, round_ = RoundStore(root).last()
    step = RoundStore(root).read_model(epoch, round_)[1]
    places, at = [], 0
    for n, s in layout.shapes.items():
        size = int(np.prod(s))
        places += [(n, c, at + lo, at + min(lo + chunk, size)) for c, lo in enumerate(range(0, max(size, 1), chunk))]
        at += size

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = RoundStore(root)
        for b in batches:
            for param, c, lo, hi in zip(*(col.to_pylist() for col in b.columns)):
                yield pa.record_batch([pa.array([param]), pa.array([c], pa.int32()),
                                       pa.array([store.read_range(epoch, round_, lo, hi)], pa.binary())], ["param", "chunk", "values"])

    chunks = spark.createDataFrame(places, "param string, chunk int, lo long, hi long").repartition("param", "chunk")
    steps = spark.createDataFrame([("__step__", 0, np.float64(step).tobytes())], "param string, chunk int, values binary")
    return chunks.mapInArrow(read, "param string, chunk int, values binary").unionByName(steps)


def clean_up(root: str, epoch: int) -> None:
    """After an epoch: forget its metrics and the rounds of earlier ones."""
    folder = Folder(root)
    for n in folder.names():
        if int(n[1:]) < epoch or n == f"m{epoch:06d}":
            folder.remove(n)
