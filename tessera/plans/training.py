"""Data-parallel training with periodic parameter averaging.

One *round*: every worker runs up to ``k`` mini-batches of the round from the
current model; the resulting parameters (and updater state) are averaged over
the workers. An epoch is one Spark job: a barrier stage whose tasks run all its
rounds and exchange the model through the shared folder (``rounds``), so the
model reaches the driver only at the end of the fit. Training rows are written
once, bucketed by task slot, so an epoch reads them without an exchange.

Where a barrier stage can't run (dynamic allocation, or more buckets than task
slots) a round is a job of its own: the model is broadcast, worker groups fit in
``applyInPandas``, ``param_average`` averages, and the model returns to the
driver; it reads only the round's rows (partition and row-group pruning).

Every random draw inside a worker is a function of (seed, epoch, round, worker,
batch) and its place (``layers.Draws``): a retried task reproduces the same
parameters, and SQL can draw the same numbers.
"""

from __future__ import annotations

import math
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import layers as L
from tessera.operators.averaging import CHUNK, param_average, param_sum
from tessera.operators.batching import MAX_WORKERS, batch_assign
from tessera.plans import model_store
from tessera.plans import rounds as R
from tessera.plans.models import (SLICE_ROWS, NetSpec, backward, batch_input, effective_l2, forward,
                                  init_params, layer_shapes)
from tessera.session import collect_arrow, create_arrow, delete_path, materialize, scratch_path
from tessera.sources.metrics import ARROW_SCHEMA, METRICS_SCHEMA, read_metrics, write_metrics


@dataclass
class ModelState:
    params: dict
    state: dict = field(default_factory=dict)  # updater state, e.g. 'v:cnn1.W'
    step: int = 0


def new_model(spec: NetSpec, zeros: bool = False) -> ModelState:
    params = init_params(spec)
    if zeros:
        params = {k: np.zeros_like(v) for k, v in params.items()}
    return ModelState(params)


# ---- updaters ---------------------------------------------------------------

def learning_rates(spec: NetSpec, step: int):
    r = spec.rules
    factor = 1.0
    if r.lr_decay is not None and r.lr_steps:
        factor = r.lr_decay ** (step // r.lr_steps)
    lr = r.lr * factor
    return lr, (r.bias_lr * factor if r.bias_lr is not None else lr)


def apply_update(spec: NetSpec, model: ModelState, grads: dict) -> None:
    """One optimiser step in place: per-layer L2 renormalisation, L2 penalty
    on weights, then the updater (sgd, rmsprop or nesterovs)."""
    r = spec.rules
    grads = dict(grads)
    if r.grad_norm == "l2_per_layer":
        for layer in {k.rsplit(".", 1)[0] for k in grads}:
            keys = [k for k in grads if k.rsplit(".", 1)[0] == layer]
            norm = math.sqrt(sum(float((grads[k] ** 2).sum()) for k in keys))
            if norm > 0:
                for k in keys:
                    grads[k] = grads[k] / norm
    lr_w, lr_b = learning_rates(spec, model.step)
    l2 = effective_l2(spec)
    for k, g in grads.items():
        p = model.params[k]
        is_bias = k.endswith(".b")
        if l2 and not is_bias:
            g = g + l2 * p
        lr = lr_b if is_bias else lr_w
        if r.updater == "sgd":
            model.params[k] = p - lr * g
        elif r.updater == "rmsprop":
            s = r.rms_decay * model.state.get("s:" + k, np.zeros_like(p)) + (1 - r.rms_decay) * g * g
            model.state["s:" + k] = s
            model.params[k] = p - lr * g / np.sqrt(s + 1e-8)
        elif r.updater == "nesterovs":
            v_prev = model.state.get("v:" + k, np.zeros_like(p))
            v = r.momentum * v_prev - lr * g
            model.state["v:" + k] = v
            model.params[k] = p - r.momentum * v_prev + (1 + r.momentum) * v
        else:
            raise ValueError(f"unknown updater {r.updater!r}")
    model.step += 1


def l2_penalty(spec: NetSpec, params: dict) -> float:
    l2 = effective_l2(spec)
    if not l2:
        return 0.0
    return 0.5 * l2 * sum(float((v ** 2).sum()) for k, v in params.items() if k.endswith(".W"))


def batch_arrays(spec: NetSpec, pdf: pd.DataFrame, feature_col: str, label_col: str):
    return batch_input(spec, pdf[feature_col]), pdf[label_col].to_numpy().astype(np.int64)


def train_batch(spec: NetSpec, model: ModelState, x, y, rng) -> float:
    """``iterations`` optimiser steps on one mini-batch; returns the last score."""
    score = float("nan")
    for _ in range(spec.rules.iterations):
        p, caches = forward(spec, model.params, x, train=True, rng=rng)
        score = L.nll_loss(p, y) + l2_penalty(spec, model.params)
        apply_update(spec, model, backward(spec, model.params, caches, p, y))
    return score


STEP = "__step__"  # the chunk that holds the step


# ---- chunks -----------------------------------------------------------------

def to_chunk_rows(arrays: dict):
    for name in sorted(arrays):
        flat = np.asarray(arrays[name], dtype=np.float64).reshape(-1)
        for c in range(max(1, math.ceil(flat.size / CHUNK))):
            yield name, c, flat[c * CHUNK:(c + 1) * CHUNK]


def _as_array(values) -> np.ndarray:
    if isinstance(values, (bytes, bytearray, memoryview)):
        return np.frombuffer(values, dtype=np.float64)
    return np.asarray(values, dtype=np.float64)


def from_chunk_rows(rows, shapes: dict) -> dict:
    parts: dict = {}
    for name, chunk, values in rows:
        parts.setdefault(name, {})[chunk] = _as_array(values)
    return {n: np.concatenate([parts[n][c] for c in sorted(parts[n])]).reshape(shapes[n])
            for n in parts}


def param_shapes(spec: NetSpec) -> dict:
    return {f"{ly.name}.{k}": s for ly, _, _, ps in layer_shapes(spec) for k, s in ps.items()}


def model_chunks_df(spark, model: ModelState) -> DataFrame:
    """The model as ``param, chunk, values`` rows (updater state included),
    built through Arrow: one model, bounded by its spec."""
    rows = list(to_chunk_rows({**model.params, **model.state}))
    rows.append((STEP, 0, np.array([float(model.step)])))
    pdf = pd.DataFrame(rows, columns=["param", "chunk", "values"])
    return create_arrow(spark, pdf, "param string, chunk int, values array<double>")


def model_from_chunks(spec: NetSpec, rows) -> ModelState:
    shapes = param_shapes(spec)
    rows = list(rows)
    step = [int(_as_array(v)[0]) for n, _, v in rows if n == STEP]
    arrays = from_chunk_rows([r for r in rows if r[0] != STEP],
                             {**shapes, **{f"{p}:{k}": s for k, s in shapes.items() for p in "sv"}})
    # Chunks travel and average in float64; compute resumes in the spec's type.
    params = {k: v.astype(spec.dtype, copy=False) for k, v in arrays.items() if ":" not in k}
    state = {k: v.astype(spec.dtype, copy=False) for k, v in arrays.items() if ":" in k}
    return ModelState(params, state, step[0] if step else 0)


# ---- one round --------------------------------------------------------------

# Chunks travel as raw float64 bytes: several times cheaper across the
# Python/JVM boundary than ARRAY<DOUBLE> at model sizes.
ROUND_SCHEMA = "worker int, param string, chunk int, values binary, value_bytes int, examples long, step long"
METRICS_PREFIX = "__metrics__/"
METRIC_FIELDS = 4  # batch, examples, score, step


def fit_worker(spec: NetSpec, model: ModelState, pdf: pd.DataFrame, epoch: int, round_: int, worker: int,
               feature_col: str = "features", label_col: str = "label_idx") -> tuple[int, list]:
    """A worker's batches of one round, in order, on ``model`` in place: examples seen, and
    (batch, examples, score, step) of each batch."""
    metrics, examples = [], 0
    for batch_id, g in pdf.sort_values(["batch_id", "pos"]).groupby("batch_id", sort=True):
        x, y = batch_arrays(spec, g, feature_col, label_col)
        score = train_batch(spec, model, x, y, L.Draws(spec.seed, epoch, round_, worker, batch_id))
        examples += len(y)
        metrics.append((int(batch_id), len(y), float(score), model.step))
    return examples, metrics


def _fit_fn(spec: NetSpec, bc, feature_col: str, label_col: str, epoch: int, round_: int,
            emit_metrics: bool = True, metrics_root: str | None = None, run_id: str = "run"):
    def fit(key, pdf):
        worker = int(pdf["worker"].iloc[0])  # groups are workers
        base = bc.value
        model = ModelState({k: v.copy() for k, v in base.params.items()},
                           {k: v.copy() for k, v in base.state.items()}, base.step)
        examples, told = fit_worker(spec, model, pdf, epoch, round_, worker, feature_col, label_col)
        if metrics_root:  # a repeated task replaces its file by an equal one
            rows = [(run_id, epoch, round_, worker, *m) for m in told]
            R.RoundStore(metrics_root).write_metrics(epoch, round_, worker, pa.table(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW_SCHEMA)], schema=ARROW_SCHEMA))
        metrics = [float(v) for m in told for v in m]
        # Parameters ship in the compute type (float32 halves the round's shuffle).
        wire = np.dtype(spec.dtype)
        out = [(worker, name, c, vals.astype(wire).tobytes(), wire.itemsize, examples, model.step)
               for name, c, vals in to_chunk_rows({**model.params, **model.state})]
        if emit_metrics:
            # A worker's metrics travel as one more chunk under a key of its own:
            # the mean over one row is the row, so the average passes it through.
            out.append((worker, f"{METRICS_PREFIX}{worker}", 0, np.array(metrics, dtype=np.float64).tobytes(), 8,
                        examples, model.step))
        return pd.DataFrame(out, columns=["worker", "param", "chunk", "values", "value_bytes", "examples", "step"])
    return fit


def run_round(spec: NetSpec, model: ModelState, rows: DataFrame, feature_col: str = "features",
              label_col: str = "label_idx", epoch: int = 0, round_: int = 0,
              weighted: bool = False, run_id: str = "run", with_metrics: bool = False,
              workers: int | None = None, metrics_root: str | None = None):
    """One averaging round over ``rows`` (the rows of this round, with
    ``worker``, ``batch_id``, ``pos``) as a single Spark job: broadcast
    model -> per-worker fit -> vector mean per chunk -> averaged chunks
    (model-sized) to the driver. Returns the new model, and with
    ``with_metrics`` also the round's metric tuples (one per batch; without
    them no per-worker rows reach the driver; with ``metrics_root`` the tasks leave them
    in that round folder instead). ``workers`` (the number of
    worker ids) shapes the averaging tree."""
    spark = rows.sparkSession
    bc = spark.sparkContext.broadcast(model)
    try:
        # Rows bucketed by ``wkey`` are grouped where they are.
        by = ["wkey", "worker"] if "wkey" in rows.columns else ["worker"]
        out = (rows.select(*by, "batch_id", "pos", feature_col, label_col)
               .groupBy(*by)
               .applyInPandas(_fit_fn(spec, bc, feature_col, label_col, epoch, round_, with_metrics, metrics_root, run_id),
                              ROUND_SCHEMA))
        averaged = param_average(out, weight_col="examples" if weighted else None, fanin_col="worker",
                                 fanin_workers=workers or 1, max_col="step")
        collected = collect_arrow(averaged).to_dict("records")  # model-sized
    finally:
        bc.destroy()
    chunks, metrics = [], []
    for r in collected:
        if r["param"].startswith(METRICS_PREFIX):
            worker = int(r["param"][len(METRICS_PREFIX):])
            v = _as_array(r["values"])
            for j in range(0, len(v), METRIC_FIELDS):
                metrics.append((run_id, epoch, round_, worker, int(v[j]), int(v[j + 1]), float(v[j + 2]),
                                int(v[j + 3])))
        else:
            chunks.append((r["param"], r["chunk"], r["values"]))
    if chunks:
        new = model_from_chunks(spec, chunks)
        new.step = int(max(r["step"] for r in collected))  # the maximum over workers
    else:  # no rows in this round: the model is unchanged
        new = model
    return (new, metrics) if with_metrics else new


TARGET_FILE_BYTES = 128 << 20  # training-table files of about this size
MIN_ROW_GROUP_BYTES = 1 << 20


def feature_bytes(examples: DataFrame, feature_col: str) -> int:
    """Size of one example's features (first row), for file sizing."""
    dt = examples.schema[feature_col].dataType
    size = F.length(feature_col) if isinstance(dt, T.BinaryType) else F.size(feature_col) * 8
    first = examples.select(size.alias("b")).filter(F.col("b").isNotNull()).first()
    return max(1, int(first["b"])) if first else 1


def worker_keys(spark, workers: int) -> DataFrame:
    """(worker, wkey): for each worker a key with ``pmod(hash(wkey), workers) == worker``.

    Spark assigns a row to bucket ``pmod(murmur3(key), buckets)``; small
    worker ids collide (for 0..3 into 4 buckets only two are used), which
    would idle tasks. Bucketing by these keys gives every worker its own
    bucket. The table has ``workers`` rows, at most ``MAX_WORKERS``."""
    if workers > MAX_WORKERS:
        raise ValueError(f"a bucketed table takes at most {MAX_WORKERS} workers")
    span = workers * 64
    while True:  # one pass in all but freak cases
        keys = (spark.range(span)
                .groupBy(F.pmod(F.hash(F.col("id")), F.lit(workers)).cast("int").alias("worker"))
                .agg(F.min("id").alias("wkey")))
        if keys.count() == workers:
            return keys
        span *= 2


def prepare_training_rows(examples: DataFrame, batch_size: int, workers: int,
                          averaging_frequency: int, rn_col: str = "split_rn",
                          bucketed: bool = True, table_name: str | None = None,
                          feature_col: str = "features", row_bytes: int | None = None,
                          path: str | None = None, slots: int | None = None) -> DataFrame:
    """Batches of the training rows, written once so that each round reads
    only its own rows.

    ``bucketed`` (default) writes an external table under the checkpoint
    folder, bucketed by ``wkey`` (see ``worker_keys``): one bucket per task slot, which takes
    the workers congruent to it (``slots``: ``rounds.barrier_slots``; by default a slot per worker).
    Every epoch then reads co-located buckets with no exchange, so across all epochs the
    training data is shuffled only here. Folders hold ``rounds_per_group``
    consecutive rounds (``round_group``), sized so a (group, worker) file is
    about ``TARGET_FILE_BYTES``: the file count is about data / 128 MB, not
    one file per round and worker. Files are sorted by round with row groups
    of about one round, so a round reads one folder (partition pruning) and
    only its own row groups (Parquet statistics). Drop the table with
    ``drop_training_rows`` when done.

    Pass ``row_bytes`` (one example's feature size) when ``examples`` is an
    expensive plan: measuring it reads a row of ``examples``, which for a
    ranked split would run its shuffle an extra time."""
    spark = examples.sparkSession
    slots = slots or workers
    per_file_round = batch_size * averaging_frequency * -(-workers // slots) * (row_bytes or feature_bytes(examples, feature_col))
    group = max(1, TARGET_FILE_BYTES // per_file_round)
    batched = (batch_assign(examples, rn_col, batch_size, workers, averaging_frequency)
               .withColumn("rounds_per_group", F.lit(group).cast("long"))
               .withColumn("round_group", F.floor(F.col("round") / group).cast("long"))
               .withColumn("slot", (F.col("worker") % slots).cast("int"))
               .join(F.broadcast(worker_keys(spark, slots).withColumnRenamed("worker", "slot")), "slot")
               .repartition("round_group", "wkey"))
    if not bucketed:
        return materialize(batched, "train-rows", partition_by=["round_group"], path=path)
    name = table_name or f"tessera_train_{uuid.uuid4().hex[:12]}"
    (batched.write.partitionBy("round_group").bucketBy(slots, "wkey").sortBy("round", "worker", "batch_id", "pos")
     .option("parquet.block.size", str(max(MIN_ROW_GROUP_BYTES, per_file_round)))
     .option("path", path or scratch_path(spark, "train-rows")).saveAsTable(name))
    return spark.table(name)


def rows_of_round(train_rows: DataFrame, r: int, rounds_per_group: int | None) -> DataFrame:
    """The rows of round ``r``: one folder by partition filter, then row groups by statistics."""
    cond = F.col("round") == r
    if rounds_per_group:
        cond = (F.col("round_group") == r // rounds_per_group) & cond
    return train_rows.filter(cond)


def drop_training_rows(spark, table_name: str) -> None:
    """Forget the external table (its files stay with the checkpoint folder)."""
    spark.sql(f"DROP TABLE IF EXISTS {table_name}")


def every_nth_batch(metrics: DataFrame, freq: int) -> DataFrame:
    """Keep the metrics of every ``freq``-th batch (a score listener's frequency)."""
    return metrics.filter(F.col("batch") % freq == 0)


def save_trained(spark, spec: NetSpec, model: ModelState, path: str, info: dict | None = None) -> int:
    """Save a trained model with its spec as the next version of the store at ``path``."""
    rows = [(n, c, v.tobytes()) for n, c, v in to_chunk_rows({**model.params, **model.state})]
    rows.append((STEP, 0, np.float64(model.step).tobytes()))
    chunks = create_arrow(spark, pd.DataFrame(rows, columns=["param", "chunk", "values"]), model_store.CHUNK_COLUMNS)
    return model_store.save_version(spark, spec, chunks, model.step, path, info)


def load_trained(spark, path: str, version: int | None = None):
    """``(spec, model)`` of a saved version (the newest by default); see ``model_store``."""
    spec, _, rows = model_store.open_version(spark, path, version)
    return spec, model_from_chunks(spec, rows)


@contextmanager
def _bucketed_scan(spark):
    """Spark reads a bucketed table bucket by bucket here, though no join asks for it."""
    key = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    old = spark.conf.get(key, "true")
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def train_fit(spec: NetSpec, train_rows: DataFrame, epochs: int = 1, model: ModelState | None = None,
              feature_col: str = "features", label_col: str = "label_idx", weighted: bool = False,
              metrics_path: str | None = None, run_id: str = "run", checkpoint_path: str | None = None,
              checkpoint_every: int | None = None, resume: bool = False, barrier: bool | None = None,
              metrics_every: int = 1, on_round=None, save_path: str | None = None):
    """Epochs of rounds over prepared training rows (see
    ``prepare_training_rows``). Returns ``(model, metrics_path)``.

    An epoch is one barrier job where the rows' buckets fit the session's task slots
    (``barrier`` forces either way), else a job per round. Rounds leave the model in
    ``checkpoint_path`` (every round in a barrier job, else every ``checkpoint_every`` rounds and
    at an epoch's end), and ``resume`` continues after the newest complete one, be it in the
    middle of an epoch. Per-batch metrics (of every ``metrics_every``-th batch) are committed to
    the sink once per epoch by the executors. Without a ``checkpoint_path`` the rounds are
    deleted at the end. With ``save_path`` executors save the model there as the next version
    (``model_store``). ``on_round``: see ``rounds.epoch_metrics``."""
    spark = train_rows.sparkSession
    model = model or new_model(spec)
    metrics_path = metrics_path or scratch_path(spark, "metrics")
    root = checkpoint_path or scratch_path(spark, f"rounds-{run_id}")
    grouped, slotted = ("rounds_per_group" in train_rows.columns), ("slot" in train_rows.columns and "wkey" in train_rows.columns)
    top = train_rows.agg(F.max("round").alias("r"), F.max("worker").alias("w"),
                         (F.max("rounds_per_group") if grouped else F.lit(None)).alias("g")).first()
    if top["r"] is None:  # no rows: the model is unchanged
        if save_path:
            save_trained(spark, spec, model, save_path, {"run_id": run_id})
        return model, metrics_path
    n_rounds, workers = int(top["r"]) + 1, int(top["w"]) + 1
    per_group = int(top["g"]) if top["g"] is not None else None
    layout, store = R.Layout(spec, param_shapes(spec)), R.RoundStore(root)
    last = store.last() if resume else None
    if last is None:
        store.write_slice(0, -1, 0, 1, layout.pack(model.params, model.state), model.step)
        last = (0, -1)
    # An epoch whose metrics wait in the folder isn't committed yet, even if all its rounds are complete.
    open_ = last[1] < n_rounds - 1 or R.metrics_wait(root, last[0])
    start_epoch, start_round = last if open_ else (last[0] + 1, -1)

    def fit(params, state, step, table, epoch, round_, worker):
        m = ModelState(params, state, step)
        examples, metrics = fit_worker(spec, m, table.to_pandas(), epoch, round_, worker, feature_col, label_col)
        return m.params, m.state, m.step, examples, metrics

    with _bucketed_scan(spark):
        slots = train_rows.select("wkey").rdd.getNumPartitions() if slotted else None
        if barrier is None:
            barrier = slots is not None and slots <= (R.barrier_slots(spark, workers) or 0)
        for epoch in range(start_epoch, epochs):
            if barrier:
                # Spark reads by bucket only if the bucket column is read.
                rows = train_rows.select("wkey", "round", "worker", "batch_id", "pos", feature_col, label_col)
                told = R.epoch_metrics(spec, layout, rows, root, epoch, n_rounds, fit, run_id, slots, weighted, on_round)
                # Behind an exchange the barrier stage is no result stage, which Spark wouldn't repeat.
                told = told.repartition("worker")
            else:
                model = _state(layout, *store.read_model(*store.last()))
                for r in range(start_round + 1 if epoch == start_epoch else 0, n_rounds):
                    model = run_round(spec, model, rows_of_round(train_rows, r, per_group), feature_col, label_col, epoch, r,
                                      weighted, run_id, workers=workers, metrics_root=root)
                    if r == n_rounds - 1 or (checkpoint_every and (r + 1) % checkpoint_every == 0):
                        store.write_slice(epoch, r, 0, 1, layout.pack(model.params, model.state), model.step)
                told = R.told_metrics(spark, root, epoch)
            write_metrics(told, metrics_path, run_id, epoch, metrics_every)
            R.clean_up(root, epoch)
    model = _state(layout, *store.read_model(*store.last()))
    if save_path:
        model_store.save_version(spark, spec, R.model_chunks(spark, layout, root, CHUNK), model.step, save_path, {"run_id": run_id})
    if not checkpoint_path:
        delete_path(spark, root)
    return model, metrics_path


def _state(layout: R.Layout, vector: np.ndarray, step: int) -> ModelState:
    return ModelState(*layout.unpack(vector), step)


# ---- full-batch gradient ----------------------------------------------------

def full_batch_step(spec: NetSpec, model: ModelState, rows: DataFrame, feature_col: str = "features",
                    label_col: str = "label_idx") -> ModelState:
    """One optimiser step on the gradient of the whole table: every partition
    emits its gradient *sum* per chunk; a vector sum (partial + final
    aggregate) adds them; the driver divides by the row count."""
    spark = rows.sparkSession
    bc = spark.sparkContext.broadcast(model.params)
    summing = replace(spec, rules=replace(spec.rules, mini_batch=False))

    def grad_sums(it):
        params = bc.value
        acc, n = None, 0
        for pdf in it:
            for lo in range(0, len(pdf), SLICE_ROWS):  # bounded memory per forward/backward
                x, y = batch_arrays(spec, pdf.iloc[lo:lo + SLICE_ROWS], feature_col, label_col)
                p, caches = forward(summing, params, x, train=False)
                g = backward(summing, params, caches, p, y)
                acc = g if acc is None else {k: acc[k] + g[k] for k in acc}
                n += len(y)
        if acc is not None:
            yield pd.DataFrame([(name, c, vals, n) for name, c, vals in to_chunk_rows(acc)],
                               columns=["param", "chunk", "values", "n"])

    try:
        # One partial sum per input partition and chunk, summed by the JVM
        # vector aggregate: map-side combine and a streaming merge keep memory
        # bounded however many partitions the input has.
        parts = rows.select(feature_col, label_col).mapInPandas(
            grad_sums, "param string, chunk int, values array<double>, n long")
        collected = collect_arrow(param_sum(parts, "n")).to_dict("records")  # model-sized
    finally:
        bc.destroy()
    new = ModelState({k: v.copy() for k, v in model.params.items()},
                     {k: v.copy() for k, v in model.state.items()}, model.step)
    if not collected:
        return new
    total = collected[0]["n"]
    grads = from_chunk_rows([(r["param"], r["chunk"], r["values"]) for r in collected], param_shapes(spec))
    if spec.rules.mini_batch:
        grads = {k: v / total for k, v in grads.items()}
    apply_update(spec, new, grads)
    return new
