"""The whole training-and-evaluation job over a table of labelled examples.

examples (id, label, features)
  -> optional random cap -> label vocabulary -> label index
  -> exact seeded train/test split -> batches written once by round
  -> epochs of averaging rounds -> distributed scoring of the test split
  -> confusion matrix -> per-class metrics -> summary -> one-row report
"""

from __future__ import annotations

import math
import time
import uuid
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.batching import worker_count
from tessera.operators.evaluation import class_metrics, confusion_matrix, eval_summary
from tessera.operators.labels import index_labels, label_vocab
from tessera.operators.sampling import sample_cap, split_side
from tessera.operators.scoring import predict_named, score_batch
from tessera.operators.shared_model import share_params
from tessera.plans.models import NetSpec, rule_warnings
from tessera.plans.rounds import barrier_slots
from tessera.plans.training import (ModelState, drop_training_rows, feature_bytes, new_model,
                                    prepare_training_rows, train_fit)
from tessera.session import delete_path, materialize, scratch_path
from tessera.sources.metrics import read_metrics
from tessera.sources.tensors import pack_tensors


@dataclass(frozen=True)
class JobConfig:
    epochs: int = 50
    batch_size: int = 30
    workers: int | None = None  # None: by the number of training rows (batching.worker_count)
    averaging_frequency: int = 5
    train_share: float = 0.8
    seed: int = 42
    # Random cap before the split (the local job's 300). For image folders, cap the
    # paths before decoding instead (``sources.images.read_capped``).
    max_examples: int | None = None
    weighted_average: bool = False
    materialize_examples: bool = True  # decode/resize once; later passes read columns of a file
    pack_tensors: bool = True          # numeric arrays travel as flat float32 bytes
    run_id: str = "run"
    metrics_every: int = 1             # keep the metrics of every n-th batch (a score listener's frequency)
    save_path: str | None = None       # model store that gets the trained model as its next version
    checkpoint_path: str | None = None  # rounds stay here, and ``resume`` goes on from them
    resume: bool = False


# Where a run leaves things is no parameter of the model: not in the report.
_NOT_REPORTED = ("metrics_every", "save_path", "checkpoint_path", "resume")


@dataclass
class JobResult:
    model: ModelState
    vocab: DataFrame
    predictions: DataFrame
    confusion: DataFrame
    metrics: DataFrame
    summary: DataFrame
    training_metrics: DataFrame
    report: DataFrame
    sample: DataFrame

    cached: DataFrame | None = None
    scratch: tuple = ()

    def release(self, delete_files: bool = False) -> None:
        """Drop the cached scoring pass behind ``confusion`` and ``metrics``.

        With ``delete_files`` also delete the job's scratch folders (the
        written examples and training rows -- at scale, a full copy of the
        data -- the vocabulary, the training metrics and the scoring model's
        file). The result frames read those lazily: only once done."""
        if self.cached is not None:
            self.cached.unpersist()
        if delete_files:
            spark = self.report.sparkSession
            for p in self.scratch:
                delete_path(spark, p)


def fmt_duration(ms: int) -> str:
    """Driver-side twin of ``tessera.functions.text.duration_text``."""
    return f"{ms // 60000} min, {(ms // 1000) % 60} sec, {ms % 1000} ms"


def run_job(spark: SparkSession, examples: DataFrame, spec: NetSpec, cfg: JobConfig = JobConfig()) -> JobResult:
    t_total = time.time()
    ex = examples.select("id", F.col("label").cast("string").alias("label"), "features")
    if cfg.max_examples is not None:
        ex = sample_cap(ex, "id", cfg.max_examples, cfg.seed)
    if cfg.pack_tensors:
        if isinstance(ex.schema["features"].dataType, T.ArrayType):
            spec = replace(spec, packed="float32")
        ex = pack_tensors(ex, "features")
    scratch = []
    # Undecodable images arrive with NULL features. They and rows without a label
    # are counted in the report and left out.
    bad = F.col("features").isNull()
    counts = [F.count_if(bad).alias("invalid"), F.count_if(~bad & F.col("label").isNull()).alias("unlabelled"),
              F.count_if(~bad & F.col("label").isNotNull()).alias("good")]
    if cfg.materialize_examples:
        # Examples feed five passes (vocabulary, offsets, training rows, test
        # split, sample). Written once, the image decode and resize run once,
        # the label-only passes read one column, and the write itself counts the rows.
        scratch.append(scratch_path(spark, "examples"))
        seen = Observation(f"examples-{uuid.uuid4().hex[:8]}")
        ex = materialize(ex.observe(seen, *counts), "examples", path=scratch[-1])
        left_out = seen.get
    else:
        left_out = ex.agg(*counts).first().asDict()
    if cfg.workers is None:
        n_train = math.floor(cfg.train_share * left_out["good"] + 0.5)
        cfg = replace(cfg, workers=worker_count(n_train, cfg.batch_size, cfg.averaging_frequency))
    ex = ex.filter(~bad & F.col("label").isNotNull())
    scratch.append(scratch_path(spark, "vocab"))
    vocab = label_vocab(ex, "label", with_counts=False, path=scratch[-1])
    n_labels, width = vocab.count(), spec.layers[-1].out
    if n_labels > width:
        raise ValueError(f"{n_labels} labels in the examples, but the model {spec.name!r} has {width} outputs")
    indexed = index_labels(ex, vocab, "label", salt_col="id")
    # Positions by the window's own hash exchange: the training rows are
    # reshuffled by (round group, worker) for bucketing anyway, so a range
    # partitioning (and its sampling pass over the examples) would buy nothing.
    train = split_side(indexed, "id", "train", cfg.train_share, cfg.seed, positions=True)
    table_name = f"tessera_train_{uuid.uuid4().hex[:12]}"
    # Row size from the written examples (one row read), not from the ranked split.
    scratch.append(scratch_path(spark, "train-rows"))
    rows = prepare_training_rows(train, cfg.batch_size, cfg.workers, cfg.averaging_frequency,
                                 table_name=table_name, row_bytes=feature_bytes(ex, "features"),
                                 path=scratch[-1], slots=barrier_slots(spark, cfg.workers))

    t0 = time.time()
    scratch.append(scratch_path(spark, "metrics"))
    model, metrics_path = train_fit(spec, rows, cfg.epochs, new_model(spec), weighted=cfg.weighted_average,
                                    metrics_path=scratch[-1], run_id=cfg.run_id, checkpoint_path=cfg.checkpoint_path,
                                    resume=cfg.resume, metrics_every=cfg.metrics_every, save_path=cfg.save_path)
    train_ms = int((time.time() - t0) * 1000)
    drop_training_rows(spark, table_name)

    t0 = time.time()
    test_side = split_side(indexed, "id", "test", cfg.train_share, cfg.seed, positions=False)
    test = test_side.select("id", F.col("label_idx").alias("actual"), "features")
    scratch.append(share_params(spark, model.params, "scoring"))  # one file for both scoring passes
    pred = score_batch(test, spec, model.params, keep=["id", "actual"], shared=scratch[-1])
    with_nll = confusion_matrix(pred, probs_col="probs").cache()  # the one scoring pass
    confusion = with_nll.select("actual", "predicted", "n")
    metrics = class_metrics(confusion, vocab)
    summary = eval_summary(metrics)
    s = summary.first()
    score = with_nll.agg((F.sum("nll_sum") / F.sum("n")).alias("score")).first()["score"]
    test_ms = int((time.time() - t0) * 1000)
    total_ms = int((time.time() - t_total) * 1000)

    shape = dict(zip(("channels", "height", "width") if len(spec.input_shape) == 3 else ("inputs",), spec.input_shape))
    params = {k: str(v) for k, v in {**{k: v for k, v in asdict(cfg).items() if k not in _NOT_REPORTED}, **shape, "num_labels": n_labels, "iterations": spec.rules.iterations}.items()}
    report_row = {
        "run_id": cfg.run_id, "model": spec.name, "params": params,
        "warnings": rule_warnings(spec),
        "n_invalid": left_out["invalid"], "n_unlabelled": left_out["unlabelled"], "n_test": int(s["n"] or 0), "accuracy": s["accuracy"],
        "macro_precision": s["macro_precision"], "macro_recall": s["macro_recall"], "macro_f1": s["macro_f1"],
        "test_score": score,
        "train_ms": train_ms, "test_ms": test_ms, "total_ms": total_ms,
        "train_time": fmt_duration(train_ms), "test_time": fmt_duration(test_ms),
        "total_time": fmt_duration(total_ms),
    }
    report = spark.createDataFrame([report_row], REPORT_SCHEMA)
    # One example, as the local job prints it: the first test row in seeded order.
    first = test_side.orderBy("order_key", "id").limit(1).select("id", F.col("label_idx").alias("actual"), "features")
    sample = predict_named(score_batch(first, spec, model.params, keep=["id", "actual"], shared=scratch[-1]), vocab) \
        .select("id", "expected", "predicted_name")
    return JobResult(model, vocab, pred, confusion, metrics, summary,
                     read_metrics(spark, metrics_path), report, sample, with_nll, tuple(scratch))


REPORT_SCHEMA = ("run_id string, model string, params map<string,string>, warnings array<string>, "
                 "n_invalid long, n_unlabelled long, n_test long, "
                 "accuracy double, macro_precision double, macro_recall double, macro_f1 double, test_score double, "
                 "train_ms long, test_ms long, total_ms long, train_time string, test_time string, "
                 "total_time string")
