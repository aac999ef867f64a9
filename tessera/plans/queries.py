"""The registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the given tables. Floats are rounded to 6 digits so results
compare with the SQL oracles in ``tessera.plans.oracles``.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import arrays as A
from tessera.functions import layers as L
from tessera.functions.text import duration_text, parent_name
from tessera.operators.averaging import param_average
from tessera.operators import batching as B
from tessera.operators.evaluation import class_metrics, confusion_matrix, eval_summary, nll_score
from tessera.operators.labels import label_vocab as build_vocab
from tessera.operators.sampling import sample_cap as cap_rows
from tessera.operators.sampling import seeded_shuffle as shuffle_rows
from tessera.operators.sampling import split_exact as split_rows
from tessera.operators.sampling import split_hash as hash_split_rows
from tessera.operators.sampling import split_side
from tessera.operators.scoring import predict_named as name_predictions
from tessera.operators.scoring import score_batch as score_rows
from tessera.plans import formula
from tessera.plans.models import Dropout, NetSpec, Output, Rules, small_dense_net
from tessera.plans.training import (ModelState, drop_training_rows, full_batch_step, load_trained, new_model,
                                    prepare_training_rows, run_round)
from tessera.plans.training import train_fit as fit_rounds
from tessera.plans.rounds import barrier_slots
from tessera.session import delete_path, scratch_path, table
from tessera.sources.metrics import read_metrics
from tessera.sources.tensors import embeddings, tensor_stats

# Fixed values of the query set: the original job's seed and share, the
# local job's cap and batch size, averaging every 5 batches.
SEED = 42
TRAIN_SHARE = 0.8
CAP = 300
BATCH = 18
AVG_FREQ = 5
EPOCHS = 3
R6 = 6


def _emb(spark, sf_dir):
    return embeddings(spark, sf_dir)


def _formula_net() -> tuple[NetSpec, dict]:
    spec = small_dense_net(formula.SIDE * formula.SIDE, formula.N_CLASSES)
    w, b = formula.dense_weights()
    return spec, {"output.W": w, "output.b": b}


def _softmax_regression() -> NetSpec:
    return NetSpec("SoftmaxRegression", (formula.SIDE * formula.SIDE,),
                   (Output("output", formula.N_CLASSES),), Rules(updater="sgd", lr=formula.TRAIN_LR))


def _native_predictions(spark, sf_dir) -> DataFrame:
    """Formula dense 64->10 + softmax, JVM-side array expressions."""
    w, b = formula.dense_weights()
    e = _emb(spark, sf_dir)
    z = A.dense("features", w, b)
    return (e.select(F.col("id").alias("vec_id"), F.col("label_idx").alias("actual"), z.alias("_z"))
            .withColumn("probs", A.softmax("_z"))
            .withColumn("predicted", A.argmax("probs"))
            .drop("_z"))


def _scored_predictions(spark, sf_dir) -> DataFrame:
    """The same predictions by one batch-scoring pass, for the evaluation keys."""
    spec, params = _formula_net()
    e = _emb(spark, sf_dir).select(F.col("id").alias("vec_id"), F.col("label_idx").alias("actual"), "features")
    return score_rows(e, spec, params, "features", keep=["vec_id", "actual"])


# ---- scans, labels ------------------------------------------------------------

def tensor_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("features"))
    return tensor_stats(e)


def _page_labels(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", parent_name("url").alias("label"))


def label_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_labels(spark, sf_dir)


def label_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_vocab(_page_labels(spark, sf_dir), "label")


# ---- sampling, splitting, batching ------------------------------------------

def _emb_ids(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", "label")


def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffle_rows(_emb_ids(spark, sf_dir), "vec_id", SEED)


def sample_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_rows(_emb_ids(spark, sf_dir), "vec_id", CAP, SEED)


def split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (split_rows(_emb_ids(spark, sf_dir), "vec_id", TRAIN_SHARE, SEED)
            .select("vec_id", "label", "rn", "split", "split_rn", "n_split"))


def split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split_rows(_emb_ids(spark, sf_dir), "vec_id", TRAIN_SHARE, SEED)


def _train_rows(spark, sf_dir):
    # Only the train side is ranked; buckets wholly in the test share never shuffle.
    return split_side(_emb_ids(spark, sf_dir), "vec_id", "train", TRAIN_SHARE, SEED, positions=True)


def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = batch_assign_rows(_train_rows(spark, sf_dir), _workers(spark, sf_dir))
    return b.select("vec_id", "split_rn", "batch_id", "pos", "worker", "round")


def _workers(spark, sf_dir) -> int:
    """Workers by the train rows (the table's count comes from Parquet footers)."""
    n_train = math.floor(TRAIN_SHARE * _emb(spark, sf_dir).count() + 0.5)
    return B.worker_count(n_train, BATCH, AVG_FREQ)


def batch_assign_rows(df, workers=B.MIN_WORKERS):
    return B.batch_assign(df, "split_rn", BATCH, workers, AVG_FREQ)


def epoch_repeat_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = batch_assign_rows(_train_rows(spark, sf_dir)).withColumn(
        "n_batches", F.ceil(F.col("n_split") / BATCH).cast("long"))
    return B.epoch_repeat(b, EPOCHS, "n_batches").select("vec_id", "epoch", "batch_id", "step")


# ---- array functions and layers ---------------------------------------------

def scale_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _emb(spark, sf_dir)
    s = A.scale_range("features", -1.0, 1.0, 0.0, 1.0)
    return (e.select(F.col("id").alias("vec_id"), F.posexplode(s).alias("i", "value"))
            .withColumn("value", F.round("value", R6)))


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _emb(spark, sf_dir)
    return e.select(F.col("id").alias("vec_id"),
                    F.posexplode(A.one_hot("label_idx", formula.N_CLASSES)).alias("k", "value"))


def dense_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, b = formula.dense_weights()
    e = _emb(spark, sf_dir)
    out = A.relu(A.dense("features", w, b))
    return (e.select(F.col("id").alias("vec_id"), F.posexplode(out).alias("k", "value"))
            .withColumn("value", F.round("value", R6)))


def _prediction_columns(pred: DataFrame) -> DataFrame:
    return pred.select("vec_id", "actual", "predicted",
                       F.round(F.array_max("probs"), R6).alias("p_max"),
                       F.round(A.nll("probs", "actual"), R6).alias("nll"))


def softmax_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prediction_columns(_native_predictions(spark, sf_dir))


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prediction_columns(_scored_predictions(spark, sf_dir))


def _long_frame(ids, arr, names):
    """Unnest an ``[N, ...]`` array to long rows ``(vec_id, *index, value)``."""
    idx = np.indices(arr.shape[1:]).reshape(len(arr.shape) - 1, -1)
    n, per = arr.shape[0], idx.shape[1]
    cols = {"vec_id": np.repeat(ids, per)}
    for name, row in zip(names, idx):
        cols[name] = np.tile(row, n).astype("int32")
    cols["value"] = np.round(arr.reshape(n, per).reshape(-1), R6)
    return pd.DataFrame(cols)


def _layer_query(spark, sf_dir, fn, names, schema):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")

    def run(it):
        for pdf in it:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf["embedding"].to_numpy()).astype(np.float64)
            yield _long_frame(pdf["vec_id"].to_numpy(), fn(x), names)

    return e.mapInPandas(run, schema)


def conv2d_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    w, b = formula.conv_kernel()

    def fn(x):
        return L.conv2d_forward(x.reshape(-1, 1, 8, 8), w, b, (1, 1), (1, 1))[0]
    return _layer_query(spark, sf_dir, fn, ["c", "y", "x"],
                        "vec_id long, c int, y int, x int, value double")


def maxpool_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fn(x):
        return L.maxpool_forward(x.reshape(-1, 1, 8, 8), (2, 2), (2, 2))[0][:, 0]
    return _layer_query(spark, sf_dir, fn, ["y", "x"], "vec_id long, y int, x int, value double")


def lrn_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fn(x):
        return L.lrn_forward(x.reshape(-1, 64, 1, 1))[0][:, :, 0, 0]
    return _layer_query(spark, sf_dir, fn, ["c"], "vec_id long, c int, value double")


# ---- evaluation ---------------------------------------------------------------

def _classes(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("label").alias("label_idx")).distinct()


def confusion_matrix_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(_scored_predictions(spark, sf_dir))


def _rounded_metrics(m: DataFrame) -> DataFrame:
    return m.select("label_idx", "tp", "fp", "fn", "support",
                    *[F.round(c, R6).alias(c) for c in ("precision", "recall", "f1")])


def class_metrics_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cm = confusion_matrix(_scored_predictions(spark, sf_dir))
    return _rounded_metrics(class_metrics(cm, _classes(spark, sf_dir)))


def _rounded_summary(s: DataFrame) -> DataFrame:
    return s.select("n_classes", "n", *[F.round(c, R6).alias(c) for c in
                                        ("accuracy", "macro_precision", "macro_recall", "macro_f1")])


def eval_summary_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cm = confusion_matrix(_scored_predictions(spark, sf_dir))
    return _rounded_summary(eval_summary(class_metrics(cm, _classes(spark, sf_dir))))


def nll_score_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = nll_score(_scored_predictions(spark, sf_dir), "probs", "actual")
    return s.select("n", F.round("score", R6).alias("score"))


def _binary_predictions(spark, sf_dir):
    return table(spark, sf_dir, "labels").select(F.col("quality").alias("actual"),
                                                 F.col("toxic").alias("predicted"))


def confusion_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_matrix(_binary_predictions(spark, sf_dir))


def eval_summary_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    classes = (lab.select(F.col("quality").alias("label_idx"))
               .unionByName(lab.select(F.col("toxic").alias("label_idx"))).distinct())
    return _rounded_summary(eval_summary(class_metrics(confusion_matrix(_binary_predictions(spark, sf_dir)),
                                                       classes)))


# ---- averaging and training ---------------------------------------------------

def param_average_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    chunks = e.select(F.lit("embedding").alias("param"), F.col("label").alias("chunk"),
                      F.col("embedding").cast("array<double>").alias("values"))
    avg = param_average(chunks)
    return (avg.select("chunk", F.posexplode("values").alias("i", "value"))
            .withColumn("value", F.round("value", R6)))


def _model_rows(spark, model: ModelState) -> DataFrame:
    w, b = model.params["output.W"], model.params["output.b"]
    k, i = np.indices(w.shape)
    rows = pd.DataFrame({"k": np.concatenate([k.reshape(-1), np.arange(len(b))]).astype("int32"),
                         "i": np.concatenate([i.reshape(-1), np.full(len(b), w.shape[1])]).astype("int32"),
                         "value": np.round(np.concatenate([w.reshape(-1), b]), R6)})
    return spark.createDataFrame(rows, "k int, i int, value double")


def train_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = _softmax_regression()
    model = full_batch_step(spec, new_model(spec, zeros=True), _emb(spark, sf_dir))
    return _model_rows(spark, model)


def train_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round in which every worker takes one plain-SGD batch of 30 rows
    from zero; with example-weighted averaging the round equals one
    full-batch step over the whole table. Groups stay 30 rows however large
    the table; the averaging tree bounds every reducer group."""
    spec = _softmax_regression()
    n = _emb(spark, sf_dir).count()  # the base scan: counting the ranked frame would run its shuffle
    e = shuffle_rows(_emb(spark, sf_dir), "id", SEED)
    batch = 30
    workers = max(1, math.ceil(n / batch))
    rows = B.batch_assign(e, "rn", batch, workers, 1)
    model = run_round(spec, new_model(spec, zeros=True), rows, weighted=True, workers=workers)
    return _model_rows(spark, model)


# ---- prediction text, durations -------------------------------------------------

def predict_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, params = _formula_net()
    # The test side is placed by bucket (no ranking); the first row is a top-1.
    test = split_side(_emb(spark, sf_dir), "id", "test", TRAIN_SHARE, SEED, positions=False)
    first = test.orderBy("order_key", "id").limit(1)
    pred = score_rows(first.select(F.col("id").alias("vec_id"), F.col("label_idx").alias("actual"), "features"),
                      spec, params, "features", keep=["vec_id", "actual"])
    vocab = build_vocab(_emb(spark, sf_dir), "label", with_counts=False)
    return name_predictions(pred, vocab).select("vec_id", "expected", "predicted_name")


def duration_text_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 997).alias("ms"))
    return ev.select("event_id", "ms", duration_text("ms").alias("text"))


# ---- whole training runs -------------------------------------------------------

def tiny_cnn(seed: int = SEED) -> NetSpec:
    """The tensor table read as 8x8x1 images: conv 3x3 (8) -> max-pool -> dense 32 -> softmax 10."""
    from tessera.plans.models import Conv, Dense, Pool
    return NetSpec("TinyCNN", (1, formula.SIDE, formula.SIDE), (
        Conv("cnn1", 8, (3, 3), (1, 1), (1, 1), 0.0),
        Pool("maxpool1", (2, 2)),
        Dense("dense", 32),
        Output("output", formula.N_CLASSES),
    ), Rules(updater="nesterovs", lr=0.01, momentum=0.9, init="xavier"), seed)


JOB = dict(batch_size=BATCH, averaging_frequency=AVG_FREQ)


def _regression(updater: str, lr: float, **rules) -> NetSpec:
    """Softmax regression from zero weights: small enough to be trained in SQL as well."""
    return replace(_softmax_regression(), rules=Rules(updater=updater, lr=lr, init="normal", init_std=0.0, **rules))


def _trained(spark, sf_dir, spec: NetSpec, epochs: int, run_id: str, save_path: str | None = None,
             model: ModelState | None = None):
    """Averaged training of ``spec`` on the train split: (model, metrics folder). The
    training rows are deleted once the model is there."""
    train = split_side(_emb(spark, sf_dir), "id", "train", TRAIN_SHARE, SEED, positions=True)
    name, workers = f"tessera_train_{uuid.uuid4().hex[:12]}", _workers(spark, sf_dir)
    folder = scratch_path(spark, "train-rows")
    rows = prepare_training_rows(train, BATCH, workers, AVG_FREQ, table_name=name, path=folder,
                                 slots=barrier_slots(spark, workers))
    try:
        return fit_rounds(spec, rows, epochs, model, run_id=run_id, save_path=save_path)
    finally:
        drop_training_rows(spark, name)
        delete_path(spark, folder)


def train_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights after two epochs of averaged SGD whose rate halves every seven steps."""
    model, _ = _trained(spark, sf_dir, _regression("sgd", 0.5, lr_decay=0.5, lr_steps=7), 2, "train_fit")
    return _model_rows(spark, model)


def train_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights after an epoch from the formula weights, with dropout of the inputs, gradients summed over
    the batch and scaled to length 1 per layer, and a rate of its own for biases."""
    spec = NetSpec("DroppedRegression", (formula.SIDE * formula.SIDE,),
                   (Dropout("drop", 0.25), Output("output", formula.N_CLASSES)),
                   Rules(updater="sgd", lr=0.1, bias_lr=0.2, grad_norm="l2_per_layer", mini_batch=False))
    model, _ = _trained(spark, sf_dir, spec, 1, "train_rules", model=ModelState(_formula_net()[1]))
    return _model_rows(spark, model)


def training_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch metrics of two epochs of Nesterov momentum with L2."""
    spec = _regression("nesterovs", 0.1, momentum=0.9, l2=0.01)
    _, path = _trained(spark, sf_dir, spec, 2, "training_metrics")
    return read_metrics(spark, path).select("epoch", "round", "worker", "batch", "examples",
                                            F.round("score", R6).alias("score"), "step")


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of an RMSProp epoch, saved with their spec and read back."""
    spec, path = _regression("rmsprop", 0.05), scratch_path(spark, "model")
    _trained(spark, sf_dir, spec, 1, "model_roundtrip", save_path=path)
    back_spec, back = load_trained(spark, path)
    delete_path(spark, path)
    if back_spec != spec:
        raise AssertionError("the saved spec does not round-trip")
    return _model_rows(spark, back)


def image_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original local job's shape on image shards: Spark packs the
    tensor table as PNGs, reads and resizes them to LeNet's smallest input
    (20x20, 3 channels, 8-bit), trains LeNet one epoch (batch 18,
    averaging every 5 batches) and evaluates on the test split."""
    from tessera.plans.job import JobConfig, run_job
    from tessera.plans.models import preset
    from tessera.sources.images import image_id, to_tensors
    imgs = to_tensors(_derived_images(spark, sf_dir), 20, 20, 3, as_bytes=True)
    ex = imgs.select(image_id("path").cast("long").alias("id"), "label", "features")
    spec = preset("LeNet", channels=3, height=20, width=20, num_labels=formula.N_CLASSES).with_scale(1 / 255)
    res = run_job(spark, ex, spec, JobConfig(run_id="image_job", epochs=1, **JOB))
    return _rounded_metrics(res.metrics)


def image_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on colour images from shards (8x8 RGB -> 4x16 grey): its report but for the times."""
    from tessera.plans.job import JobConfig, run_job
    from tessera.sources.images import image_id, to_tensors
    imgs = to_tensors(_derived_images(spark, sf_dir, rgb=True), 4, 16, 1, doubles=True)
    ex = imgs.select(image_id("path").cast("long").alias("id"), "label", "features")
    spec = _regression("sgd", 0.5).with_scale(1 / 255)
    cfg = JobConfig(run_id="image_train", epochs=2, pack_tensors=False, **JOB)
    return _report_columns(run_job(spark, ex, spec, cfg).report)


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on the tensor table: its report but for the times."""
    from tessera.plans.job import JobConfig, run_job
    ex = _emb(spark, sf_dir).select("id", "label", "features")
    return _report_columns(run_job(spark, ex, _regression("sgd", 2.0), JobConfig(run_id="run_report", epochs=3, **JOB)).report)


def _report_columns(r: DataFrame) -> DataFrame:
    return r.select("run_id", "model", *[F.col("params")[c].alias(c) for c in ("epochs", "workers", "num_labels")],
                    "n_invalid", "n_unlabelled", "n_test",
                    *[F.round(c, R6).alias(c) for c in ("accuracy", "macro_precision", "macro_recall", "macro_f1", "test_score")])


# ---- image shards derived from the tensor table ---------------------------------

def _pixels(v):
    """8-bit grey level of a value in [-1, 1]: floor((v + 1) * 127.5 + 0.5), clipped."""
    return F.least(F.greatest(F.floor((v.cast("double") + 1) * 127.5 + 0.5), F.lit(0)), F.lit(255)).cast("int")


def derived_shards(spark: SparkSession, sf_dir: str, rgb: bool = False) -> str:
    """Spark packs every ``embeddings`` row as an 8x8 PNG ``<label>/<vec_id>.png`` (grey; or red p,
    green 255 - p, blue (7 p + i) mod 256), each beside a ``.jpg`` entry with other pixels, which
    only the extension filter keeps out. Returns the folder."""
    from tessera.sources.images import png_bytes
    from tessera.sources.shards import ENTRY, raw_body, write_shards
    side = formula.SIDE
    e = table(spark, sf_dir, "embeddings").select(
        F.concat_ws("/", "label", "vec_id").alias("name"), F.transform("embedding", _pixels).alias("pixels"))

    def pack(batches):
        for b in batches:
            out = []
            for name, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = np.array(p)
                px = np.stack([p, 255 - p, (7 * p + np.arange(len(p))) % 256], axis=-1) if rgb else p
                out.append((f"{name}.png", "png", png_bytes(px.reshape(side, side, 3) if rgb else px.reshape(side, side))))
                out.append((f"{name}.jpg", "raw", raw_body(side, side, 1, (255 - p).astype(np.uint8).tobytes())))
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out)], ["path", "kind", "body"])

    root = scratch_path(spark, "shards")
    write_shards(e.mapInArrow(pack, ENTRY), root)
    return root


def _derived_images(spark, sf_dir, rgb=False):
    from tessera.sources.shards import read_shards
    return read_shards(spark, derived_shards(spark, sf_dir, rgb), [".png"])


def image_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.sources.images import image_id
    return _derived_images(spark, sf_dir).select(
        image_id("path").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
        "height", "width", "n_channels", _byte_sum("data").alias("pixel_sum"))


def _byte_sum(col):
    @F.pandas_udf("long")
    def byte_sum(s: pd.Series) -> pd.Series:
        upto = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(s), np.uint8), dtype=np.int64)])
        return pd.Series(np.diff(upto[np.concatenate([[0], np.cumsum([len(b) for b in s], dtype=np.int64)])]))
    return byte_sum(F.col(col))


def _resized(images: DataFrame, height: int, width: int, channels: int) -> DataFrame:
    """Long rows of the resized images, scaled to [0, 1]: vec_id, c, y, x, value."""
    from tessera.sources.images import image_id, to_tensors
    t = to_tensors(images, height, width, channels, doubles=True)
    plane = height * width
    return (t.select(image_id("path").cast("long").alias("vec_id"),
                     F.posexplode(A.scale_range("features", 0.0, 255.0, 0.0, 1.0)).alias("i", "value"))
            .select("vec_id", F.floor(F.col("i") / plane).cast("int").alias("c"),
                    F.floor(F.col("i") % plane / width).cast("int").alias("y"), (F.col("i") % width).alias("x"),
                    F.round("value", R6).alias("value")))


def image_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode, bilinear resize 8x8 -> 4x4, scale to [0, 1]."""
    return _resized(_derived_images(spark, sf_dir), 4, 4, 1).drop("c")


def image_resize_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratios that are no whole numbers, up and down, and grey -> 3 channels: 8x8x1 -> 11x5x3."""
    return _resized(_derived_images(spark, sf_dir), 11, 5, 3)


def image_grey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colour -> grey: 8x8x3 -> 3x13x1."""
    return _resized(_derived_images(spark, sf_dir, rgb=True), 3, 13, 1).drop("c")


QUERIES = {
    "tensor_scan": tensor_scan,
    "label_from_path": label_from_path,
    "label_vocab": label_vocab,
    "seeded_shuffle": seeded_shuffle,
    "sample_cap": sample_cap,
    "split_exact": split_exact,
    "split_hash": split_hash,
    "batch_assign": batch_assign,
    "epoch_repeat": epoch_repeat_q,
    "scale_range": scale_range,
    "one_hot": one_hot,
    "dense_forward": dense_forward,
    "softmax_predict": softmax_predict,
    "score_batch": score_batch,
    "conv2d_forward": conv2d_forward,
    "maxpool_forward": maxpool_forward,
    "lrn_forward": lrn_forward,
    "confusion_matrix": confusion_matrix_q,
    "class_metrics": class_metrics_q,
    "eval_summary": eval_summary_q,
    "nll_score": nll_score_q,
    "confusion_binary": confusion_binary,
    "eval_summary_binary": eval_summary_binary,
    "param_average": param_average_q,
    "train_step": train_step,
    "train_round": train_round,
    "predict_named": predict_named,
    "duration_text": duration_text_q,
    "image_scan": image_scan,
    "image_resize": image_resize,
    "image_resize_up": image_resize_up,
    "image_grey": image_grey,
    "image_train": image_train,
    "train_fit": train_fit,
    "train_rules": train_rules,
    "training_metrics": training_metrics,
    "model_roundtrip": model_roundtrip,
    "run_report": run_report,
    "image_job": image_job,
}
