"""Quality score by a byte-level convolutional network in NumPy.

A text's UTF-8 bytes are covered by overlapping chunks. In each chunk, embedded bytes
meet a bank of learned filters (``WIDTH`` bytes wide, every ``STEP`` bytes); each filter
keeps its largest response in the chunk, a small dense layer turns those into a chunk
score, and the mean and a soft maximum and minimum of the chunk scores make one
probability. Every byte of every text is read.

Learning: a bounded sample of labelled rows (``max_docs``, equal numbers of both
labels where there are enough, the smallest md5 keys of the id; only texts of at most
``MAX_TRAIN_BYTES``), trained by Adam in one task; sample and weights are bounded by
parameters. Scoring is a narrow map with the broadcast weights (about 30 KB), in
slices of ``SLICE`` chunks, so a very long text never needs more memory than a slice.

Defined cases: NULL text counts as empty, and an empty text is one chunk of padding;
labels other than 0 and 1 and conflicting repeats are left out; without both labels
every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.operators.sampling import seeded_key

CHUNK, STRIDE = 256, 224
EMBED, WIDTH, STEP, FILTERS, HIDDEN = 8, 8, 2, 32, 16
SLICE = 512
MAX_DOCS = 1_600
MAX_TRAIN_BYTES = 8_192
STEPS, BATCH, RATE, SEED = 1_600, 16, 0.004, 42
PAD = 256


def chunks(raw: bytes) -> np.ndarray:
    """Overlapping chunks that cover all bytes: [n, CHUNK] of 0..255, 256 = padding."""
    n = 1 if len(raw) <= CHUNK else 1 + -(-(len(raw) - CHUNK) // STRIDE)
    buf = np.full((n - 1) * STRIDE + CHUNK, PAD, np.int16)
    buf[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.as_strided(buf, (n, CHUNK), (STRIDE * 2, 2)).copy()


def init(seed: int = SEED) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)

    def g(*shape, scale):
        return (r.standard_normal(shape) * scale).astype(np.float32)
    return {"embed": g(PAD + 1, EMBED, scale=0.5), "filters": g(WIDTH * EMBED, FILTERS, scale=0.2),
            "fbias": np.zeros(FILTERS, np.float32), "w1": g(FILTERS + 1, HIDDEN, scale=0.25),
            "b1": np.zeros(HIDDEN, np.float32), "w2": g(HIDDEN, scale=0.3),
            "head": np.array([1.0, 0.3, 0.3, 0.0], np.float32)}


def _windows(p: dict, c: np.ndarray) -> np.ndarray:
    """[chunks, positions, WIDTH * EMBED] of embedded bytes."""
    e = np.ascontiguousarray(p["embed"][c])
    m = (CHUNK - WIDTH) // STEP + 1
    s = e.strides
    return np.lib.stride_tricks.as_strided(e, (len(c), m, WIDTH * EMBED), (s[0], STEP * s[1], s[2]))


def _chunk_scores(p: dict, c: np.ndarray, keep: bool = False):
    win = _windows(p, c)
    resp = win.reshape(-1, WIDTH * EMBED) @ p["filters"]
    resp = resp.reshape(len(c), -1, FILTERS)
    at = resp.argmax(axis=1)
    pooled = np.maximum(np.take_along_axis(resp, at[:, None, :], 1)[:, 0, :] + p["fbias"], 0)
    fill = ((c != PAD).sum(axis=1, keepdims=True) / CHUNK).astype(np.float32)
    x = np.concatenate([pooled, fill], axis=1)
    h = np.maximum(x @ p["w1"] + p["b1"], 0)
    s = h @ p["w2"]
    return (s, (win, at, x, h)) if keep else s


def _combine(head: np.ndarray, s: np.ndarray) -> tuple[float, np.ndarray]:
    """Logit from chunk scores and its slope in each of them."""
    up = np.exp(s - s.max())
    down = np.exp(s.min() - s)
    soft_max, soft_min = np.log(up.sum()) + s.max() - np.log(len(s)), -np.log(down.sum()) + s.min() + np.log(len(s))
    logit = head[0] * s.mean() + head[1] * soft_max + head[2] * soft_min + head[3]
    return float(logit), head[0] / len(s) + head[1] * up / up.sum() + head[2] * down / down.sum()


def train(raws: list[bytes], labels: np.ndarray, seed: int = SEED) -> dict[str, np.ndarray]:
    p, r = init(seed), np.random.default_rng(seed)
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    # Every text also counts as a short piece of itself, so that length decides nothing.
    cuts = [(int(r.integers(0, max(1, len(x) - 24))), int(r.integers(24, 200))) for x in raws]
    raws = [*raws, *[x[a:a + n] for x, (a, n) in zip(raws, cuts)]]
    labels = np.concatenate([labels, labels])
    pieces, step = [chunks(x) for x in raws], 0
    while step < STEPS:  # the same effort whatever the number of labels
        order = r.permutation(len(raws))
        for a in range(0, len(order), BATCH):
            rate = RATE * max(0.1, 1 - 0.9 * step / STEPS)
            g = {k: np.zeros_like(v) for k, v in p.items()}
            part = order[a:a + BATCH]
            c = np.concatenate([pieces[i] for i in part])
            s, (win, at, x, h) = _chunk_scores(p, c, keep=True)
            ds, lo = np.zeros_like(s), 0
            for i in part:
                hi = lo + len(pieces[i])
                own = s[lo:hi]
                logit, slope = _combine(p["head"], own)
                d = (1 / (1 + np.exp(-logit)) - labels[i]) / len(part)
                ds[lo:hi] = d * slope
                up, down = np.exp(own - own.max()), np.exp(own.min() - own)
                g["head"] += d * np.array([own.mean(), np.log(up.mean()) + own.max(), own.min() - np.log(down.mean()), 1])
                lo = hi
            g["w2"] = h.T @ ds
            dh = (ds[:, None] * p["w2"]) * (h > 0)
            g["w1"], g["b1"] = x.T @ dh, dh.sum(axis=0)
            dx = (dh @ p["w1"].T)[:, :FILTERS] * (x[:, :FILTERS] > 0)
            g["fbias"] = dx.sum(axis=0)
            rows = np.arange(len(c))
            for f in range(FILTERS):  # only the winning window of each filter learns
                hit = win[rows, at[:, f]]
                g["filters"][:, f] = hit.T @ dx[:, f]
                back = (dx[:, f, None] * p["filters"][:, f]).reshape(len(c), WIDTH, EMBED)
                pos = at[:, f, None] * STEP + np.arange(WIDTH)
                np.add.at(g["embed"], c[rows[:, None], pos], back)
            step += 1
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
                p[k] = (p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-7)
                        ).astype(np.float32)
    return p


def probabilities(p: dict, raws: list[bytes]) -> np.ndarray:
    if "constant" in p:
        return np.full(len(raws), p["constant"])
    out = np.zeros(len(raws))
    start, size = 0, 0

    def flush(a, b):
        cut = [chunks(x) for x in raws[a:b]]
        c = np.concatenate(cut)
        s = np.concatenate([_chunk_scores(p, c[i:i + SLICE]) for i in range(0, len(c), SLICE)]).astype(np.float64)
        lo = 0
        for i, x in zip(range(a, b), cut):
            logit = _combine(p["head"], s[lo:lo + len(x)])[0]
            out[i] = 1 / (1 + np.exp(-np.clip(logit, -40, 40)))
            lo += len(x)
    for i, x in enumerate(raws):
        size += len(x) + CHUNK
        if size >= 1 << 18:
            flush(start, i + 1)
            start, size = i + 1, 0
    if start < len(raws):
        flush(start, len(raws))
    return out


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_docs: int = MAX_DOCS) -> dict:
    """Weights from ``labelled`` (doc_id, label) rows."""
    clean = (labelled.select(F.col("doc_id").cast("long"), F.col("label").cast("int"))
             .filter("doc_id IS NOT NULL AND label IN (0, 1)")
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_hi")).filter("label = _hi"))
    half = [clean.filter(F.col("label") == y).orderBy(seeded_key("doc_id"), "doc_id").limit(max_docs // 2) for y in (0, 1)]
    chosen = half[0].unionByName(half[1]).select("doc_id", "label")
    rows = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs[text_col]).cast("binary").alias("raw"))
            .filter(F.octet_length("raw") <= MAX_TRAIN_BYTES).join(F.broadcast(chosen), "doc_id")
            .groupBy("doc_id", "label").agg(F.max("raw").alias("raw")))  # one text an id, however many rows share it

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [pdf for pdf in batches if len(pdf)]
        if not parts:
            p = {"constant": 0.5}
        else:
            pdf = pd.concat(parts).sort_values(["doc_id", "raw"])
            y = pdf["label"].to_numpy(np.float32)
            p = train(pdf["raw"].tolist(), y) if 0 < y.mean() < 1 else {"constant": float(y.mean())}
        yield pd.DataFrame({"model": [pickle.dumps(p)]})

    # One task, of at most max_docs * MAX_TRAIN_BYTES.
    got = rows.repartition(1).mapInPandas(run, "model binary").first()
    return pickle.loads(bytes(got["model"])) if got else {"constant": 0.5}


def score_column(spark, model: dict, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for raws in batches:
            yield pd.Series(probabilities(shared.value, raws.tolist()))
    return score(text_of(text).cast("binary"))
