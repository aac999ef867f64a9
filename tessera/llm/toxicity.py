"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Learning (``fit``), from labelled rows only:

- a bounded sample of them (``max_examples``, the smallest md5 keys of the id);
- the vocabulary: every word of at least two examples (at most ``max_terms``, those that say
  most about the label). A word's weight is its IDF times how sure its evidence on the label
  is, ``(chi2 - SIGNIFICANT)+ / (chi2 + PRIOR)`` squared, which falls smoothly to nothing; a rare
  word (IDF over ``RARE``) also weighs ``FLOOR`` of the excess, whatever its evidence, so a text
  without telling words is still compared by its other words. Common words that say nothing
  weigh nothing and have no postings. For the chi-square near copies of one label count once (``near_copies``: about four fifths of their three-word
  runs in common with the group's first document); all other documents count one by one;
- IDF of those words over *all* documents, one partial count per task;
- an inverted index of the examples' unit vectors, its postings in blocks of ``BLOCK``
  examples, each block with the largest weight it holds;
- a monotone calibration of the votes, from each example's vote when it is left out.

Scoring: for a text's words, block bounds (text weight times block maximum, summed over its
words) are taken from the largest down: the ``FIRST`` best blocks are scored, then all others
whose bound reaches the k-th best cosine found, so the k nearest are exact. They vote by
closeness. Only a text without any vocabulary word, whose cosine to everything is zero,
gets the (smoothed) toxic share of the examples that have none either.

At scale: fitting reads the sample's texts and, for the IDF, every text once; the
model is bounded by its parameters and broadcast. Scoring is a narrow map over the
texts, so no document is shuffled. A word's length is not limited, texts are read
whole.

Defined cases: NULL text counts as empty; labels that are NULL or repeated with a
conflict are left out; rows that share a labelled doc_id are one example, each word with
its largest count; without usable labels every score is 0, and with labels of one kind only
every score is the share of the examples without words; a tie at the k-th place goes to the
lower example number (examples are sorted by md5 key).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_of, written
from tessera.operators.sampling import seeded_key
from tessera.session import collect_arrow, create_arrow

MAX_EXAMPLES = 4_096
MAX_TERMS = 1 << 17
SIGNIFICANT, PRIOR = 3.84, 10.0  # chance alone passes the first for one word in twenty
RARE, FLOOR = 3.0, 1e-3         # rare: in less than one document in twenty
K = 15
BLOCK = 64
FIRST = 4  # blocks scored before any other is ruled out
FEW_POSTINGS = 1 << 15  # a text with no more postings than that is scored without block bounds
# Near copies: SHINGLE words a run, SIGN smallest hashes a text, SAME of them equal, looked up by BAND at a time.
SHINGLE, SIGN, SAME, BAND = 3, 32, 25, 4
_ODD = np.random.default_rng(42).integers(1, 1 << 63, SIGN + SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD = re.compile(r"\w+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def signature(tokens: list[str]) -> list[int]:
    """Min-hashes of the runs of ``SHINGLE`` words (of the whole text if it is shorter)."""
    w = np.array([zlib.crc32(t.encode()) + 1 for t in tokens] + [0] * (SHINGLE - len(tokens)), np.uint64)
    h = np.zeros(len(w) - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        h += w[i:len(h) + i] * _ODD[SIGN + i]
    h ^= h >> np.uint64(29)
    out = []
    for odd in _ODD[:SIGN]:
        x = h * odd
        x ^= x >> np.uint64(32)
        out.append(int((x * odd).min() >> np.uint64(1)))
    return out


def near_copies(signs: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Group of each row: the first earlier row of the same label that leads a group
    and shares ``SAME`` of ``SIGN`` min-hashes with it, else the row itself. Members are
    near their leader, so texts that share only a passage don't chain into one group."""
    group, leads = np.arange(len(signs)), {}
    for i, (sign, label) in enumerate(zip(signs, labels.tolist())):
        keys = [(label, b, sign[b:b + BAND].tobytes()) for b in range(0, SIGN, BAND)]
        at = np.unique([j for k in keys for j in leads.get(k, ())]).astype(np.int64)
        near = at[(signs[at] == sign).sum(axis=1) >= SAME]
        if len(near):
            group[i] = near[0]
        else:
            for k in keys:
                leads.setdefault(k, []).append(i)
    return group


@dataclass
class Model:
    """Everything scoring needs: at most ``max_terms`` words and the examples' postings of them."""

    terms: dict[str, int]
    weight: np.ndarray         # per term: IDF times evidence
    example_ids: np.ndarray
    labels: np.ndarray
    examples: np.ndarray       # postings, by term: example, weight in its unit vector
    values_: np.ndarray
    block_of: np.ndarray       # a term's blocks: number, first posting, largest weight; and each term's first block
    block_at: np.ndarray
    block_max: np.ndarray
    first_block: np.ndarray
    empty_share: float
    k: int = K
    bins: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    values: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Unit TF-IDF vector: term numbers and weights."""
        tf = Counter(t for t in map(self.terms.get, words(text)) if t is not None)
        if not tf:
            return np.zeros(0, np.int64), np.zeros(0)
        t = np.array(sorted(tf), np.int64)
        w = (1 + np.log([tf[i] for i in t.tolist()])) * self.weight[t]
        norm = np.sqrt((w * w).sum())
        return (t, w / norm) if norm > 0 else (t[:0], w[:0])

    def nearest(self, t: np.ndarray, w: np.ndarray, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine (above zero) and the cosines."""
        first, end = self.first_block[t], self.first_block[t + 1]
        if (self.block_at[end] - self.block_at[first]).sum() <= FEW_POSTINGS:  # cheaper read than ruled out
            p, w_p = _spans(self.block_at[first], self.block_at[end], w)
            scores = np.bincount(self.examples[p], w_p * self.values_[p], minlength=len(self.labels))
            if leave_out >= 0:
                scores[leave_out] = 0
            return self._best(scores)
        at, w_at = _spans(first, end, w)
        block = self.block_of[at]
        n_blocks = -(-len(self.labels) // BLOCK)
        bound = np.bincount(block, w_at * self.block_max[at], minlength=n_blocks)

        def scored(chosen: np.ndarray) -> np.ndarray:
            """Exact cosines of the examples in the chosen blocks (zero elsewhere)."""
            on = chosen[block]
            p, w_p = _spans(self.block_at[at[on]], self.block_at[at[on] + 1], w_at[on])
            return np.bincount(self.examples[p], w_p * self.values_[p], minlength=len(self.labels))

        best = np.zeros(n_blocks, bool)
        best[np.argsort(-bound, kind="stable")[:FIRST]] = True
        scores = scored(best)
        if leave_out >= 0:
            scores[leave_out] = 0
        kth = np.partition(scores, -self.k)[-self.k] if len(scores) > self.k else 0.0
        # A block that could only tie with the k-th best still counts.
        more = ~best & (bound > 0) & (bound >= kth - 1e-9)
        if more.any():
            scores += scored(more)
            if leave_out >= 0:
                scores[leave_out] = 0
        return self._best(scores)

    def _best(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kth = np.partition(scores, -self.k)[-self.k] if len(scores) > self.k else 0.0
        i = np.flatnonzero((scores > 0) & (scores >= kth - 1e-9))
        top = i[np.lexsort((i, -np.round(scores[i], 12)))[: self.k]]
        return top, scores[top]

    def vote(self, t: np.ndarray, w: np.ndarray, leave_out: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        """Closeness-weighted share of toxic neighbours; NaN without any."""
        i, c = self.nearest(t, w, leave_out)
        if not len(i):
            return float("nan"), i, c
        near = 1 / (1.05 - np.minimum(c, 1.0))  # weight grows as the distance shrinks
        return float((near * self.labels[i]).sum() / near.sum()), i, c

    def calibrated(self, vote: float) -> float:
        if np.isnan(vote):
            return self.empty_share
        # A sliver of the vote itself keeps the order of votes inside a step.
        return float(np.clip(0.99 * np.interp(vote, self.bins, self.values) + 0.01 * vote, 0, 1))

    def score(self, text: str) -> float:
        return self.calibrated(self.vote(*self.vector(text))[0])

    def evidence(self, text: str) -> list[tuple[int, int, float]]:
        """(example id, label, cosine) of the neighbours that voted."""
        _, i, c = self.vote(*self.vector(text))
        return [(int(self.example_ids[a]), int(self.labels[a]), float(b)) for a, b in zip(i, c)]


def _monotone(vote: np.ndarray, label: np.ndarray, parts: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators over groups of equal size: vote -> toxic share."""
    order = np.argsort(vote, kind="stable")
    pools: list[list[float]] = []
    for g in np.array_split(order, parts):
        if not len(g):
            continue
        pools.append([vote[g].mean(), label[g].mean(), len(g)])
        while len(pools) > 1 and (pools[-2][1] >= pools[-1][1] or pools[-2][0] >= pools[-1][0]):
            b, a = pools.pop(), pools.pop()
            n = a[2] + b[2]
            pools.append([(a[0] * a[2] + b[0] * b[2]) / n, (a[1] * a[2] + b[1] * b[2]) / n, n])
    # The ends of the scale stand for themselves with the weight of one example.
    x = np.array([0.0, *[p[0] for p in pools], 1.0])
    y = np.array([min(0.0, pools[0][1]), *[p[1] for p in pools], 1.0])
    keep = np.append(np.diff(x) > 0, True)
    return x[keep], y[keep]


def _spans(first: np.ndarray, end: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of the ranges first..end, each with its range's weight."""
    size = end - first
    upto = np.cumsum(size)
    n = int(upto[-1]) if len(upto) else 0
    return np.arange(n) + np.repeat(first - upto + size, size), np.repeat(w, size)


def _build(examples: list[tuple[int, int, list[tuple[str, int]]]], terms: list[str], weight: np.ndarray, k: int) -> Model:
    """Index and calibration from (id, label, [(term, tf)]) rows."""
    number = {t: i for i, t in enumerate(terms)}
    cells = [(r, number[t], n) for r, (_, _, tf) in enumerate(examples) for t, n in tf if t in number]
    rows, cols, tf = np.array(cells, np.int64).reshape(-1, 3).T
    return _index([e[0] for e in examples], [e[1] for e in examples], rows, cols, tf, terms, weight, k)


def _index(ids: list[int], labels: list[int], rows: np.ndarray, cols: np.ndarray, tf: np.ndarray, terms: list[str],
           weight: np.ndarray, k: int) -> Model:
    """Index and calibration from the examples' (row, term, count) cells."""
    order = np.lexsort((cols, rows))
    rows, cols, vals = rows[order], cols[order], (1 + np.log(tf[order])) * weight[cols[order]]
    norm = np.sqrt(np.bincount(rows, vals * vals, minlength=len(ids)))
    known = norm > 0  # examples without words are no neighbours
    keep = known[rows]
    rows, cols, vals = (np.cumsum(known) - 1)[rows[keep]], cols[keep], (vals[keep] / norm[rows[keep]])
    ids, labels = np.array(ids, np.int64), np.array(labels, np.float64)
    share = (labels[~known].sum() + 0.1) / ((~known).sum() + 1) if len(ids) else 0.0
    by_term = np.argsort(cols, kind="stable")
    ex, ew, of = rows[by_term], vals[by_term], cols[by_term]
    new = np.flatnonzero(np.diff(of.astype(np.int64) * (len(ids) // BLOCK + 1) + ex // BLOCK, prepend=-1))  # a term's next block begins
    m = Model({t: i for i, t in enumerate(terms)}, np.asarray(weight, np.float64), ids[known], labels[known],
              ex.astype(np.int32), ew, (ex[new] // BLOCK).astype(np.int32), np.append(new, len(ex)).astype(np.int64),
              np.maximum.reduceat(ew, new) if len(new) else np.zeros(0), np.searchsorted(of[new], np.arange(len(terms) + 1)), share, k)
    start = np.searchsorted(rows, np.arange(len(m.labels) + 1))
    votes = np.array([m.vote(cols[a:z], vals[a:z], leave_out=r)[0] for r, (a, z) in enumerate(zip(start[:-1], start[1:]))])
    voted = ~np.isnan(votes)
    if voted.any():
        m.bins, m.values = _monotone(votes[voted], m.labels[voted])
    return m


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_examples: int = MAX_EXAMPLES, max_terms: int = MAX_TERMS, k: int = K) -> Model:
    """``labelled``: (doc_id, label) rows to learn from, label 0 or 1."""
    clean = (labelled.select(F.col("doc_id").cast("long"), F.col("label").cast("int"))
             .filter("doc_id IS NOT NULL AND label IN (0, 1)")
             .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_hi")).filter("label = _hi"))
    chosen = clean.orderBy(seeded_key("doc_id"), "doc_id").limit(max_examples).select("doc_id", "label")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs[text_col]).alias("text"))
    rows = own.join(F.broadcast(chosen), "doc_id")  # at most max_examples ids

    def tokenise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), 64):
                part = pdf.iloc[a:a + 64]
                out = []
                for i, y, t in zip(part["doc_id"], part["label"], part["text"]):
                    own_words = words(t)
                    out.append((int(i), int(y), None, 0, signature(own_words)))
                    out += [(int(i), int(y), w, n, None) for w, n in Counter(own_words).items()]
                yield pd.DataFrame(out, columns=["doc_id", "label", "word", "n", "sign"])

    counts = written(rows.mapInPandas(tokenise, "doc_id long, label int, word string, n int, sign array<long>"), "example-words")
    # One signature an id, however many rows share it: at most max_examples rows.
    signed = (counts.filter("word IS NULL").groupBy("doc_id", "label")
              .agg(F.array(*[F.min(F.col("sign")[i]) for i in range(SIGN)]).alias("sign"))
              .orderBy(seeded_key("doc_id"), "doc_id").collect())
    labels = np.array([r["label"] for r in signed], np.int64)
    group = near_copies(np.array([r["sign"] for r in signed], np.int64).reshape(-1, SIGN), labels)
    total, toxic = len(np.unique(group)), len(np.unique(group[labels == 1]))
    grouped = docs.sparkSession.createDataFrame([(r["doc_id"], g) for r, g in zip(signed, group.tolist())], "doc_id long, grp long")
    by_word = (counts.filter("word IS NOT NULL").join(F.broadcast(grouped), "doc_id").select("word", "grp", "label").distinct()
               .groupBy("word").agg(F.count(F.lit(1)).alias("d"), F.sum("label").alias("p")))
    share = toxic / total if total else 0.0
    expect = F.col("d") * F.lit(share)
    spread = F.col("d") * F.lit(share * (1 - share)) * (1 - F.col("d") / F.lit(float(total + 1)))
    chi2 = (F.col("p") - expect) * (F.col("p") - expect) / spread
    terms, sure = [], np.zeros(0)
    if 0 < share < 1:
        chosen_words = (by_word.filter("d > 1").select("word", chi2.alias("chi2")).orderBy(F.desc("chi2"), "word")
                        .limit(max_terms).collect())
        terms = [r["word"] for r in chosen_words]
        found = np.array([r["chi2"] for r in chosen_words])
        sure = (np.maximum(0, found - SIGNIFICANT) / (found + PRIOR)) ** 2
    idf = _corpus_idf(own, terms)
    weight = idf * sure + FLOOR * np.maximum(0, idf - RARE)
    terms, weight = [t for t, w in zip(terms, weight) if w > 0], weight[weight > 0]
    spark = docs.sparkSession
    numbered = create_arrow(spark, pd.DataFrame({"word": pd.Series(terms, dtype=object), "term": np.arange(len(terms))}), "word string, term int")
    placed = create_arrow(spark, pd.DataFrame({"doc_id": np.array([r["doc_id"] for r in signed], np.int64),
                                               "row": np.arange(len(signed))}), "doc_id long, row int")
    # Rows that share an id are one example: at most max_terms words, however many rows.
    cells = collect_arrow(counts.filter("word IS NOT NULL").join(F.broadcast(numbered), "word").join(F.broadcast(placed), "doc_id")
                          .groupBy("row", "term").agg(F.max("n").cast("int").alias("n")))
    return _index([r["doc_id"] for r in signed], labels.tolist(), *(cells[c].to_numpy() for c in ("row", "term", "n")), terms, weight, k)


def _corpus_idf(docs: DataFrame, terms: list[str]) -> np.ndarray:
    """Smoothed IDF of ``terms`` over all documents: one vector of counts per task."""
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(terms)})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value
        seen, n = np.zeros(len(number) + 1, np.int64), 0
        for pdf in batches:
            for text in pdf["text"]:
                at = [n_ for n_ in map(number.get, set(words(text))) if n_ is not None]
                seen[at] += 1
            n += len(pdf)
        seen[-1] = n
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"term": at, "n": seen[at]})  # one vector a task

    per = docs.select("text").mapInPandas(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    seen = np.zeros(len(terms) + 1)
    for r in per.collect():  # at most max_terms + 1 rows
        seen[r["term"]] = r["n"]
    return np.log((1 + seen[-1]) / (1 + seen[:-1]))


def score_column(spark, model: Model, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        for texts in batches:
            yield pd.Series([m.score(t) for t in texts], dtype="float64")
    return score(text_of(text))


EVIDENCE = "score double, neighbours array<bigint>, labels array<int>, cosines array<double>"


def evidence_column(spark, model: Model, text: Column) -> Column:
    """struct of ``EVIDENCE``: the score and the neighbours behind it, nearest first."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(EVIDENCE)
    def evidence(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            found = [m.vote(*m.vector(t)) for t in texts]
            yield pd.DataFrame({"score": [m.calibrated(v) for v, _, _ in found],
                                "neighbours": [m.example_ids[i] for _, i, _ in found],
                                "labels": [m.labels[i].astype(np.int32) for _, i, _ in found],
                                "cosines": [c for _, _, c in found]})
    return evidence(text_of(text))
