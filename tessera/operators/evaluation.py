"""Distributed evaluation: confusion counts, per-class and summary metrics,
and the mean negative log-likelihood.

Semantics (fixed here): precision = tp/(tp+fp), recall = tp/(tp+fn),
F1 = 2pr/(p+r); a zero denominator gives NULL; macro averages skip NULLs;
accuracy = sum(tp)/n. Every class of the vocabulary gets a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.arrays import nll


def confusion_matrix(pred: DataFrame, actual_col: str = "actual", predicted_col: str = "predicted",
                     probs_col: str | None = None) -> DataFrame:
    """``actual INT, predicted INT, n BIGINT`` -- partial + final hash aggregate.

    With ``probs_col`` also ``nll_sum`` (sum of -ln p[true class]) from the
    same pass, so the mean score needs no second scoring of the data."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if probs_col:
        aggs.append(F.sum(nll(probs_col, actual_col)).alias("nll_sum"))
    return (pred.groupBy(F.col(actual_col).cast("int").alias("actual"),
                         F.col(predicted_col).cast("int").alias("predicted"))
            .agg(*aggs))


def _safe_div(a, b):
    return F.when(b != 0, a / b)


def class_metrics(confusion: DataFrame, classes: DataFrame) -> DataFrame:
    """Per class: ``label_idx, tp, fp, fn, support, precision, recall, f1``.

    ``classes`` has a ``label_idx`` column (the vocabulary). The confusion
    table has at most classes^2 rows, so this is cheap at any data size."""
    hit = F.col("actual") == F.col("predicted")
    n = F.col("n").cast("long")
    zero = F.lit(0).cast("long")
    # Each confusion row counts for its actual class (tp or fn) and for its
    # predicted class (fp): one generator, so the confusion input is read once.
    roles = F.array(
        F.struct(F.col("actual").alias("label_idx"), F.when(hit, n).otherwise(zero).alias("tp"),
                 zero.alias("fp"), F.when(hit, zero).otherwise(n).alias("fn")),
        F.struct(F.col("predicted").alias("label_idx"), zero.alias("tp"),
                 F.when(hit, zero).otherwise(n).alias("fp"), zero.alias("fn")))
    per = (confusion.select(F.explode(roles).alias("r")).select("r.*").groupBy("label_idx")
           .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")))
    cls = classes.select(F.col("label_idx").cast("int").alias("label_idx")).distinct()
    m = (cls.join(per, "label_idx", "left")
         .select("label_idx",
                 *[F.coalesce(F.col(x), F.lit(0)).cast("long").alias(x) for x in ("tp", "fp", "fn")]))
    p = _safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    r = _safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    return (m.withColumn("support", F.col("tp") + F.col("fn"))
            .withColumn("precision", p.cast("double"))
            .withColumn("recall", r.cast("double"))
            .withColumn("f1", _safe_div(2 * F.col("precision") * F.col("recall"),
                                        F.col("precision") + F.col("recall")).cast("double")))


def eval_summary(metrics: DataFrame) -> DataFrame:
    """One row: ``n_classes, n, accuracy, macro_precision, macro_recall, macro_f1``."""
    return metrics.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.sum("support").alias("n"),
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def nll_score(pred: DataFrame, probs_col: str = "probs", label_col: str = "actual") -> DataFrame:
    """One row: ``n, score`` with score = mean of -ln(p[true class])."""
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.avg(nll(probs_col, label_col)).alias("score"))
