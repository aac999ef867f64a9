"""The flagship evaluation: tensor scan -> exact seeded split -> batch
scoring of the test rows -> confusion matrix -> per-class metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.evaluation import class_metrics, confusion_matrix
from tessera.operators.labels import label_vocab
from tessera.operators.sampling import split_side
from tessera.operators.scoring import score_batch
from tessera.plans import formula
from tessera.plans.models import small_dense_net
from tessera.sources.tensors import embeddings


def evaluate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    ex = embeddings(spark, sf_dir)
    test = split_side(ex, "id", "test", positions=False)  # placed by bucket, no full ranking
    spec = small_dense_net(formula.SIDE * formula.SIDE, formula.N_CLASSES)
    w, b = formula.dense_weights()
    pred = score_batch(test.select("id", F.col("label_idx").alias("actual"), "features"),
                       spec, {"output.W": w, "output.b": b}, keep=["id", "actual"])
    vocab = label_vocab(ex, "label", with_counts=False)
    metrics = class_metrics(confusion_matrix(pred), vocab)
    return metrics.join(vocab, "label_idx", "left").orderBy("label_idx")
