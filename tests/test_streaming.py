"""Streaming scoring equals batch scoring on the same rows."""

from pyspark.sql import functions as F

from conftest import SF_MID
from tessera.operators.evaluation import confusion_matrix
from tessera.operators.sampling import split_hash
from tessera.operators.scoring import score_batch
from tessera.plans import formula
from tessera.plans.models import small_dense_net
from tessera.streaming.scoring import read_tensor_stream, start_confusion, start_scoring


def _net():
    w, b = formula.dense_weights()
    return small_dense_net(64, 10), {"output.W": w, "output.b": b}


def test_stream_matches_batch(spark, tmp_path):
    src = str(tmp_path / "in")
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("label").alias("label_idx"), F.col("embedding").alias("features"))
    e.repartition(4).write.parquet(src)  # four files arrive
    spec, params = _net()

    q1 = start_scoring(read_tensor_stream(spark, src, max_files_per_trigger=1), spec, params,
                       str(tmp_path / "out"), str(tmp_path / "ck1"))
    q2 = start_confusion(read_tensor_stream(spark, src), spec, params, "cm_stream", str(tmp_path / "ck2"))
    for q in (q1, q2):
        q.processAllAvailable()
        q.stop()

    test = split_hash(e, "id").filter("split = 'test'").drop("split")
    batch = score_batch(test.select("id", F.col("label_idx").alias("actual"), "features"), spec, params,
                        keep=["id", "actual"])
    got = sorted((r.id, r.predicted) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == sorted((r.id, r.predicted) for r in batch.collect())
    cm_stream = sorted(tuple(r) for r in spark.sql("SELECT actual, predicted, n FROM cm_stream").collect())
    assert cm_stream == sorted(tuple(r) for r in confusion_matrix(batch).collect())


def test_stream_restart_from_checkpoint_adds_only_new_files(spark, tmp_path):
    src = str(tmp_path / "in")
    e = spark.read.parquet(f"{SF_MID}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("label").alias("label_idx"), F.col("embedding").alias("features"))
    first, second = e.filter("vec_id % 2 = 0"), e.filter("vec_id % 2 = 1")
    first.write.parquet(src + "/a")
    spec, params = _net()
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(2):  # the second start finds nothing new
        q = start_scoring(read_tensor_stream(spark, src + "/*"), spec, params, out, ck, test_only=False)
        q.processAllAvailable()
        q.stop()
    assert spark.read.parquet(out).count() == first.count()
    second.write.parquet(src + "/b")
    q = start_scoring(read_tensor_stream(spark, src + "/*"), spec, params, out, ck, test_only=False)
    q.processAllAvailable()
    q.stop()
    got = spark.read.parquet(out)
    assert got.count() == e.count() and got.select("id").distinct().count() == e.count()
