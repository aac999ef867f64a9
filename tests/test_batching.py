import pytest
from pyspark.sql import functions as F

from tessera.operators.batching import batch_assign, epoch_repeat


@pytest.mark.parametrize("n", [0, 1, 17, 18, 19, 100])
def test_batches_full_but_last(spark, n):
    df = spark.range(1, n + 1).withColumnRenamed("id", "rn")
    b = batch_assign(df, "rn", 18, workers=2, averaging_frequency=5)
    sizes = [r["n"] for r in b.groupBy("batch_id").agg(F.count("*").alias("n")).orderBy("batch_id").collect()]
    assert sum(sizes) == n
    assert all(s == 18 for s in sizes[:-1])
    if n:
        assert sizes[-1] == n - 18 * (len(sizes) - 1)
    per_round = b.groupBy("round", "worker").agg(F.countDistinct("batch_id").alias("k")).collect()
    assert all(r["k"] <= 5 for r in per_round)


def test_epoch_repeat(spark):
    df = spark.range(1, 11).withColumnRenamed("id", "rn")
    b = batch_assign(df, "rn", 4).withColumn("nb", F.lit(3))
    e = epoch_repeat(b, 3, "nb")
    assert e.count() == 30
    steps = sorted({r.step for r in e.collect()})
    assert steps == list(range(9))


def test_bad_parameters(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        batch_assign(df, "id", 0)
    with pytest.raises(ValueError):
        epoch_repeat(df, 0)


def test_rounds_stay_near_the_target_however_many_rows():
    from tessera.operators.batching import MAX_WORKERS, MIN_WORKERS, TARGET_ROUNDS, worker_count
    assert worker_count(0, 18, 5) == worker_count(400, 18, 5) == MIN_WORKERS
    for n in (10 ** 5, 10 ** 6, 10 ** 7):
        w = worker_count(n, 18, 5)
        rounds = -(-(-(-n // 18)) // (w * 5))
        assert TARGET_ROUNDS - 1 <= rounds <= TARGET_ROUNDS
    assert worker_count(10 ** 12, 30, 5) == MAX_WORKERS
