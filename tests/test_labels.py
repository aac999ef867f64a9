"""The label join: broadcast and salted paths agree; a hot label is spread."""

from pyspark.sql import functions as F

from tessera.operators.labels import LABEL_SALTS, index_labels


def frames(spark, n=3000):
    rows = [(i, "hot" if i % 3 == 0 else None if i % 50 == 1 else "unknown" if i % 50 == 2 else f"l{i % 7}", [float(i)] * 4) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, label string, features array<double>").repartition(4)
    return df, spark.createDataFrame([(i, f"l{i}") for i in range(7)] + [(7, "hot")], "label_idx int, label string")


def test_both_paths_agree(spark):
    df, vocab = frames(spark)
    want = sorted((r.id, None if r.label in (None, "unknown") else 7 if r.label == "hot" else int(r.label[1:])) for r in df.collect())
    for limit in (100, 0):
        out = index_labels(df, vocab, broadcast_labels=limit)
        assert out.columns == [*df.columns, "label_idx"]
        assert sorted((r.id, r.label_idx) for r in out.collect()) == want


def test_a_small_vocabulary_leaves_the_examples_in_place(spark):
    df, vocab = frames(spark)
    plan = index_labels(spark.read.parquet(_written(spark, df)), vocab)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_a_hot_label_is_dealt_over_the_salts(spark):
    df, vocab = frames(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = index_labels(df, vocab, salt_col="id", broadcast_labels=0)
        sizes = {r["p"]: r["n"] for r in out.filter("label = 'hot'").groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 4 and max(sizes.values()) < 0.5 * sum(sizes.values()) and LABEL_SALTS > len(sizes)


def _written(spark, df):
    from tessera.session import scratch_path
    path = scratch_path(spark, "labels-test")
    df.write.parquet(path)
    return path
