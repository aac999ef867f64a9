"""Plan-shape checks: the scale properties the design relies on (static
plans, AQE off, so the operators are visible)."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from tessera.operators.sampling import split_exact, split_side
from tessera.plans import queries as Q
from tessera.plans import training as T


@pytest.fixture
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_is_narrow_and_pruned(static):
    p = plan(Q.score_batch(static, SF_MID))
    assert "Exchange" not in p and "MapInPandas" in p
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>,label:int>" in \
        Q.score_batch(static, SF_MID)._jdf.queryExecution().explainString(
            static._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_exact_split_broadcasts_only_the_offsets(static):
    p = plan(split_exact(Q._emb_ids(static, SF_MID), "vec_id"))
    assert "BroadcastExchange" in p and "BroadcastHashJoin" in p
    assert "SortMergeJoin" not in p


def test_test_side_reads_the_tensors_once_and_moves_only_ids(static):
    df = split_side(Q._emb(static, SF_MID), "id", "test", 0.8, positions=False)
    p = plan(df)
    assert "Union" not in p
    tensor_scans = [x for x in p.splitlines() if "FileScan" in x and "embedding#" in x]
    assert len(tensor_scans) == 1
    assert not [x for x in p.splitlines() if "Exchange hashpartitioning" in x and "features" in x]


def test_round_reads_buckets_without_exchange(static):
    ex = Q._emb(static, SF_MID)
    rows = T.prepare_training_rows(split_side(ex, "id", "train", 0.8, range_partitions=True), 30, 4, 5)
    g = rows.agg(F.max("rounds_per_group")).first()[0]
    fit = T.rows_of_round(rows, 0, g).groupBy("wkey").applyInPandas(
        lambda k, pdf: pd.DataFrame({"n": [len(pdf)]}), "n long")
    p = plan(fit)
    assert "FlatMapGroupsInPandas" in p and "Exchange" not in p
    assert "PartitionFilters: [isnotnull(round_group" in p and "EqualTo(round,0)" in p
