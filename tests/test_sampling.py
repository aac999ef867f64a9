import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_MID
from tessera.operators.labels import label_vocab
from tessera.operators.sampling import (hash_row_number, range_row_number, sample_cap, seeded_key,
                                        seeded_shuffle, split_exact, split_hash, split_side)


def _emb(spark):
    return spark.read.parquet(f"{SF_MID}/embeddings.parquet").select("vec_id", "label")


def _collect(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_exact_split_independent_of_partitioning(spark, parts):
    base = _collect(split_exact(_emb(spark), "vec_id"), ["vec_id", "rn", "split", "split_rn"])
    other = _collect(split_exact(_emb(spark).repartition(parts), "vec_id"),
                     ["vec_id", "rn", "split", "split_rn"])
    assert base == other


def test_exact_split_quota_disjoint_complete(spark):
    rows = split_exact(_emb(spark), "vec_id").collect()
    n = len(rows)
    train = [r for r in rows if r.split == "train"]
    assert len(train) == round(0.8 * n)
    assert sorted(r.rn for r in rows) == list(range(1, n + 1))
    assert sorted(r.split_rn for r in train) == list(range(1, len(train) + 1))
    assert len({r.vec_id for r in rows}) == n


def test_row_numbers_equal_global_window(spark):
    keyed = _emb(spark).withColumn("k", seeded_key("vec_id"))
    expect = keyed.withColumn("rn", F.row_number().over(Window.orderBy("k", "vec_id")))
    got_hash = hash_row_number(keyed, "k", "vec_id", total_col=None)
    got_range = range_row_number(keyed, ["k", "vec_id"], num_partitions=5)
    e = _collect(expect, ["vec_id", "rn"])
    assert _collect(got_hash, ["vec_id", "rn"]) == e
    assert _collect(got_range, ["vec_id", "rn"]) == e


def test_cap_and_shuffle(spark):
    df = _emb(spark)
    n = df.count()
    cap = sample_cap(df, "vec_id", 50)
    first50 = seeded_shuffle(df, "vec_id").filter("rn <= 50")
    assert _collect(cap, ["vec_id"]) == _collect(first50, ["vec_id"])
    assert sample_cap(df, "vec_id", n + 100).count() == n


def test_cap_prunes_buckets_before_shuffle(spark):
    df = _emb(spark)
    plan = sample_cap(df, "vec_id", 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan
    rows = hash_row_number(df.withColumn("k", seeded_key("vec_id")), "k", "vec_id", max_rn=7,
                           total_col="n").collect()
    assert sorted(r.rn for r in rows) == list(range(1, 8))
    assert all(r.n == df.count() for r in rows)


def test_split_hash_share(spark):
    rows = split_hash(_emb(spark), "vec_id", 0.8).collect()
    share = sum(r.split == "train" for r in rows) / len(rows)
    assert 0.7 < share < 0.9
    assert all(r.split == "train" for r in split_hash(_emb(spark), "vec_id", 1.0).collect())


def test_empty_input(spark):
    empty = _emb(spark).filter("false")
    assert split_exact(empty, "vec_id").count() == 0
    assert sample_cap(empty, "vec_id", 10).count() == 0


def test_label_vocab_alphabetical(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "label string")
    v = [tuple(r) for r in label_vocab(df).orderBy("label_idx").collect()]
    assert v == [(0, "a", 2), (1, "b", 1), (2, "c", 1)]


@pytest.mark.parametrize("share", [0.8, 0.5, 0.0, 1.0])
def test_split_sides_equal_exact_split(spark, share):
    df = _emb(spark)
    full = split_exact(df, "vec_id", share)
    train = split_side(df, "vec_id", "train", share, positions=True, range_partitions=5)
    assert _collect(train, ["vec_id", "rn", "split_rn", "n_split"]) == \
        _collect(full.filter("split = 'train'"), ["vec_id", "rn", "split_rn", "n_split"])
    test_pos = split_side(df, "vec_id", "test", share, positions=True)
    assert _collect(test_pos, ["vec_id", "rn", "split_rn"]) == \
        _collect(full.filter("split = 'test'"), ["vec_id", "rn", "split_rn"])
    test = split_side(df, "vec_id", "test", share, positions=False)
    assert _collect(test, ["vec_id", "n_split"]) == _collect(full.filter("split = 'test'"), ["vec_id", "n_split"])


@pytest.mark.parametrize("action", [lambda d: d.collect(), lambda d: d.write.format("noop").mode("overwrite").save(),
                                    lambda d: d.agg({"rn": "sum"}).collect()])
def test_repeated_ids_fail_at_any_size(spark, action):
    ids = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    with pytest.raises(Exception, match="repeats"):
        action(seeded_shuffle(ids, "id"))



def test_edges_empty_and_zero(spark):
    empty = spark.createDataFrame([], "vec_id long, label string")
    assert label_vocab(empty).count() == 0
    assert sample_cap(_emb(spark), "vec_id", 0).count() == 0
    assert seeded_shuffle(empty, "vec_id").count() == 0


def test_read_tensors_and_index_labels(spark, tmp_path):
    from tessera.operators.labels import index_labels
    from tessera.sources.tensors import read_tensors
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "cat", [0.5, 1.0]), (2, "dog", [2.0, 3.0]), (3, "owl", [1.0, 1.0])],
                          "vec_id long, cls string, emb array<float>").write.parquet(path)
    t = read_tensors(spark, path, id_col="vec_id", feature_col="emb", label_col="cls")
    assert t.columns == ["id", "label", "features"]
    vocab = label_vocab(t.filter("label != 'owl'"), "label", with_counts=False)
    got = {r.id: r.label_idx for r in index_labels(t, vocab).collect()}
    assert got == {1: 0, 2: 1, 3: None}  # a label outside the vocabulary gets no index
