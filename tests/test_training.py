import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.averaging import param_average
from tessera.operators.evaluation import class_metrics, confusion_matrix, eval_summary
from tessera.operators.sampling import split_exact
from tessera.operators.scoring import score_batch
from tessera.plans.models import NetSpec, Output, Rules, small_dense_net
from tessera.plans.training import (ModelState, apply_update, full_batch_step, model_chunks_df,
                                    model_from_chunks, new_model, prepare_training_rows, run_round,
                                    train_fit)


def _separable(spark, n_per=200, dim=16, classes=3, seed=42):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 3, size=(classes, dim))
    rows = []
    for c in range(classes):
        for j in range(n_per):
            rows.append((c * n_per + j, c, (centres[c] + rng.normal(size=dim)).tolist()))
    return spark.createDataFrame(rows, "id long, label_idx int, features array<double>")


def test_average_of_identical_models_is_identity(spark):
    v = [1.5, -2.0, 3.25]
    df = spark.createDataFrame([("w", 0, v, 3), ("w", 0, v, 7)], "param string, chunk int, values array<double>, n long")
    for weight in (None, "n"):
        out = param_average(df, weight).collect()
        assert out[0]["values"] == pytest.approx(v)


def test_weighted_average(spark):
    df = spark.createDataFrame([("w", 0, [0.0, 2.0], 1), ("w", 0, [4.0, 6.0], 3)],
                               "param string, chunk int, values array<double>, n long")
    assert param_average(df, "n").first()["values"] == pytest.approx([3.0, 5.0])
    assert param_average(df).first()["values"] == pytest.approx([2.0, 4.0])


def test_round_with_equal_batches_equals_full_batch_step(spark):
    df = _separable(spark, n_per=40, dim=8)
    spec = NetSpec("sr", (8,), (Output("out", 3),), Rules(updater="sgd", lr=0.3, init="xavier"))
    start = new_model(spec)
    rows = split_exact(df, "id", 1.0).withColumnRenamed("split_rn", "srn")
    from tessera.operators.batching import batch_assign
    rows = batch_assign(rows, "srn", 30, workers=4, averaging_frequency=1)  # 120 rows: 4 equal batches
    averaged = run_round(spec, start, rows)
    full = full_batch_step(spec, start, df)
    for k in full.params:
        assert np.allclose(averaged.params[k], full.params[k], atol=1e-12)


def test_training_learns_separable_data(spark):
    df = _separable(spark)
    spec = small_dense_net(16, 3, hidden=8, lr=0.05)
    sp = split_exact(df, "id", 0.8)
    train = sp.filter("split = 'train'")
    test = sp.filter("split = 'test'")
    rows = prepare_training_rows(train, batch_size=20, workers=3, averaging_frequency=2)
    model, metrics_path = train_fit(spec, rows, epochs=3)
    metrics = spark.read.parquet(metrics_path)
    n_batches = rows.select("batch_id").distinct().count()
    assert metrics.count() == 3 * n_batches
    first = metrics.filter("epoch = 0").agg(F.avg("score")).first()[0]
    last = metrics.filter("epoch = 2").agg(F.avg("score")).first()[0]
    assert last < first
    pred = score_batch(test.select("id", F.col("label_idx").alias("actual"), "features"), spec,
                       model.params, keep=["id", "actual"])
    classes = spark.range(3).select(F.col("id").cast("int").alias("label_idx"))
    acc = eval_summary(class_metrics(confusion_matrix(pred), classes)).first()["accuracy"]
    assert acc > 0.6


def test_retry_reproduces_round(spark):
    df = _separable(spark, n_per=20, dim=4)
    spec = small_dense_net(4, 3, hidden=4)
    from tessera.operators.batching import batch_assign
    rows = batch_assign(split_exact(df, "id", 1.0), "split_rn", 10, 2, 2)
    a = run_round(spec, new_model(spec), rows)
    b = run_round(spec, new_model(spec), rows.repartition(7))
    for k in a.params:
        assert np.allclose(a.params[k], b.params[k])


def test_model_roundtrip(spark, tmp_path):
    spec = small_dense_net(16, 3, hidden=8, updater="nesterovs")
    m = new_model(spec)
    apply_update(spec, m, {k: np.ones_like(v) for k, v in m.params.items()})
    path = str(tmp_path / "model")
    model_chunks_df(spark, m).write.parquet(path)
    back = model_from_chunks(spec, [(r.param, r.chunk, r.values) for r in spark.read.parquet(path).collect()])
    assert back.step == 1
    for k in m.params:
        assert np.array_equal(back.params[k], m.params[k])
    for k in m.state:
        assert np.array_equal(back.state[k], m.state[k])


@pytest.mark.parametrize("updater", ["sgd", "rmsprop", "nesterovs"])
def test_updaters_descend(updater):
    spec = NetSpec("q", (2,), (Output("out", 2),), Rules(updater=updater, lr=0.01))
    m = ModelState({"out.W": np.array([[1.0, -1.0], [0.5, 2.0]]), "out.b": np.zeros(2)})
    before = (m.params["out.W"] ** 2).sum()
    for _ in range(5):
        apply_update(spec, m, {"out.W": m.params["out.W"].copy(), "out.b": np.zeros(2)})
    assert (m.params["out.W"] ** 2).sum() < before


def test_resume_from_checkpoint_equals_uninterrupted(spark, tmp_path):
    df = _separable(spark, n_per=30, dim=6)
    spec = small_dense_net(6, 3, hidden=5, updater="nesterovs")
    rows = prepare_training_rows(split_exact(df, "id", 0.8), batch_size=8, workers=2, averaging_frequency=2)
    full, _ = train_fit(spec, rows, epochs=2, model=new_model(spec))
    ck = str(tmp_path / "ck")
    m1, mp = train_fit(spec, rows, epochs=1, model=new_model(spec), checkpoint_path=ck, checkpoint_every=2)
    resumed, _ = train_fit(spec, rows, epochs=2, model=new_model(spec), checkpoint_path=ck, checkpoint_every=2,
                           resume=True, metrics_path=mp)
    assert resumed.step == full.step
    for k in full.params:
        assert np.allclose(resumed.params[k], full.params[k], atol=1e-12)


@pytest.mark.parametrize("fanin", [1, 5])
def test_binary_average_equals_vector_average(spark, fanin, monkeypatch):
    import tessera.operators.averaging as AV
    monkeypatch.setattr(AV, "FANIN", 2)
    rng = np.random.default_rng(5)
    rows = [(w, "p", c, rng.normal(size=7).tolist(), int(w + 1)) for w in range(5) for c in range(2)]
    arr = spark.createDataFrame(rows, "worker int, param string, chunk int, values array<double>, n long")
    binv = arr.withColumn("values", F.udf(lambda v: np.array(v).tobytes(), "binary")("values"))
    for weight in (None, "n"):
        a = {(r.param, r.chunk): np.array(r["values"]) for r in AV.param_average(arr, weight).collect()}
        b = {(r.param, r.chunk): np.frombuffer(r["values"]) for r in
             AV.param_average(binv, weight, fanin_col="worker", fanin_workers=fanin).collect()}
        for k in a:
            assert np.allclose(a[k], b[k], atol=1e-12)
    s = {(r.param, r.chunk): np.frombuffer(r["values"]) for r in AV.param_sum(binv, "n").collect()}
    assert np.allclose(s[("p", 0)], sum(np.array(r[3]) for r in rows if r[2] == 0))
    # float32-encoded rows (value_bytes = 4) average to the same values, within float32 precision
    b32 = arr.withColumn("values", F.udf(lambda v: np.array(v, dtype=np.float32).tobytes(), "binary")("values")) \
        .withColumn("value_bytes", F.lit(4))
    a = {(r.param, r.chunk): np.array(r["values"]) for r in AV.param_average(arr, "n").collect()}
    c = {(r.param, r.chunk): np.frombuffer(r["values"]) for r in
         AV.param_average(b32, "n", fanin_col="worker", fanin_workers=fanin).collect()}
    for k in a:
        assert np.allclose(a[k], c[k], atol=1e-6)


def test_every_nth_batch(spark):
    from tessera.plans.training import METRICS_SCHEMA, every_nth_batch
    m = spark.createDataFrame([("r", 0, 0, 0, b, 18, 1.0, b) for b in range(10)], METRICS_SCHEMA)
    assert [r.batch for r in every_nth_batch(m, 3).orderBy("batch").collect()] == [0, 3, 6, 9]


def test_pack_tensors_roundtrip(spark):
    from tessera.plans.models import batch_input, small_dense_net
    from tessera.sources.tensors import pack_tensors
    rows = [(1, [0.5, -1.25, 3.0]), (2, None), (3, [1e-3, 2.0, -7.5])]
    df = spark.createDataFrame(rows, "id long, features array<double>").repartition(1).sortWithinPartitions("id")
    packed = {r.id: r.features for r in pack_tensors(df).collect()}
    assert packed[2] is None
    x = batch_input(small_dense_net(3, 2), [packed[1], packed[3]])
    assert np.allclose(x, np.array([[0.5, -1.25, 3.0], [1e-3, 2.0, -7.5]], dtype=np.float32))


@pytest.mark.parametrize("workers", [4, 7])
def test_every_worker_gets_its_own_bucket(spark, workers):
    from tessera.plans.training import worker_keys
    keys = worker_keys(spark, workers)
    hashed = keys.select("worker", F.pmod(F.hash("wkey"), F.lit(workers)).alias("b")).collect()
    assert sorted(r.worker for r in hashed) == list(range(workers)) and all(r.worker == r.b for r in hashed)
    df = _separable(spark, n_per=40, dim=4)
    rows = prepare_training_rows(split_exact(df, "id", 1.0), batch_size=5, workers=workers, averaging_frequency=1)
    buckets = {f.split("_")[-1][:5] for f in rows.inputFiles()}
    assert buckets == {f"{b:05d}" for b in range(workers)}


def test_full_batch_step_independent_of_partitions_and_fanin(spark, monkeypatch):
    import tessera.operators.averaging as AV
    df = _separable(spark, n_per=30, dim=5)
    spec = NetSpec("sr", (5,), (Output("out", 3),), Rules(updater="sgd", lr=0.3, init="xavier"))
    start = new_model(spec)
    a = full_batch_step(spec, start, df.repartition(1))
    monkeypatch.setattr(AV, "FANIN", 2)
    b = full_batch_step(spec, start, df.repartition(9))
    for k in a.params:
        assert np.allclose(a.params[k], b.params[k], atol=1e-12)


def test_reduction_tree_with_several_levels(spark, monkeypatch):
    import tessera.operators.averaging as AV
    monkeypatch.setattr(AV, "FANIN", 2)  # 9 workers -> levels of 5, 3, 2 groups, then the final sum
    rng = np.random.default_rng(9)
    rows = [(w, "p", 0, rng.normal(size=4).tolist(), int(w % 3 + 1)) for w in range(9)]
    arr = spark.createDataFrame(rows, "worker int, param string, chunk int, values array<double>, n long")
    binv = arr.withColumn("values", F.udf(lambda v: np.array(v).tobytes(), "binary")("values"))
    a = np.array(AV.param_average(arr, "n").first()["values"])
    b = np.frombuffer(AV.param_average(binv, "n", fanin_col="worker", fanin_workers=9).first()["values"])
    assert np.allclose(a, b, atol=1e-12)


def test_save_and_load_trained(spark, tmp_path):
    from tessera.plans.models import preset
    from tessera.plans.training import load_trained, save_trained
    spec = preset("LeNet", channels=1, height=20, width=20, num_labels=3)
    m = new_model(spec)
    save_trained(spark, spec, m, str(tmp_path / "lenet"))
    spec2, m2 = load_trained(spark, str(tmp_path / "lenet"))
    assert spec2 == spec
    assert all(np.array_equal(m.params[k], m2.params[k]) and m2.params[k].dtype == np.float32 for k in m.params)


def test_whole_job_is_bit_identical_across_input_partitionings(spark):
    from tessera.plans.job import JobConfig, run_job
    df = _separable(spark, n_per=30, dim=6).withColumn("label", F.col("label_idx").cast("string"))
    spec = small_dense_net(6, 3, hidden=4, updater="nesterovs")
    cfg = JobConfig(epochs=2, batch_size=10, workers=3, averaging_frequency=2)
    a = run_job(spark, df.repartition(1), spec, cfg)
    b = run_job(spark, df.repartition(7), spec, cfg)
    for k in a.model.params:
        assert np.array_equal(a.model.params[k], b.model.params[k]), k
    assert a.model.step == b.model.step
    for r in (a, b):
        r.release(delete_files=True)


def test_train_fit_equals_a_sequential_brute_force(spark):
    """Distributed rounds against a plain loop: every round, every worker runs
    its batches in order from the round's model, then parameters and updater
    state are averaged over the workers that had batches; the step is the max."""
    from tessera.plans.training import ModelState, batch_arrays, train_batch
    df = _separable(spark, n_per=25, dim=5)
    spec = small_dense_net(5, 3, hidden=4, updater="rmsprop")
    rows = prepare_training_rows(split_exact(df, "id", 1.0), batch_size=7, workers=3, averaging_frequency=2)
    got, _ = train_fit(spec, rows, epochs=2, model=new_model(spec))

    pdf = rows.toPandas().sort_values(["round", "worker", "batch_id", "pos"])
    model = new_model(spec)
    for epoch in range(2):
        for r, rr in pdf.groupby("round", sort=True):
            outs = []
            for w, ww in rr.groupby("worker", sort=True):
                m = ModelState({k: v.copy() for k, v in model.params.items()},
                               {k: v.copy() for k, v in model.state.items()}, model.step)
                for b, bb in ww.groupby("batch_id", sort=True):
                    x, y = batch_arrays(spec, bb, "features", "label_idx")
                    train_batch(spec, m, x, y, np.random.default_rng([spec.seed, epoch, int(r), int(w), int(b)]))
                outs.append(m)
            model = ModelState({k: np.mean([o.params[k] for o in outs], axis=0) for k in model.params},
                               {k: np.mean([o.state[k] for o in outs], axis=0) for k in outs[0].state},
                               max(o.step for o in outs))
    assert got.step == model.step
    for k in model.params:
        assert np.allclose(got.params[k], model.params[k], atol=1e-12), k
    for k in model.state:
        assert np.allclose(got.state[k], model.state[k], atol=1e-12), k


def test_job_evaluation_equals_a_brute_force_confusion(spark):
    from collections import Counter

    from tessera.plans.job import JobConfig, run_job
    from tessera.plans.models import batch_input, forward
    df = _separable(spark, n_per=20, dim=4).withColumn("label", F.col("label_idx").cast("string"))
    spec = small_dense_net(4, 3, hidden=3)
    res = run_job(spark, df, spec, JobConfig(epochs=1, batch_size=8, workers=2, averaging_frequency=1))
    test = split_exact(df, "id", 0.8).filter("split = 'test'").toPandas()
    p, _ = forward(spec, res.model.params, batch_input(spec, test["features"]))
    expect = Counter(zip(test["label_idx"].astype(int), p.argmax(axis=1).astype(int)))
    got = {(r.actual, r.predicted): r.n for r in res.confusion.collect()}
    assert got == dict(expect)
    res.release(delete_files=True)


@pytest.mark.parametrize("workers", [3, 130])
def test_step_is_the_maximum_with_and_without_metrics(spark, workers):
    """Workers with different numbers of batches; 130 workers also take the averaging tree."""
    from tessera.operators.batching import batch_assign
    df = _separable(spark, n_per=47, dim=4)  # 141 rows: one worker has an extra batch
    spec = small_dense_net(4, 3)
    rows = batch_assign(split_exact(df, "id", 1.0), "split_rn", 1 if workers == 130 else 20, workers, 4)
    rows = rows.filter("round = 0")
    most = rows.groupBy("worker").agg(F.countDistinct("batch_id").alias("n")).agg(F.max("n"), F.min("n")).first()
    assert most[0] > most[1]
    plain = run_round(spec, new_model(spec), rows, workers=workers)
    told, _ = run_round(spec, new_model(spec), rows, workers=workers, with_metrics=True)
    assert plain.step == told.step == most[0]


def test_job_checks_labels_first_and_reports_rows_without_one(spark):
    from tessera.plans.job import JobConfig, run_job
    from tessera.plans.models import Rules
    df = _separable(spark, n_per=20, dim=4).withColumn("label", F.col("label_idx").cast("string"))
    cfg = JobConfig(epochs=1, batch_size=8, workers=2, averaging_frequency=1)
    with pytest.raises(ValueError, match="3 labels"):
        run_job(spark, df, small_dense_net(4, 2), cfg)
    some = df.withColumn("label", F.when(F.col("id") % 10 == 0, None).otherwise(F.col("label")))
    n_null = some.filter("label IS NULL").count()
    spec = NetSpec("sr", (4,), (Output("output", 3),), Rules(momentum=0.5))
    res = run_job(spark, some, spec, cfg)
    rep = res.report.first()
    assert n_null and rep.n_unlabelled == n_null and rep.n_invalid == 0 and rep.n_test == round(0.2 * (60 - n_null))
    assert rep.params["num_labels"] == "3" and rep.params["inputs"] == "4" and rep.params["iterations"] == "1"
    assert len(rep.warnings) == 1 and "momentum" in rep.warnings[0]
    res.release(delete_files=True)
