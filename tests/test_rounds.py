"""Barrier rounds, the metrics sink and the model store."""

import json
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.sampling import split_exact
from tessera.plans import model_store
from tessera.plans.models import small_dense_net
from tessera.plans.rounds import Layout, RoundStore, model_chunks
from tessera.plans.training import (load_trained, model_from_chunks, new_model, param_shapes, prepare_training_rows,
                                    save_trained, train_fit)
from tessera.sources.files import Folder, sealed, unsealed
from tessera.sources.metrics import METRICS_SCHEMA, read_metrics, write_metrics

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def examples(spark, n=120, dim=5):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, (rng.normal(size=dim) + i % 3).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "id long, label_idx int, features array<double>")


def prepared(spark, workers=6, slots=3, batch=5, k=1):
    return prepare_training_rows(split_exact(examples(spark), "id", 1.0), batch_size=batch, workers=workers,
                                 averaging_frequency=k, slots=slots)


@pytest.mark.parametrize("updater,weighted", [("sgd", False), ("rmsprop", True), ("nesterovs", False)])
def test_barrier_epochs_equal_a_job_per_round(spark, updater, weighted):
    spec = small_dense_net(5, 3, hidden=4, updater=updater)
    # 24 batches over 7 workers: the last round leaves workers, and a slot, without a batch.
    rows = prepared(spark, workers=7, slots=3)
    one, told = train_fit(spec, rows, 2, new_model(spec), barrier=True, weighted=weighted)
    many, told2 = train_fit(spec, rows, 2, new_model(spec), barrier=False, weighted=weighted)
    assert one.step == many.step
    for k in many.params:
        assert np.allclose(one.params[k], many.params[k], atol=1e-12), k
    for k in many.state:
        assert np.allclose(one.state[k], many.state[k], atol=1e-12), k
    a, b = (sorted(tuple(r) for r in read_metrics(spark, p).collect()) for p in (told, told2))
    assert [r[:6] + r[7:] for r in a] == [r[:6] + r[7:] for r in b] and len(a) == 2 * 24
    assert np.allclose([r[6] for r in a], [r[6] for r in b])
    assert len({r[:5] for r in a}) == len(a)  # each (run, epoch, round, worker, batch) once


def test_a_task_gets_whole_buckets_however_files_are_split(spark):
    spec, rows = small_dense_net(5, 3), prepared(spark, workers=7, slots=3)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in before:
            spark.conf.set(k, "500b" if "max" in k else "0b")
        assert rows.select("features").rdd.getNumPartitions() > 3  # read by file ranges
        one, _ = train_fit(spec, rows, 1, new_model(spec), barrier=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    many, _ = train_fit(spec, rows, 1, new_model(spec), barrier=False)
    assert all(np.allclose(one.params[k], many.params[k], atol=1e-12) for k in many.params)


def test_jobs_per_epoch_do_not_depend_on_rounds(spark):
    spec = small_dense_net(5, 3)
    sc = spark.sparkContext
    jobs = {}
    for workers in (3, 12):
        rows = prepared(spark, workers=workers, slots=3)
        n = rows.agg(F.max("round")).first()[0] + 1
        sc.setJobGroup(f"fit{workers}", "")
        train_fit(spec, rows, 1, new_model(spec), barrier=True)
        jobs[n] = len(sc.statusTracker().getJobIdsForGroup(f"fit{workers}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(jobs) == [2, 8] and len(set(jobs.values())) == 1


FAILING = """
import json, os, sys
sys.path[:0] = [{root!r}, {root!r} + "/tests"]
import numpy as np
from test_rounds import prepared
from tessera.plans.models import small_dense_net
from tessera.plans.training import new_model, train_fit
from tessera.session import build_session
from tessera.sources.metrics import read_metrics

spark = build_session("local[3,4]")  # a task may fail before its job does
spec, log = small_dense_net(5, 3, hidden=4, updater="rmsprop"), {log!r}
rows = prepared(spark)

def on_round(epoch, round_, task, started):
    open(f"{{log}}/{{epoch}}-{{round_}}-{{task}}-{{started}}", "w").close()
    if (epoch, round_, task, started) == (1, 2, 1, 0):
        raise RuntimeError("lost on purpose")

out = {{}}
for name, hook in (("plain", None), ("failing", on_round)):
    m, told = train_fit(spec, rows, 2, new_model(spec), barrier=True, on_round=hook)
    t = sorted(tuple(r) for r in read_metrics(spark, told).collect())
    out[name] = {{"step": m.step, "params": {{k: v.tolist() for k, v in m.params.items()}}, "metrics": t}}
print("RESULT" + json.dumps(out))
"""


def test_a_failed_stage_goes_on_after_the_last_written_round(tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    run = subprocess.run([sys.executable, "-c", FAILING.format(root=ROOT, log=str(log))], capture_output=True, text=True, timeout=600)
    assert run.returncode == 0, run.stderr[-3000:]
    out = json.loads(next(x for x in run.stdout.splitlines() if x.startswith("RESULT"))[6:])
    assert out["plain"] == out["failing"]  # weights bit for bit, every metrics row once
    assert len(out["plain"]["metrics"]) == 2 * 24
    runs = {tuple(map(int, n.split("-"))) for n in os.listdir(log)}
    assert {e: r for e, r, _, started in sorted(runs, reverse=True) if started} == {1: 3}  # rounds up to 2 aren't repeated


def test_driver_restart_in_the_middle_of_an_epoch(spark, tmp_path, monkeypatch):
    from tessera.plans import training
    spec, rows = small_dense_net(5, 3, hidden=4, updater="nesterovs"), prepared(spark, workers=3)
    full, told = train_fit(spec, rows, 2, new_model(spec))
    root, sink = str(tmp_path / "rounds"), str(tmp_path / "metrics")

    def stop(epoch, round_, task, started):
        if epoch == 1 and round_ >= 1:
            raise RuntimeError("lost again and again")

    with pytest.raises(Exception, match="lost again"):
        train_fit(spec, rows, 2, new_model(spec), checkpoint_path=root, metrics_path=sink, on_round=stop, barrier=True)
    assert RoundStore(root).last()[0] == 1 and 1 <= RoundStore(root).last()[1] < 7  # of 8 rounds
    assert read_metrics(spark, sink).count() == 24  # the failed epoch committed none

    def dies(rows_, *rest):
        rows_.collect()
        raise RuntimeError("the driver dies before the commit")

    monkeypatch.setattr(training, "write_metrics", dies)
    with pytest.raises(RuntimeError):
        train_fit(spec, rows, 2, new_model(spec), checkpoint_path=root, metrics_path=sink, resume=True)
    monkeypatch.undo()
    assert RoundStore(root).last() == (1, 7) and read_metrics(spark, sink).count() == 24
    for barrier in (True, False):  # the second finds nothing to do
        resumed, _ = train_fit(spec, rows, 2, new_model(spec), checkpoint_path=root, metrics_path=sink, resume=True, barrier=barrier)
        assert resumed.step == full.step and all(np.array_equal(resumed.params[k], full.params[k]) for k in full.params)
        assert sorted(map(tuple, read_metrics(spark, sink).collect())) == sorted(map(tuple, read_metrics(spark, told).collect()))


def test_an_incomplete_or_damaged_round_is_not_taken(tmp_path):
    store = RoundStore(str(tmp_path))
    store.write_slice(0, -1, 0, 1, np.arange(6.0), 0)
    store.write_slice(0, 0, 0, 2, np.arange(3.0), 1)
    assert store.last() == (0, -1)
    store.write_slice(0, 0, 1, 2, np.arange(3.0, 6.0), 1)
    vector, step = store.read_model(*store.last())
    assert store.last() == (0, 0) and vector.tolist() == list(range(6)) and step == 1
    assert np.frombuffer(store.read_range(0, 0, 2, 5)).tolist() == [2, 3, 4]
    with pytest.raises(ValueError):
        unsealed(sealed(b"abc")[:-1])
    with pytest.raises(ValueError):
        unsealed(sealed(b"abc")[:-1] + b"x")


# -- metrics sink -------------------------------------------------------------

def metric_rows(spark, run, epoch, n, score=1.0):
    return spark.createDataFrame([(run, epoch, b // 4, b % 2, b, 18, score, b) for b in range(n)], METRICS_SCHEMA).repartition(3)


def test_metrics_commit_replaces_an_epoch_and_keeps_every_nth(spark, tmp_path):
    path = str(tmp_path / "m")
    assert read_metrics(spark, path).count() == 0
    write_metrics(metric_rows(spark, "a/b", 0, 10), path, "a/b", 0)
    write_metrics(metric_rows(spark, "a/b", 1, 10), path, "a/b", 1, every=4)
    write_metrics(metric_rows(spark, "other", 0, 3), path, "other", 0)
    got = read_metrics(spark, path)
    assert sorted((r.run_id, r.epoch, r.batch) for r in got.collect()) == sorted(
        [("a/b", 0, b) for b in range(10)] + [("a/b", 1, b) for b in (0, 4, 8)] + [("other", 0, b) for b in range(3)])
    write_metrics(metric_rows(spark, "a/b", 0, 10, score=2.0), path, "a/b", 0)  # a resumed epoch
    assert read_metrics(spark, path, "a/b", 0).agg(F.count("*"), F.min("score")).first()[:] == (10, 2.0)
    assert read_metrics(spark, path).filter("epoch = 0").count() == 13
    write_metrics(metric_rows(spark, "none", 0, 0), path, "none", 0)
    assert read_metrics(spark, path, run_id="none").count() == 0


def test_uncommitted_metrics_are_not_read(spark, tmp_path):
    path = str(tmp_path / "m")
    write_metrics(metric_rows(spark, "a", 0, 5), path, "a", 0)
    bad = metric_rows(spark, "a", 1, 9).withColumn("score", F.when(F.col("batch") == 7, F.raise_error(F.lit("lost"))).otherwise(1.0))
    with pytest.raises(Exception):
        write_metrics(bad, path, "a", 1)
    assert {r.epoch for r in read_metrics(spark, path).collect()} == {0}


# -- model store -----------------------------------------------------------------

def test_versions_appear_with_their_manifest_only(spark, tmp_path, monkeypatch):
    spec, path = small_dense_net(4, 3, hidden=3, updater="nesterovs"), str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        load_trained(spark, path)
    first, second = new_model(spec), new_model(spec, zeros=True)
    second.step = 9
    assert save_trained(spark, spec, first, path) == 1
    whole = Folder.write

    def dies(self, name, body):
        if name.startswith(model_store.VERSIONS):
            raise OSError("killed before the manifest")
        whole(self, name, body)

    monkeypatch.setattr(Folder, "write", dies)
    with pytest.raises(OSError):
        save_trained(spark, spec, second, path)
    monkeypatch.undo()
    assert list(model_store.versions(path)) == [1]
    back_spec, back = load_trained(spark, path)
    assert back_spec == spec and all(np.array_equal(back.params[k], first.params[k]) for k in first.params)
    assert save_trained(spark, spec, second, path, {"note": "b"}) == 2
    assert load_trained(spark, path)[1].step == 9 and load_trained(spark, path, 1)[1].step == 0
    manifest = next(n for n in os.listdir(f"{path}/versions") if n.startswith("00000002"))
    raw = open(f"{path}/versions/{manifest}", "rb").read()
    open(f"{path}/versions/{manifest}", "wb").write(raw[:-5])  # cut off
    assert list(model_store.versions(path)) == [1]
    model_store.delete_version(spark, path, 1)
    assert model_store.versions(path) == {}


def test_a_version_with_other_data_is_refused(spark, tmp_path):
    spec, path = small_dense_net(4, 3), str(tmp_path / "store")
    save_trained(spark, spec, new_model(spec), path)
    data = f"{path}/{model_store.versions(path)[1]['data']}"
    wrong = [("output.W", 0, np.zeros(12).tobytes()), ("output.b", 0, np.zeros(3).tobytes())]
    spark.createDataFrame(wrong, model_store.CHUNK_COLUMNS).write.mode("overwrite").parquet(data)
    with pytest.raises(ValueError, match="manifest"):
        load_trained(spark, path)


def test_executors_save_the_trained_model(spark, tmp_path):
    spec, rows, path = small_dense_net(5, 3, hidden=4, updater="rmsprop"), prepared(spark), str(tmp_path / "s")
    model, _ = train_fit(spec, rows, 1, new_model(spec), save_path=path)
    _, back = load_trained(spark, path)
    assert back.step == model.step
    assert all(np.array_equal(back.params[k], model.params[k]) for k in model.params)
    assert all(np.array_equal(back.state[k], model.state[k]) for k in model.state)


def test_chunks_cross_slices(spark, tmp_path):
    spec = small_dense_net(7, 3, hidden=5)
    layout, store, m = Layout(spec, param_shapes(spec)), RoundStore(str(tmp_path)), new_model(spec)
    vector = layout.pack(m.params, m.state)
    cuts = [0, 3, 11, len(vector)]
    for t in range(3):
        store.write_slice(2, 4, t, 3, vector[cuts[t]:cuts[t + 1]], 6)
    rows = model_chunks(spark, layout, str(tmp_path), chunk=4).collect()
    back = model_from_chunks(spec, [(r.param, r.chunk, r["values"]) for r in rows])
    assert back.step == 6 and all(np.array_equal(back.params[k], m.params[k]) for k in m.params)


def test_job_saves_the_model_and_keeps_every_nth_metric(spark, tmp_path):
    from tessera.plans.job import JobConfig, run_job
    df = examples(spark).withColumn("label", F.col("label_idx").cast("string"))
    spec, path = small_dense_net(5, 3), str(tmp_path / "store")
    res = run_job(spark, df, spec, JobConfig(epochs=2, batch_size=6, workers=2, averaging_frequency=2, metrics_every=3, save_path=path))
    assert sorted({r.batch for r in res.training_metrics.collect()}) == [0, 3, 6, 9, 12, 15]
    _, saved = load_trained(spark, path)
    assert all(np.allclose(saved.params[k], res.model.params[k]) for k in saved.params)
    assert not {"save_path", "metrics_every"} & set(res.report.first().params)
    res.release(delete_files=True)
