import pytest
from pyspark.sql import functions as F

from tessera.functions.arrays import one_hot
from tessera.functions.text import duration_text, parent_name
from tessera.operators.evaluation import class_metrics, confusion_matrix, eval_summary


def test_class_never_predicted_gives_null_precision(spark):
    pred = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2)], "actual int, predicted int")
    classes = spark.range(3).select(F.col("id").cast("int").alias("label_idx"))
    m = {r.label_idx: r for r in class_metrics(confusion_matrix(pred), classes).collect()}
    assert m[1].precision is None and m[1].recall == 0.0 and m[1].f1 is None
    assert m[0].precision == pytest.approx(2 / 3) and m[0].recall == 1.0
    s = eval_summary(class_metrics(confusion_matrix(pred), classes)).first()
    assert s.n == 4 and s.accuracy == pytest.approx(0.75)


def test_one_class_only(spark):
    pred = spark.createDataFrame([(0, 0), (0, 0)], "actual int, predicted int")
    classes = spark.createDataFrame([(0,)], "label_idx int")
    s = eval_summary(class_metrics(confusion_matrix(pred), classes)).first()
    assert s.accuracy == 1.0 and s.macro_f1 == 1.0


def test_one_hot_out_of_range_is_an_error(spark):
    df = spark.createDataFrame([(1,), (5,)], "label_idx int")
    assert df.filter("label_idx = 1").select(one_hot("label_idx", 3).alias("v")).first().v == [0.0, 1.0, 0.0]
    with pytest.raises(Exception):
        df.select(one_hot("label_idx", 3)).collect()


def test_parent_name_and_duration(spark):
    df = spark.createDataFrame([("/data/root/cats/img1.jpg", 3_723_456)], "path string, ms long")
    r = df.select(parent_name("path").alias("label"), duration_text("ms").alias("t"),
                  duration_text("ms", whole_ms_quirk=True).alias("q")).first()
    assert r.label == "cats"
    assert r.t == "62 min, 3 sec, 456 ms"
    assert r.q == "62 min, 3 sec, 3723456 ms"


def test_scoring_keeps_ids_exact_beside_nulls(spark):
    import numpy as np

    from tessera.operators.scoring import score_batch
    from tessera.plans.models import predict, small_dense_net
    from tessera.plans.training import new_model
    spec = small_dense_net(3, 2)
    params = new_model(spec).params
    rows = [(2 ** 53 + 1, None, "a", [1.0, 2.0, 3.0]), (None, 2 ** 53 + 3, None, [0.0, -1.0, 0.5]), (2 ** 53 + 3, 1, "b", [4.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "id long, actual long, note string, features array<double>").coalesce(1)
    out = score_batch(df, spec, params, keep=["id", "actual", "note"]).collect()
    assert [(r.id, r.actual, r.note) for r in out] == [r[:3] for r in rows]
    want = predict(spec, params, np.array([r[3] for r in rows]))
    assert np.allclose([r.probs for r in out], want) and [r.predicted for r in out] == want.argmax(axis=1).tolist()
    assert score_batch(df.filter("id = 0"), spec, params, keep=["id"]).collect() == []


def test_a_large_model_is_mapped_once_per_host(spark, monkeypatch):
    import numpy as np

    from tessera.operators import scoring
    from tessera.operators.shared_model import open_params, share_params
    from tessera.plans.models import predict, small_dense_net
    from tessera.plans.training import new_model
    from tessera.session import delete_path
    spec = small_dense_net(3, 2, hidden=4)
    params = new_model(spec).params
    path = share_params(spark, params)
    back = open_params(path)
    assert all(np.array_equal(back[k], params[k]) and isinstance(back[k], np.memmap) and not back[k].flags.writeable for k in params)
    df = spark.createDataFrame([(i, [float(i), 1.0, -1.0]) for i in range(50)], "id long, features array<double>").repartition(4)
    want = predict(spec, params, np.array([[float(i), 1.0, -1.0] for i in range(50)]))
    monkeypatch.setattr(scoring, "CLOSURE_BYTES", 0)
    for shared in (path, None):
        out = scoring.score_batch(df, spec, params, keep=["id"], shared=shared).orderBy("id").collect()
        assert np.allclose([r.probs for r in out], want)

    def kinds(batches):  # what the workers hold
        import pyarrow as pa
        for b in batches:
            yield pa.record_batch([pa.array([type(v).__name__ for v in open_params(path).values()])], ["kind"])

    assert {r.kind for r in df.mapInArrow(kinds, "kind string").collect()} == {"memmap"}
    delete_path(spark, path)
