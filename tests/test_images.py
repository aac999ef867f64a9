"""Image folders made by the JVM's ImageIO (JPEG) and our PNG writer."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources.images import (list_images, png_bytes, read_capped, read_images, resize_bilinear,
                                    to_channels, to_tensors)


def _jpeg(spark, path, w, h, rgb):
    jvm = spark.sparkContext._jvm
    img = jvm.java.awt.image.BufferedImage(w, h, 1)  # TYPE_INT_RGB
    for y in range(h):
        for x in range(w):
            img.setRGB(x, y, rgb)
    jvm.javax.imageio.ImageIO.write(img, "jpg", jvm.java.io.File(path))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("imgs")
    sizes = [(12, 10), (20, 16), (9, 9)]
    for ci, cls in enumerate(["cat", "dog", "emu"]):
        os.makedirs(root / cls)
        for j in range(10):
            w, h = sizes[(ci + j) % 3]
            _jpeg(spark, str(root / cls / f"{cls}{j}.jpg"), w, h, 0x203040 + ci * 0x100000)
    (root / "cat" / "broken.jpg").write_bytes(b"not an image")
    (root / "dog" / "upper.JPG").write_bytes((root / "dog" / "dog0.jpg").read_bytes())
    (root / "emu" / "grey.png").write_bytes(png_bytes(np.full((4, 4), 7)))
    os.makedirs(root / "empty")
    return str(root)


def test_scan_filters_extension_and_labels(spark, folder):
    df = read_images(spark, folder)  # *.jpg only: not .JPG, not .png
    rows = df.collect()
    assert len(rows) == 31
    bad = [r for r in rows if r.height == -1]
    assert len(bad) == 1 and bad[0].path.endswith("broken.jpg")
    counts = {r.label: r["count"] for r in df.groupBy("label").count().collect()}
    assert counts == {"cat": 11, "dog": 10, "emu": 10}
    assert read_images(spark, folder, drop_invalid=True).count() == 30


def test_paths_listing_and_cap(spark, folder):
    assert list_images(spark, folder).count() == 31
    capped = read_capped(spark, folder, 7, glob="*.jpg")
    assert capped.count() == 7
    assert read_capped(spark, folder, 100).count() == 31


def test_tensors_resized_and_planar(spark, folder):
    t = to_tensors(read_images(spark, folder, drop_invalid=True), 6, 5, 3)
    rows = t.collect()
    assert all(len(r.features) == 90 for r in rows)
    cat = next(r for r in rows if r.label == "cat")
    f = np.array(cat.features).reshape(3, 6, 5)
    # BGR planes of 0x203040: blue 0x40, green 0x30, red 0x20 (JPEG is lossy: +-3)
    assert np.allclose(f.mean(axis=(1, 2)), [0x40, 0x30, 0x20], atol=3)


def test_png_pixels_bgr(spark, tmp_path):
    d = tmp_path / "c"
    os.makedirs(d)
    (d / "px.png").write_bytes(png_bytes(np.array([[[255, 0, 0], [0, 0, 255]]])))
    r = read_images(spark, str(tmp_path), glob="*.png").first()
    assert (r.height, r.width, r.n_channels) == (1, 2, 3)
    assert list(r.data) == [0, 0, 255, 255, 0, 0]


def test_resize_and_channels():
    img = np.arange(16, dtype=float).reshape(4, 4, 1)
    half = resize_bilinear(img, 2, 2)[:, :, 0]
    assert np.allclose(half, [[2.5, 4.5], [10.5, 12.5]])  # 2x2 block means
    assert to_channels(np.ones((2, 2, 1)), 3).shape == (2, 2, 3)
    assert np.allclose(to_channels(np.ones((2, 2, 3)), 1), 1.0)


def test_lenet_job_on_image_folder(spark, folder):
    """The original local job's shape: image folder -> cap -> LeNet -> report."""
    from tessera.functions.arrays import scale_range
    from tessera.plans.job import JobConfig, run_job
    from tessera.plans.models import preset
    imgs = to_tensors(read_images(spark, folder, drop_invalid=True), 20, 20, 3, as_bytes=True)
    ex = imgs.select(F.col("path").alias("id"), "label", "features")
    spec = preset("LeNet", channels=3, height=20, width=20, num_labels=3).with_scale(1 / 255)
    res = run_job(spark, ex, spec, JobConfig(epochs=2, batch_size=6, workers=2, averaging_frequency=1,
                                             max_examples=24))
    rep = res.report.first()
    assert rep.model == "LeNet" and rep.n_test == round(24 * 0.2)
    assert res.training_metrics.count() == 2 * 4  # 2 epochs x ceil(19 / 6) batches
    assert [r.label for r in res.vocab.orderBy("label_idx").collect()] == ["cat", "dog", "emu"]
    one = res.sample.collect()
    assert len(one) == 1 and one[0].expected in ("cat", "dog", "emu") and one[0].predicted_name is not None
    from tessera.plans.report import report_text
    text = report_text(res)
    assert "0 = cat" in text and "accuracy" in text and "sample: expected" in text
    assert " -> " in text


def test_byte_tensors_equal_scaled_floats(spark, folder):
    from tessera.functions.arrays import scale_range
    from tessera.plans.models import batch_input, small_dense_net
    imgs = read_images(spark, folder, drop_invalid=True)
    b = {r.path: r.features for r in to_tensors(imgs, 6, 5, 3, as_bytes=True).collect()}
    f = {r.path: r.features for r in to_tensors(imgs, 6, 5, 3).select("path", scale_range("features").alias("features")).collect()}
    spec = small_dense_net(90, 3).with_scale(1 / 255)
    xb = batch_input(spec, [b[k] for k in sorted(b)])
    xf = np.array([f[k] for k in sorted(f)])
    assert len(b[next(iter(b))]) == 90
    assert np.abs(xb - xf).max() <= 0.5 / 255 + 1e-9  # 8-bit rounding only


def test_cap_of_any_size_with_odd_file_names(spark, tmp_path):
    """Glob characters, spaces and percent signs in names; caps below and above the folder."""
    for cls, form in (("a", "x[{}].png"), ("b b", "y*{} z.png"), ("c%20", "100%{}.png")):
        os.makedirs(tmp_path / cls)
        for j in range(10):
            (tmp_path / cls / form.format(j)).write_bytes(png_bytes(np.full((2, 2), j)))
    root = str(tmp_path)
    everything = {r.path for r in read_images(spark, root, "*.png").collect()}
    assert len(everything) == 30
    capped = {n: {r.path for r in read_capped(spark, root, n, glob="*.png").collect()} for n in (0, 7, 20, 200_000)}
    assert [len(capped[n]) for n in (0, 7, 20, 200_000)] == [0, 7, 20, 30]
    assert capped[7] < capped[20] < everything == capped[200_000]  # a larger cap only adds


def test_cap_opens_only_the_chosen_files(spark, folder):
    for n in (7, 20):
        df = read_capped(spark, folder, n)
        assert len(df.collect()) == n
        scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numFiles").value() == n


def test_job_reports_and_skips_invalid_images(spark, folder):
    from tessera.plans.job import JobConfig, run_job
    from tessera.plans.models import preset
    imgs = to_tensors(read_images(spark, folder), 20, 20, 3, as_bytes=True)  # keeps broken.jpg
    ex = imgs.select(F.col("path").alias("id"), "label", "features")
    spec = preset("LeNet", channels=3, height=20, width=20, num_labels=3).with_scale(1 / 255)
    res = run_job(spark, ex, spec, JobConfig(epochs=1, batch_size=8, workers=2, averaging_frequency=1))
    rep = res.report.first()
    assert rep.n_invalid == 1 and rep.n_test == round(30 * 0.2)
    import os
    local = [p.replace("file:", "", 1) for p in res.scratch]
    assert len(local) == 5 and all(os.path.exists(p) for p in local)
    res.release(delete_files=True)
    assert not any(os.path.exists(p) for p in local)


def test_command_line_runner(spark, folder, capsys):
    import importlib.util
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools", "run_job.py")
    spec = importlib.util.spec_from_file_location("run_job_cli", path)
    cli = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(cli)
    cli.main(["--dir-path", folder, "--model-type", "LeNet", "--height", "20", "--width", "20",
              "--epochs", "1", "--batch-size-per-worker", "6", "--max-examples", "24"])
    out = capsys.readouterr().out
    assert "model = LeNet" in out and "0 = cat" in out and "accuracy" in out


def test_alexnet_job_runs_end_to_end(spark, folder):
    """The original distributed job's default model through the whole job (LRN, dropout,
    Nesterov, per-layer renormalisation, sum gradients), at its smallest input."""
    from tessera.plans.job import JobConfig, run_job
    from tessera.plans.models import preset
    imgs = to_tensors(read_images(spark, folder, drop_invalid=True), 61, 61, 3, as_bytes=True)
    ex = imgs.select(F.col("path").alias("id"), "label", "features")
    spec = preset("AlexNet", channels=3, height=61, width=61, num_labels=3).with_scale(1 / 255)
    res = run_job(spark, ex, spec, JobConfig(epochs=1, batch_size=8, workers=2, averaging_frequency=2))
    rep = res.report.first()
    assert rep.model == "AlexNet" and rep.n_test == 6 and rep.accuracy is not None
    assert all(np.isfinite(v).all() for v in res.model.params.values())
    res.release(delete_files=True)
