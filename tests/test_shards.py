"""Image shards against the folder reader, and stacked resizing against one image at a time."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.sources.images import (png_bytes, read_images, resize_bilinear, resize_stack, stack_channels, to_channels,
                                    to_tensors)
from tessera.sources.shards import ENTRY, decode, decode_png, pack_folder, raw_body, read_shards, write_shards


def filtered_png(px, kinds):
    """A PNG whose row y uses row filter ``kinds[y % len(kinds)]``, by the format's definition."""
    h, w, c = px.shape
    raw, prior = b"", bytes(w * c)
    for y in range(h):
        line, kind, out = px[y].astype(np.uint8).tobytes(), kinds[y % len(kinds)], bytearray()
        for i, v in enumerate(line):
            a = line[i - c] if i >= c else 0
            b, d = prior[i], prior[i - c] if i >= c else 0
            p = a + b - d
            near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]
            out.append((v - (0, a, b, (a + b) // 2, near)[kind]) % 256)
        raw, prior = raw + bytes([kind]) + bytes(out), line

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    packed = zlib.compress(raw)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, {1: 0, 3: 2, 4: 6}[c], 0, 0, 0))
            + chunk(b"IDAT", packed[:7]) + chunk(b"IDAT", packed[7:]) + chunk(b"IEND", b""))


@pytest.mark.parametrize("channels", [1, 3, 4])
def test_png_row_filters(channels):
    px = np.random.default_rng(channels).integers(0, 256, (9, 5, channels))
    for kinds in ([0], [1], [2], [3], [4], [4, 2, 0, 3, 1]):
        assert (decode_png(filtered_png(px, kinds)) == px).all()


def test_odd_bodies_are_invalid_not_errors():
    good = png_bytes(np.full((2, 2), 9))
    assert decode("png", good)[:4] == (2, 2, 1, 0)
    for kind, body in (("png", b""), ("png", b"no image"), ("png", good[:30]), ("raw", b"abc"), ("raw", raw_body(2, 2, 1, b"abc")),
                       ("raw", raw_body(2, 2, 7, bytes(28)))):
        assert decode(kind, body) == (-1, -1, -1, -1, b"")


def entries(spark, n=60):
    rows = []
    for i in range(n):
        rows.append((f"c{i % 3}/a{i}.png", "png", png_bytes(np.full((i % 7 + 1, 4), i))))
        rows.append((f"c{i % 3}/a{i}.jpg", "raw", raw_body(1, 2, 3, bytes([i] * 6))))
        rows.append((f"c{i % 3}/a{i}.txt", "png", b"" if i % 2 else b"text"))
    return spark.createDataFrame(rows, ENTRY).repartition(3)


@pytest.mark.parametrize("range_bytes", [50, 700, 1 << 20])
def test_every_entry_once_and_filters(spark, tmp_path, range_bytes):
    root = str(tmp_path / "s")
    write_shards(entries(spark), root, shard_bytes=2000)
    assert len([f for f in os.listdir(root) if f.endswith(".shard")]) > 3
    everything = read_shards(spark, root, None, range_bytes=range_bytes)
    got = sorted((r.path, r.label, r.height) for r in everything.collect())
    assert got == sorted((f"c{i % 3}/a{i}{e}", f"c{i % 3}", {".png": i % 7 + 1, ".jpg": 1, ".txt": -1}[e])
                         for i in range(60) for e in (".png", ".jpg", ".txt"))
    png = read_shards(spark, root, [".png"], range_bytes=range_bytes)
    assert png.count() == 60 and {r.n_channels for r in png.collect()} == {1}
    two = read_shards(spark, root, [".png", ".jpg"], ["c0", "c2"], range_bytes=range_bytes).collect()
    assert len(two) == 80 and {r.label for r in two} == {"c0", "c2"}
    assert read_shards(spark, root, None, drop_invalid=True).count() == 120
    assert read_shards(spark, root, [".PNG"]).count() == 0  # case-sensitive, as the folder reader


def test_uncommitted_and_damaged_shards(spark, tmp_path):
    root = str(tmp_path / "s")
    bad = entries(spark).withColumn("body", F.when(F.col("path") == "c1/a4.png", F.raise_error(F.lit("lost"))).otherwise(F.col("body")))
    with pytest.raises(Exception):
        write_shards(bad, root)
    with pytest.raises(Exception):
        read_shards(spark, root, None).count()  # no manifest
    write_shards(entries(spark), root)
    name = next(n for n in os.listdir(root) if n.endswith(".shard"))
    raw = bytearray(open(f"{root}/{name}", "rb").read())
    raw[40] ^= 1
    open(f"{root}/{name}", "wb").write(raw)
    with pytest.raises(Exception, match="damaged"):
        read_shards(spark, root, None).collect()


def test_a_packed_folder_equals_the_folder(spark, tmp_path):
    for cls in ("cat", "dog"):
        os.makedirs(tmp_path / "f" / cls)
        for j in range(5):
            jvm = spark.sparkContext._jvm
            img = jvm.java.awt.image.BufferedImage(6 + j, 5, 1)
            img.setRGB(1, 1, 0x405060 + j)
            jvm.javax.imageio.ImageIO.write(img, "jpg", jvm.java.io.File(str(tmp_path / "f" / cls / f"{cls}{j}.jpg")))
            (tmp_path / "f" / cls / f"{cls}{j}.png").write_bytes(png_bytes(np.full((3, 3, 3), j)))
    (tmp_path / "f" / "cat" / "broken.jpg").write_bytes(b"no image")
    images, root = read_images(spark, str(tmp_path / "f"), glob="*"), str(tmp_path / "s")
    pack_folder(images, root)
    for ext in (".jpg", ".png"):
        want = read_images(spark, str(tmp_path / "f"), glob=f"*{ext}")
        got = read_shards(spark, root, [ext])
        key = ["path", "label", "height", "width", "n_channels", "mode", "data"]
        assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, want.select(key).collect()))


def test_empty_shards(spark, tmp_path):
    root = str(tmp_path / "s")
    write_shards(spark.createDataFrame([], ENTRY), root)
    assert read_shards(spark, root, None).collect() == []


def test_stacks_equal_single_images():
    rng = np.random.default_rng(2)
    for h, w, c, oh, ow in ((8, 8, 1, 4, 4), (7, 5, 3, 11, 3), (1, 9, 3, 4, 4), (6, 6, 4, 6, 6), (2, 3, 1, 9, 1)):
        stack = rng.integers(0, 256, (5, h, w, c)).astype(np.uint8)
        for k in (1, 3):
            got = stack_channels(resize_stack(stack, oh, ow), k)
            want = np.stack([to_channels(resize_bilinear(i, oh, ow), k) for i in stack])
            assert got.shape == want.shape and np.allclose(got, want, atol=1e-9)
    with pytest.raises(ValueError):
        stack_channels(np.zeros((1, 2, 2, 2)), 3)


def test_mixed_sizes_and_invalid_images_keep_their_rows(spark, tmp_path, monkeypatch):
    import tessera.sources.images as I
    monkeypatch.setattr(I, "STACK_VALUES", 200)
    root = str(tmp_path / "s")
    write_shards(entries(spark), root)
    images = read_shards(spark, root, None)
    for kw in ({}, {"doubles": True}, {"as_bytes": True}):
        rows = to_tensors(images, 3, 5, 3, keep=["path"], **kw).collect()
        assert len(rows) == 180
        for r in rows:
            i = int(r.path.split("/a")[1][:-4])
            if r.path.endswith(".txt"):
                assert r.features is None
            else:
                assert np.allclose(list(r.features), [i] * 45, atol=1e-4)
