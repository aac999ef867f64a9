"""Image folders: ``root/<label>/<name>.<ext>``, one sub-folder per class.

Spark's ``image`` source lists and decodes on the executors (data is
interleaved rows in BGR order). The label is the parent folder's name.
Resizing and the move to a planar float tensor run on stacks of images in ``mapInArrow``.
At scale, a folder is packed into shards once (``shards``) and read from there.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import file_stem, parent_name
from tessera.operators.sampling import hash_row_number, seeded_key
from tessera.sources.files import filesystem


def _scan(spark: SparkSession, source: str, root: str, glob: str) -> DataFrame:
    return (spark.read.format(source)
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob)
            .load(root))


def read_images(spark: SparkSession, root: str, glob: str = "*.jpg", drop_invalid: bool = False) -> DataFrame:
    """Decoded images with ``path, label, height, width, n_channels, mode, data``.

    ``glob`` prunes files at listing time (case-sensitive). An undecodable
    file gives height = width = -1 unless ``drop_invalid``."""
    df = (spark.read.format("image")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob)
          .option("dropInvalid", str(drop_invalid).lower())
          .load(root))
    return _image_columns(df)


def canonical_path(col):
    """One spelling for local file URIs: the ``image`` source reports
    ``file:///x`` where ``binaryFile`` reports ``file:/x``."""
    return F.regexp_replace(col, r"^file:/+", "file:///")


def _image_columns(df: DataFrame) -> DataFrame:
    return df.select(canonical_path(F.col("image.origin")).alias("path"),
                     parent_name(F.col("image.origin"), strip_tail=False).alias("label"),
                     F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                     F.col("image.nChannels").alias("n_channels"), F.col("image.mode").alias("mode"),
                     F.col("image.data").alias("data"))


def list_images(spark: SparkSession, root: str, glob: str = "*.jpg") -> DataFrame:
    """Paths only (``binaryFile`` with ``content`` pruned: no bytes are read)."""
    return (_scan(spark, "binaryFile", root, glob)
            .select(canonical_path(F.col("path")).alias("path"),
                    parent_name(F.col("path"), strip_tail=False).alias("label")))


def read_capped(spark: SparkSession, root: str, max_examples: int, seed: int = 42,
                glob: str = "*.jpg") -> DataFrame:
    """At most ``max_examples`` random images, chosen on paths before decoding.

    One plan at every size: the cap's last order key is found on the paths alone and the
    image scan is filtered by it on ``_metadata.file_path``, so Spark prunes whole files
    and opens only the chosen ones. One key comes to the driver, whatever the cap."""
    key = seeded_key(F.col("_metadata.file_path"), seed)
    keys = _scan(spark, "binaryFile", root, glob).select(key.alias("_key"))
    first = hash_row_number(keys, "_key", "_key", out="_rn", total_col=None, max_rn=max_examples)
    last = first.agg(F.max("_key")).first()[0]
    return _image_columns(_scan(spark, "image", root, glob).filter(key <= F.lit(last or "")))


# ---- resize and tensor layout ----------------------------------------------

def resize_bilinear(img: np.ndarray, out_h: int, out_w: int) -> np.ndarray:
    """Bilinear resampling with half-pixel centres; ``img`` is ``[H, W, C]``."""
    h, w = img.shape[:2]
    if (h, w) == (out_h, out_w):
        return img.astype(np.float64)

    def axis(n_in, n_out):
        pos = (np.arange(n_out) + 0.5) * (n_in / n_out) - 0.5
        pos = np.clip(pos, 0, n_in - 1)
        lo = np.floor(pos).astype(int)
        hi = np.minimum(lo + 1, n_in - 1)
        return lo, hi, pos - lo

    y0, y1, fy = axis(h, out_h)
    x0, x1, fx = axis(w, out_w)
    a = img.astype(np.float64)
    top = a[y0][:, x0] * (1 - fx)[None, :, None] + a[y0][:, x1] * fx[None, :, None]
    bot = a[y1][:, x0] * (1 - fx)[None, :, None] + a[y1][:, x1] * fx[None, :, None]
    return top * (1 - fy)[:, None, None] + bot * fy[:, None, None]


# ITU-R BT.601 luma weights, applied to B, G, R planes in that order.
LUMA_BGR = (0.114, 0.587, 0.299)


def to_channels(img: np.ndarray, channels: int) -> np.ndarray:
    c = img.shape[2]
    if c == channels:
        return img
    if c == 4:
        img, c = img[:, :, :3], 3
    if c == channels:
        return img
    if c == 1 and channels == 3:
        return np.repeat(img, 3, axis=2)
    if c == 3 and channels == 1:
        return (img * np.array(LUMA_BGR)).sum(axis=2, keepdims=True)
    raise ValueError(f"cannot turn {c} channels into {channels}")


def axis_weights(n_in: int, n_out: int) -> np.ndarray:
    """``[n_out, n_in]`` bilinear weights with half-pixel centres along one axis."""
    pos = np.clip((np.arange(n_out) + 0.5) * (n_in / n_out) - 0.5, 0, n_in - 1)
    lo = np.floor(pos).astype(int)
    out = np.zeros((n_out, n_in))
    out[np.arange(n_out), lo] += 1 - (pos - lo)
    out[np.arange(n_out), np.minimum(lo + 1, n_in - 1)] += pos - lo
    return out


def resize_stack(stack: np.ndarray, height: int, width: int) -> np.ndarray:
    """``[N, H, W, C]`` images resized by one matrix per axis."""
    n, h, w, c = stack.shape
    x = stack.astype(np.float64)
    if h != height:
        x = np.matmul(axis_weights(h, height), x.reshape(n, h, w * c)).reshape(n, height, w, c)
    if w != width:
        x = np.matmul(axis_weights(w, width), x.reshape(n * height, w, c)).reshape(n, height, width, c)
    return x


def stack_channels(stack: np.ndarray, channels: int) -> np.ndarray:
    """``to_channels`` for a stack ``[N, H, W, C]``."""
    c = stack.shape[3]
    if c == 4 and channels in (1, 3):
        stack, c = stack[..., :3], 3
    if c == channels:
        return stack
    if c == 1 and channels == 3:
        return np.repeat(stack, 3, axis=3)
    if c == 3 and channels == 1:
        return stack @ np.array(LUMA_BGR)[:, None]
    raise ValueError(f"cannot turn {c} channels into {channels}")


STACK_VALUES = 4 << 20  # most pixel values resized at once


def to_tensors(images: DataFrame, height: int, width: int, channels: int,
               keep: list[str] | None = None, as_bytes: bool = False, doubles: bool = False) -> DataFrame:
    """Decoded images -> ``features``: resized to height x width, ``channels``
    planes (CHW, BGR as read), values 0..255, as float32 (float64 with ``doubles``). Invalid
    images (height < 1) give NULL features.

    Images of one size and channel count are resized as one stack, by a matrix per axis.
    ``as_bytes`` keeps the resized pixels as 8-bit ``BINARY`` (rounded, as an
    8-bit reader would): a quarter of the float size for the training table
    and its shuffles; scale them with ``NetSpec.input_scale`` (1/255)."""
    keep = list(keep or ["path", "label"])
    value = T.DoubleType() if doubles else T.FloatType()
    schema = T.StructType([f for f in images.select(*keep).schema.fields] +
                          [T.StructField("features", T.BinaryType() if as_bytes else T.ArrayType(value))])
    size = height * width * channels
    rows, kind = max(1, STACK_VALUES // size), np.uint8 if as_bytes else np.float64 if doubles else np.float32

    def conv(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            dims = np.stack([b.column(i).fill_null(-1).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            data = b.column(3)
            good = (dims[:, 0] > 0) & data.is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros((len(dims), size), kind)
            for h, w, c in np.unique(dims[good], axis=0).tolist():
                members = np.flatnonzero(good & (dims == (h, w, c)).all(axis=1))
                at_once = max(1, STACK_VALUES // (h * w * c))
                for at in range(0, len(members), at_once):
                    some = members[at:at + at_once]
                    stack = np.frombuffer(b"".join(data.take(pa.array(some)).to_pylist()), np.uint8).reshape(len(some), h, w, c)
                    x = stack_channels(resize_stack(stack, height, width), channels).transpose(0, 3, 1, 2).reshape(len(some), size)
                    out[some] = np.clip(np.floor(x + 0.5), 0, 255) if as_bytes else x
            ends = np.concatenate([[0], np.cumsum(np.where(good, size, 0))])
            null = pa.array(~good)
            if as_bytes:
                offsets = pa.array(ends.astype(np.int32))
                column = pa.Array.from_buffers(pa.binary(), len(dims), [pa.array(good).buffers()[1], offsets.buffers()[1],
                                                                        pa.py_buffer(out[good].tobytes())])
            else:
                column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out[good].reshape(-1)), mask=null)
            yield pa.RecordBatch.from_arrays([*b.columns[4:], column], names=[*keep, "features"])

    return images.select("height", "width", "n_channels", "data", *[F.col(k).alias(f"_{i}_{k}") for i, k in enumerate(keep)]) \
        .mapInArrow(conv, schema)


# ---- writing image folders (derived data) -----------------------------------

def png_bytes(pixels: np.ndarray) -> bytes:
    """8-bit grey (``[H, W]``) or RGB (``[H, W, 3]``) PNG, no compression tricks."""
    px = np.asarray(pixels, dtype=np.uint8)
    h, w = px.shape[:2]
    color = 0 if px.ndim == 2 else 2
    raw = b"".join(b"\x00" + px[r].tobytes() for r in range(h))

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, color, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def write_image_folder(df: DataFrame, root: str, id_col: str, label_col: str, pixels_col: str,
                       height: int, width: int) -> DataFrame:
    """Write each row's 8-bit grey pixels as ``root/<label>/<id>.png`` from the
    executors (any filesystem pyarrow can open). Returns ``id, path`` rows;
    a retried task rewrites the same bytes to the same names."""
    def write(it):
        fs, base = filesystem(root)
        made = set()
        for pdf in it:
            paths = []
            for i, lab, px in zip(pdf[id_col], pdf[label_col], pdf[pixels_col]):
                folder = f"{base}/{lab}"
                if folder not in made:
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                path = f"{folder}/{i}.png"
                # Write then move: a retried or duplicate attempt never leaves a half file.
                tmp = f"{path}.{uuid.uuid4().hex}.tmp"
                with fs.open_output_stream(tmp) as f:
                    f.write(png_bytes(np.asarray(px).reshape(height, width)))
                fs.move(tmp, path)
                paths.append(path)
            yield pd.DataFrame({id_col: pdf[id_col], "path": paths})

    id_type = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, label_col, pixels_col).mapInPandas(write, f"{id_col} {id_type}, path string")


def image_id(path_col: str = "path"):
    """The file name without extension -- the example id of a written folder."""
    return file_stem(path_col)
