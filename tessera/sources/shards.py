"""Image shards: many images a file, read by byte range.

A shard is image bodies one after another, then an index (Arrow: path, kind, offset, size,
crc32), then the index's length and a mark. A body is a PNG file, or ``raw`` pixels behind
their height, width and channels (how a folder's JPEG images are packed once Spark has
decoded them). Executors write the shards and report their names and sizes; the manifest,
written last, makes them visible.

The reader plans partitions as byte ranges of the shards from the manifest alone: the
driver never sees an entry. A task reads its shard's index, keeps the entries that start in
its range and pass the extension and label filters, and reads only their bytes, runs of
neighbouring entries in one request.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from tessera.sources.files import Folder

FORMAT = "image_shards"
SCHEMA = "path string, label string, height int, width int, n_channels int, mode int, data binary"
ENTRY = "path string, kind string, body binary"
MANIFEST = "_shards.json"
MARK = b"shard-01"
SHARD_BYTES = 128 << 20
RANGE_BYTES = 32 << 20
READ_BYTES = 4 << 20  # most bytes read at once, but for a larger image
_TAIL = struct.Struct("<Q8s")
_RAW = struct.Struct("<iii")
_INDEX = pa.schema([("path", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("size", pa.int64()), ("crc32", pa.int64())])
# OpenCV type numbers of 8-bit images by channels, as Spark's image source gives them.
MODES = {1: 0, 3: 16, 4: 24}
INVALID = (-1, -1, -1, -1, b"")


# -- image bodies -------------------------------------------------------------

def decode_png(body: bytes) -> np.ndarray:
    """8-bit grey, RGB or RGBA PNG without interlace as ``[H, W, C]`` in file order."""
    if body[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG file")
    at, raw, head = 8, [], None
    while at + 12 <= len(body):
        size, tag = struct.unpack_from(">I4s", body, at)
        if tag == b"IHDR":
            head = struct.unpack_from(">IIBBBBB", body, at + 8)
        elif tag == b"IDAT":
            raw.append(body[at + 8:at + 8 + size])
        at += 12 + size
    if head is None:
        raise ValueError("a PNG without a header")
    w, h, depth, colour, _, _, interlace = head
    channels = {0: 1, 2: 3, 6: 4}.get(colour)
    if depth != 8 or channels is None or interlace:
        raise ValueError("this kind of PNG is not read")
    rows = np.frombuffer(zlib.decompress(b"".join(raw)), np.uint8).reshape(h, 1 + w * channels)
    if not rows[:, 0].any():  # no row filters
        return rows[:, 1:].reshape(h, w, channels)
    out = np.zeros((h + 1, w + 1, channels), np.int64)  # with a zero row above and a zero pixel before
    for y in range(1, h + 1):
        kind, line = rows[y - 1, 0], rows[y - 1, 1:].reshape(w, channels).astype(np.int64)
        up = out[y - 1]
        if kind == 0:
            out[y, 1:] = line
        elif kind == 1:
            out[y, 1:] = np.cumsum(line, axis=0)
        elif kind == 2:
            out[y, 1:] = line + up[1:]
        else:  # 3: mean of left and above; 4: the nearest of left, above, corner to their prediction
            for x in range(1, w + 1):
                left, above, corner = out[y, x - 1], up[x], up[x - 1]
                if kind == 3:
                    guess = (left + above) // 2
                else:
                    p = left + above - corner
                    a, b, c = abs(p - left), abs(p - above), abs(p - corner)
                    guess = np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))
                out[y, x] = (line[x - 1] + guess) & 255
        out[y] &= 255
    return out[1:, 1:].astype(np.uint8)


def decode(kind: str, body: bytes) -> tuple:
    """(height, width, n_channels, mode, data) with BGR order; an unreadable body is invalid."""
    try:
        if kind == "raw":
            h, w, c = _RAW.unpack_from(body)
            return (h, w, c, MODES[c], body[_RAW.size:]) if len(body) == _RAW.size + h * w * c else INVALID
        px = decode_png(body)
    except (ValueError, KeyError, zlib.error, struct.error):
        return INVALID
    if px.shape[2] >= 3:
        px = px[:, :, [2, 1, 0, *range(3, px.shape[2])]]
    return (*px.shape, MODES[px.shape[2]], px.tobytes())


def raw_body(height: int, width: int, channels: int, data: bytes) -> bytes:
    return _RAW.pack(height, width, channels) + data


# -- writing --------------------------------------------------------------------

@dataclass
class Shards(WriterCommitMessage):
    files: list  # [name, bytes of bodies, entries]


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.shard_bytes = options["path"], int(options.get("shard_bytes", SHARD_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shards:
        folder, out = Folder(self.path), Shards([])
        bodies, index, size = [], [], 0

        def flush():
            nonlocal size
            if index:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _INDEX) as w:
                    w.write_table(pa.table([pa.array(c, f.type) for c, f in zip(zip(*index), _INDEX)], schema=_INDEX))
                entries = sink.getvalue().to_pybytes()
                name = f"{uuid.uuid4().hex}.shard"
                folder.write(name, b"".join([*bodies, entries, _TAIL.pack(len(entries), MARK)]))
                out.files.append([name, size, len(index)])
            bodies.clear()
            index.clear()
            size = 0

        for batch in iterator:
            for path, kind, body in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("path", "kind", "body"))):
                body = body or b""
                index.append((path, kind, size, len(body), zlib.crc32(body)))
                bodies.append(body)
                size += len(body)
                if size >= self.shard_bytes:
                    flush()
        flush()
        return out

    def commit(self, messages: list) -> None:
        files = [f for m in messages if m for f in m.files]
        Folder(self.path).write(MANIFEST, json.dumps({"files": files}).encode())

    def abort(self, messages: list) -> None:
        for m in messages:
            for name, _, _ in m.files if m else []:
                Folder(self.path).remove(name)


def write_shards(entries: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Pack ``ENTRY`` rows into a new folder of shards."""
    entries.sparkSession.dataSource.register(ShardSource)
    (entries.select("path", "kind", "body").write.format(FORMAT).mode("append").option("path", path)
     .option("shard_bytes", str(shard_bytes)).save())


def pack_folder(images: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Pack decoded images (``images.read_images``) as raw pixels; an undecodable one stays invalid."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in ("path", "height", "width", "n_channels", "data")))
            out = [(p, "raw", raw_body(h, w, c, d) if h and h > 0 else b"") for p, h, w, c, d in rows]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else ((), (), ()), (pa.string(), pa.string(), pa.binary()))],
                                  ["path", "kind", "body"])

    write_shards(images.select("path", "height", "width", "n_channels", "data").mapInArrow(pack, ENTRY), path, shard_bytes)


# -- reading --------------------------------------------------------------------

@dataclass
class ByteRange(InputPartition):
    name: str
    lo: int
    hi: int


class ShardReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.range_bytes = options["path"], int(options.get("range_bytes", RANGE_BYTES))
        self.extensions = tuple(json.loads(options["extensions"])) if "extensions" in options else None
        self.labels = set(json.loads(options["labels"])) if "labels" in options else None

    def partitions(self):
        out = []
        for name, size, _ in json.loads(Folder(self.path).read(MANIFEST))["files"]:
            cuts = list(range(0, max(size, 1), self.range_bytes))
            out += [ByteRange(name, lo, hi) for lo, hi in zip(cuts, [*cuts[1:], size + 1])]  # + 1: empty bodies at the end
        return out or [ByteRange("", 0, 0)]

    def _wanted(self, path: str) -> bool:
        if self.extensions is not None and not path.endswith(self.extensions):
            return False
        parts = path.split("/")
        return self.labels is None or (len(parts) > 1 and parts[-2] in self.labels)

    def read(self, partition: ByteRange):
        if not partition.name:
            return
        folder = Folder(self.path)
        size = folder.fs.get_file_info(f"{folder.base}/{partition.name}").size
        length, mark = _TAIL.unpack(folder.read(partition.name, size - _TAIL.size, _TAIL.size))
        if mark != MARK:
            raise ValueError(f"{partition.name} is no image shard")
        index = pa.ipc.open_stream(folder.read(partition.name, size - _TAIL.size - length, length)).read_all()
        entries = [e for e in zip(*(c.to_pylist() for c in index.columns))
                   if partition.lo <= e[2] < partition.hi and self._wanted(e[0])]
        run: list = []
        for e in entries:
            if run and (e[2] != run[-1][2] + run[-1][3] or e[2] + e[3] - run[0][2] > READ_BYTES):
                yield self._batch(folder, partition.name, run)
                run = []
            run.append(e)
        if run:
            yield self._batch(folder, partition.name, run)

    def _batch(self, folder: Folder, name: str, run: list) -> pa.RecordBatch:
        start = run[0][2]
        raw = folder.read(name, start, run[-1][2] + run[-1][3] - start) if run[-1][2] + run[-1][3] > start else b""
        rows = []
        for path, kind, at, size, crc in run:
            body = raw[at - start:at - start + size]
            if len(body) != size or zlib.crc32(body) != crc:
                raise ValueError(f"{path} in {name} is damaged")
            parts = path.split("/")
            rows.append((path, parts[-2] if len(parts) > 1 else None, *decode(kind, body)))
        types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in SCHEMA.split(", ")])


class ShardSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def writer(self, schema, overwrite):
        return ShardWriter(self.options)

    def reader(self, schema):
        return ShardReader(self.options)


def read_shards(spark: SparkSession, path: str, extensions: list[str] | None = (".jpg",), labels: list[str] | None = None,
                drop_invalid: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Decoded images of a shard folder with the columns of ``images.read_images``.

    ``extensions`` (case-sensitive) and ``labels`` are applied to the shards' indexes, before any
    image is read; None takes all. An undecodable image gives height = width = -1 unless ``drop_invalid``."""
    spark.dataSource.register(ShardSource)
    reader = spark.read.format(FORMAT).option("path", path).option("range_bytes", str(range_bytes))
    for k, v in (("extensions", extensions), ("labels", labels)):
        if v is not None:
            reader = reader.option(k, json.dumps(list(v)))
    df = reader.load()
    return df.filter(F.col("height") > 0) if drop_invalid else df
