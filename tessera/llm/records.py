"""Length-delimited binary records of token ids, with an offset index.

A record is framed as

    length u64 | masked checksum of the length u32 | payload | masked checksum of the payload u32 | line feed

and its payload as ``has id u8 | doc_id i64 | bytes per token u8 | token ids``, all
little-endian. Checksums are CRC-32, masked by rotating right 15 bits and adding a
constant, so that a checksum of data that holds checksums is still good. The line feed
is what Spark's text writer puts after each row: files go through Spark's own output
committer on whatever store the path names, so a retried or duplicate task leaves no
half-written or doubled file.

The offset index is a table beside the records, made by reading the written files back:
file, place in the file, byte offset and size, doc_id, number of tokens, tokens before it in
its file and the checksum of its ids. ``read_selected`` uses it for shuffled reads.

At scale: one range exchange by doc_id puts the texts in order; tokenizing, framing and
writing follow in the same tasks. The number of files follows the bytes of text, so a file
(read whole by ``binaryFile``) stays near ``FILE_BYTES``. Only per-file totals (one row a
file) meet for the running start.

Defined cases: NULL text counts as empty (one token, the end id); rows with equal doc_id
are all written, in order of text; a NULL doc_id sorts first; an empty table writes no
record; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import text_of
from tessera.llm.tokens import batches, encoder
from tessera.session import scratch_path

END_ID = 0
FILE_BYTES = 32 << 20
MASK_DELTA = 0xA282EAD8  # fixed value of the checksum mask


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    payload = (struct.pack("<BqB", doc_id is not None, doc_id or 0, width)
               + ids.astype("<u2" if width == 2 else "<u4").tobytes())
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def unframe(data: memoryview, at: int) -> tuple[int | None, np.ndarray, int]:
    """Record at byte ``at``: doc_id, ids (uint32) and where the next one begins."""
    size = bytes(data[at:at + 8])
    n, check = struct.unpack("<QI", data[at:at + 12])
    if check != masked(size):
        raise ValueError(f"damaged record length at byte {at}")
    payload = bytes(data[at + 12:at + 12 + n])
    if len(payload) != n or struct.unpack("<I", data[at + 12 + n:at + 16 + n])[0] != masked(payload):
        raise ValueError(f"damaged record at byte {at}")
    has, doc, width = struct.unpack_from("<BqB", payload)
    ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4", offset=10).astype("<u4")
    return doc if has else None, ids, at + 17 + n


def write_records(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                  id_col: str = "doc_id", text_col: str = "text", file_bytes: int = FILE_BYTES) -> None:
    """Encode, append ``end_id`` and write in ascending doc_id order."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(docs[text_col]).alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        width = 2 if enc.tokenizer.get_vocab_size() <= 1 << 16 else 4
        for batch in rows:
            doc, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in batches(texts):
                out = [frame(d, np.append(ids, np.uint32(end_id)), width)
                       for d, ids in zip(doc[a:b], enc.encode(texts[a:b]))]
                yield pa.record_batch([pa.array(out, pa.binary())], ["record"])

    (own.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.mode("overwrite").text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Files with their number in doc_id order."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(
        F.regexp_extract("path", r"part-(\d+)", 1).cast("long").alias("file"), "path", "content")


def read_records(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per record: file, place, offset, bytes, doc_id, n_tokens, before (tokens of
    earlier records of its file), ids_crc32 and, on request, ids (uint32 bytes).
    Damaged records fail."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = memoryview(content.as_buffer())
                at = place = before = 0
                out: list[tuple] = []
                while at < len(data):
                    doc, ids, end = unframe(data, at)
                    raw = ids.tobytes()
                    out.append((file, place, at, end - at, doc, len(ids), before, zlib.crc32(raw), raw if with_ids else None))
                    at, place, before = end, place + 1, before + len(ids)
                    if len(out) == 1000:
                        yield _batch(out)
                        out = []
                if out:
                    yield _batch(out)
    return _files(spark, path).select("file", "content").mapInArrow(
        run, "file long, place long, offset long, bytes long, doc_id long, n_tokens long, before long, "
             "ids_crc32 long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["file", "place", "offset", "bytes", "doc_id", "n_tokens", "before", "ids_crc32", "ids"]
    kinds = [pa.int64()] * 8 + [pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def write_index(spark: SparkSession, records: str, index: str) -> DataFrame:
    """The offset index of a folder of records, written to ``index``."""
    read_records(spark, records, with_ids=False).drop("ids").write.mode("overwrite").parquet(index)
    return spark.read.parquet(index)


def read_selected(spark: SparkSession, records: str, wanted: DataFrame) -> DataFrame:
    """doc_id, ids of the records that the index rows ``wanted`` name, in any order."""
    cut = wanted.select("file", "offset", "bytes").join(_files(spark, records), "file").select(
        F.substring("content", (F.col("offset") + 1).cast("int"), F.col("bytes").cast("int")).alias("record"))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            got = [unframe(memoryview(r), 0) for r in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array([g[0] for g in got], pa.int64()),
                                   pa.array([g[1].tobytes() for g in got], pa.binary())], ["doc_id", "ids"])
    return cut.mapInArrow(run, "doc_id long, ids binary")


def encode_to_records(docs: DataFrame, tokenizer_path: str, path: str | None = None, **kw) -> DataFrame:
    """Write records and read them back into the index. Per document: doc_id,
    start, n_tokens, ids_crc32, file, offset, all from the files."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "llm-records")
    write_records(docs, f"{path}/data", tokenizer_path, **kw)
    index = write_index(spark, f"{path}/data", f"{path}/index")
    per_file = index.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select(F.col("file").alias("_file"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    return (index.join(F.broadcast(starts), F.col("file") == F.col("_file"))  # one row a file
            .select("doc_id", (F.col("_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "file", "offset"))
