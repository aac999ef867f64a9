"""Training metrics as a Python data source: written by executors, committed per epoch.

A row's key is (run, epoch, round, worker, batch). Every task writes its own Parquet files
and reports their names in its commit message; the driver then writes one small manifest
per (run, epoch), which replaces an earlier one. Readers take their files from manifests
only, so a failed, repeated or resumed epoch shows each key once. No metrics row passes the
driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from tessera.sources.files import Folder

FORMAT = "training_metrics"
METRICS_SCHEMA = ("run_id string, epoch int, round long, worker int, batch long, examples long, "
                  "score double, step long")
ARROW_SCHEMA = pa.schema([("run_id", pa.string()), ("epoch", pa.int32()), ("round", pa.int64()), ("worker", pa.int32()),
                          ("batch", pa.int64()), ("examples", pa.int64()), ("score", pa.float64()), ("step", pa.int64())])
MANIFESTS = "_manifests"
FILE_ROWS = 100_000


@dataclass
class Written(WriterCommitMessage):
    files: list
    rows: int


@dataclass
class MetricsFile(InputPartition):
    name: str
    run_id: str
    epoch: int


class MetricsWriter(DataSourceArrowWriter):
    """Rows of one epoch of one run; ``every`` keeps the batches divisible by it."""

    def __init__(self, options: dict):
        self.path, self.run_id, self.epoch = options["path"], options["run_id"], int(options["epoch"])
        self.every = int(options.get("every", 1))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        folder, done, waiting = Folder(self.path), Written([], 0), []

        def flush():
            if waiting:
                t = pa.concat_tables(waiting).drop_columns(["run_id", "epoch"])
                name = f"run_id={quote(self.run_id, safe='')}/epoch={self.epoch}/part-{uuid.uuid4().hex}.parquet"
                out = pa.BufferOutputStream()
                pq.write_table(t, out)
                folder.write(name, out.getvalue().to_pybytes())
                done.files.append(name)
                done.rows += t.num_rows
                waiting.clear()

        for batch in iterator:
            t = pa.Table.from_batches([batch])
            if self.every > 1:  # Arrow has no remainder: n - n // every * every
                rest = pc.subtract(t["batch"], pc.multiply(pc.divide(t["batch"], self.every), self.every))
                t = t.filter(pc.equal(rest, 0))
            if t.num_rows:
                waiting.append(t)
            if sum(w.num_rows for w in waiting) >= FILE_ROWS:
                flush()
        flush()
        return done

    def commit(self, messages: list) -> None:
        folder, name = Folder(self.path), f"{MANIFESTS}/{quote(self.run_id, safe='')}-{self.epoch:06d}.json"
        old = _manifest(folder, name)
        files = [f for m in messages if m for f in m.files]
        folder.write(name, json.dumps({"run_id": self.run_id, "epoch": self.epoch, "files": files,
                                       "rows": sum(m.rows for m in messages if m)}).encode())
        for f in old["files"] if old else []:
            folder.remove(f)

    def abort(self, messages: list) -> None:
        folder = Folder(self.path)
        for m in messages:
            for f in m.files if m else []:
                folder.remove(f)


def _manifest(folder: Folder, name: str) -> dict | None:
    if name.split("/")[1] not in folder.names(MANIFESTS):
        return None
    return json.loads(folder.read(name))


class MetricsReader(DataSourceReader):
    """One partition per committed file; options ``run_id`` and ``epoch`` choose manifests."""

    def __init__(self, options: dict):
        self.path = options["path"]
        self.wanted = {k: c(options[k]) for k, c in (("run_id", str), ("epoch", int)) if k in options}

    def partitions(self):
        folder = Folder(self.path)
        out = []
        for name in folder.names(MANIFESTS):
            m = _manifest(folder, f"{MANIFESTS}/{name}")
            if all(m[k] == v for k, v in self.wanted.items()):
                out += [MetricsFile(f, m["run_id"], m["epoch"]) for f in m["files"]]
        return out or [MetricsFile("", "", 0)]

    def read(self, partition: MetricsFile):
        if not partition.name:
            return
        t = pq.read_table(pa.BufferReader(Folder(self.path).read(partition.name)))
        columns = {"run_id": pa.array([partition.run_id] * t.num_rows, pa.string()),
                   "epoch": pa.array([partition.epoch] * t.num_rows, pa.int32()), **{c: t[c] for c in t.column_names}}
        yield from pa.table(columns).select(ARROW_SCHEMA.names).cast(ARROW_SCHEMA).to_batches()


class MetricsSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return METRICS_SCHEMA

    def writer(self, schema, overwrite):
        return MetricsWriter(self.options)

    def reader(self, schema):
        return MetricsReader(self.options)


def write_metrics(rows: DataFrame, path: str, run_id: str, epoch: int, every: int = 1) -> None:
    """Commit the metrics of one epoch (``METRICS_SCHEMA`` rows) in one Spark job."""
    rows.sparkSession.dataSource.register(MetricsSource)
    (rows.write.format(FORMAT).mode("append").option("path", path).option("run_id", run_id)
     .option("epoch", str(epoch)).option("every", str(every)).save())


def read_metrics(spark: SparkSession, path: str, run_id: str | None = None, epoch: int | None = None) -> DataFrame:
    """Committed metrics under ``path``, of one run or epoch if named (none, with the schema,
    if nothing was committed)."""
    spark.dataSource.register(MetricsSource)
    reader = spark.read.format(FORMAT).option("path", path)
    for k, v in (("run_id", run_id), ("epoch", epoch)):
        if v is not None:
            reader = reader.option(k, str(v))
    return reader.load()
