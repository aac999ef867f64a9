"""Session helpers: building a session for local runs, finding the shared
checkpoint folder, and cutting lineage by writing a table there."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Tensors are wide (30,000 values for a 100x100x3 image); keep Arrow batches
# small enough that one batch of rows stays far below executor memory. Spark
# also caps a batch by bytes (spark.sql.execution.arrow.maxBytesPerBatch,
# 64 MB by default), which bounds batches of large decoded images.
ARROW_BATCH_ROWS = 1024


def build_session(master: str | None = None, app: str = "tessera",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, the caller passes its
    own session and nothing here is needed."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(ARROW_BATCH_ROWS),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, as
    ``--py-files`` would: the closures of the Arrow operators refer to its
    modules. Zipped and added once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-pyfiles-"), "tessera.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only when neither is set and the master is a single local
    process (``local`` or ``local[n]``; not ``local-cluster``) a fresh temporary folder is made and registered;
    on a cluster that is an error."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            # A machine-local folder would split files across hosts on a cluster.
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None,
                path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder (or ``path``) and
    read it back.

    Cuts lineage and survives executor loss: a later stage that loses a
    block re-reads the file instead of recomputing upstream work."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursively delete a scratch folder on whatever filesystem holds it."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _with_arrow(spark: SparkSession, fn):
    key = "spark.sql.execution.arrow.pyspark.enabled"
    old = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        return fn()
    finally:
        spark.conf.set(key, old)


def create_arrow(spark: SparkSession, pdf, schema: str) -> DataFrame:
    """A DataFrame from a pandas frame through Arrow (NumPy arrays stay
    arrays; no per-element Python objects). For driver data of a known,
    bounded size, such as one model."""
    return _with_arrow(spark, lambda: spark.createDataFrame(pdf, schema))


def collect_arrow(df: DataFrame):
    """``df`` as a pandas frame through Arrow (much faster than ``collect()``
    for large binary rows such as model chunks). Only for results of a
    known, bounded size."""
    return _with_arrow(df.sparkSession, df.toPandas)
