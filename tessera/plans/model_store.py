"""Versioned model store: data first, manifest last.

``data/<name>/`` holds a model's chunks as Parquet, written by executors; ``versions/`` one
sealed manifest per version: the spec, the step, where the data is, and the length and
checksum of every chunk as read back from storage. A save that dies half-way leaves data
without a manifest, which no reader looks at. A reader takes a version only if its manifest
is whole and all its chunks are there and match.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.models import NetSpec, spec_from_json, spec_to_json
from tessera.session import collect_arrow
from tessera.sources.files import Folder, sealed, unsealed

VERSIONS = "versions"
CHUNK_COLUMNS = "param string, chunk int, values binary"


def versions(path: str) -> dict[int, dict]:
    """Manifests by version number; damaged ones count as absent."""
    folder, found = Folder(path), {}
    for name in folder.names(VERSIONS):
        try:
            m = json.loads(unsealed(folder.read(f"{VERSIONS}/{name}")))
        except ValueError:
            continue
        found[m["version"]] = m
    return found


def _listed(chunks: DataFrame) -> DataFrame:
    return chunks.select("param", "chunk", F.length("values").alias("size"), F.crc32("values").alias("crc32"))


def save_version(spark: SparkSession, spec: NetSpec, chunks: DataFrame, step: int, path: str, info: dict | None = None) -> int:
    """Save ``chunks`` (``CHUNK_COLUMNS``, doubles as bytes) as the next version; returns its number."""
    data = f"data/{uuid.uuid4().hex}"
    chunks.write.parquet(f"{path}/{data}")
    listed = [list(r) for r in _listed(spark.read.parquet(f"{path}/{data}")).orderBy("param", "chunk").collect()]
    number = max(versions(path), default=0) + 1
    body = {"version": number, "data": data, "step": step, "spec": spec_to_json(spec), "chunks": listed, "info": info or {}}
    # The name is unique: a save at the same time never replaces this one.
    Folder(path).write(f"{VERSIONS}/{number:08d}-{uuid.uuid4().hex[:8]}.json", sealed(json.dumps(body).encode()))
    return number


def open_version(spark: SparkSession, path: str, version: int | None = None) -> tuple[NetSpec, dict, list]:
    """``(spec, manifest, rows of (param, chunk, values))`` of a version (the newest by default)."""
    known = versions(path)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"no complete model version {'' if version is None else version} under {path}")
    m = known[max(known) if version is None else version]
    stored = spark.read.schema(CHUNK_COLUMNS).parquet(f"{path}/{m['data']}")
    rows = collect_arrow(stored.withColumn("crc32", F.crc32("values")))  # one model
    have = {(r.param, int(r.chunk), len(r.values), int(r.crc32)) for r in rows.itertuples(index=False)}
    if have != {tuple(c) for c in m["chunks"]}:
        raise ValueError(f"version {m['version']} under {path} does not match its manifest")
    return spec_from_json(m["spec"]), m, [(r.param, int(r.chunk), np.frombuffer(r.values, np.float64)) for r in rows.itertuples(index=False)]


def delete_version(spark: SparkSession, path: str, version: int) -> None:
    """Forget a version: its manifests first, then its data."""
    folder = Folder(path)
    data = versions(path)[version]["data"]
    for name in folder.names(VERSIONS):
        if name.startswith(f"{version:08d}-"):
            folder.remove(f"{VERSIONS}/{name}")
    folder.remove(data)
