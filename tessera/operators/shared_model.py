"""One model file for all scoring workers of a host.

The parameters lie in one file in the shared folder, each array aligned. Where the folder is
a file system the host mounts, workers map the file: the pages are in memory once per host,
however many workers read them, and nothing is unpickled. Elsewhere a worker reads the file
once. ``delete_path`` on the file releases it.
"""

from __future__ import annotations

import json
import struct

import numpy as np
from pyarrow import fs as pafs
from pyspark.sql import SparkSession

from tessera.session import scratch_path
from tessera.sources.files import Folder

_ALIGN = 64
_SIZE = struct.Struct("<Q")
_OPEN: dict[str, dict] = {}  # the worker's last opened model


def share_params(spark: SparkSession, params: dict, name: str = "params") -> str:
    """Write the parameters; returns the file's path."""
    arrays, places, at = {k: np.ascontiguousarray(v) for k, v in params.items()}, [], 0
    for k, a in arrays.items():
        places.append([k, a.dtype.str, list(a.shape), at])
        at += -(-a.nbytes // _ALIGN) * _ALIGN
    head = json.dumps(places).encode()
    start = -(-(_SIZE.size + len(head)) // _ALIGN) * _ALIGN
    body = bytearray(start + at)
    body[:_SIZE.size + len(head)] = _SIZE.pack(len(head)) + head
    for (_, _, _, off), a in zip(places, arrays.values()):
        body[start + off:start + off + a.nbytes] = a.tobytes()
    path = scratch_path(spark, name)
    folder, file = path.rsplit("/", 1)
    Folder(folder).write(file, bytes(body))
    return path


def open_params(path: str) -> dict:
    """The parameters as read-only arrays, mapped where possible."""
    if path not in _OPEN:
        folder, file = path.rsplit("/", 1)
        f = Folder(folder)
        raw = np.memmap(f"{f.base}/{file}", np.uint8, "r") if isinstance(f.fs, pafs.LocalFileSystem) \
            else np.frombuffer(f.read(file), np.uint8)
        size = _SIZE.unpack(raw[:_SIZE.size].tobytes())[0]
        start = -(-(_SIZE.size + size) // _ALIGN) * _ALIGN
        out = {}
        for k, kind, shape, at in json.loads(raw[_SIZE.size:_SIZE.size + size].tobytes()):
            n = int(np.prod(shape)) * np.dtype(kind).itemsize
            out[k] = raw[start + at:start + at + n].view(kind).reshape(shape)
        _OPEN.clear()
        _OPEN[path] = out
    return _OPEN[path]
