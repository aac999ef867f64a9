"""Small files in a shared folder, read and written from tasks and from the driver.

Any filesystem pyarrow opens by URI. Files appear whole or not at all: they are written
under a temporary name and moved.
"""

from __future__ import annotations

import struct
import uuid
import zlib

from pyarrow import fs as pafs

_HEAD = struct.Struct("<QI")  # bytes of the body, its crc32


def filesystem(root: str):
    """``(filesystem, path)`` of a folder given as a path or URI."""
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root[len("file:"):].lstrip("/")
    if "://" in root:
        return pafs.FileSystem.from_uri(root)
    return pafs.LocalFileSystem(), root


class Folder:
    """One folder's files by name (``a/b`` for sub-folders)."""

    def __init__(self, root: str):
        self.fs, self.base = filesystem(root.rstrip("/"))
        self._made: set = set()

    def write(self, name: str, body: bytes) -> None:
        """Write a file atomically; an older one of that name is replaced."""
        path = f"{self.base}/{name}"
        folder = path.rsplit("/", 1)[0]
        if folder not in self._made:
            self.fs.create_dir(folder, recursive=True)
            self._made.add(folder)
        tmp = f"{folder}/_{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(tmp) as f:
            f.write(body)
        self.fs.move(tmp, path)

    def read(self, name: str, start: int = 0, size: int | None = None) -> bytes:
        """A file, or ``size`` bytes of it from ``start``."""
        path = f"{self.base}/{name}"
        if size is None:
            with self.fs.open_input_stream(path) as f:
                return f.read()[start:]
        with self.fs.open_input_file(path) as f:
            return f.read_at(size, start)

    def names(self, folder: str = "") -> list[str]:
        """Names in a sub-folder (files and folders, temporary ones left out)."""
        at = f"{self.base}/{folder}".rstrip("/")
        found = self.fs.get_file_info(pafs.FileSelector(at, allow_not_found=True))
        return sorted(i.base_name for i in found if not i.base_name.endswith(".tmp"))

    def remove(self, name: str) -> None:
        """Delete a file or a folder if it is there."""
        path = f"{self.base}/{name}"
        kind = self.fs.get_file_info(path).type
        if kind == pafs.FileType.Directory:
            self.fs.delete_dir(path)
        elif kind == pafs.FileType.File:
            self.fs.delete_file(path)


def sealed(body: bytes) -> bytes:
    """The body behind its length and checksum."""
    return _HEAD.pack(len(body), zlib.crc32(body)) + body


def unsealed(raw: bytes) -> bytes:
    """The body of ``sealed`` bytes; a short or damaged one is an error."""
    size, crc = _HEAD.unpack_from(raw)
    body = raw[_HEAD.size:]
    if len(body) != size or zlib.crc32(body) != crc:
        raise ValueError("a file is damaged or cut off")
    return body


HEAD_BYTES = _HEAD.size
