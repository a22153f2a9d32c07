"""What the streaming sources written in Python share: file access from any process, and remembered offsets.

A Python data source plans on the driver and reads in Python workers, where Spark's own file systems are out of
reach, so files are read through ``pyarrow.fs`` (local and mounted paths, s3, gs, abfs, hdfs).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow.fs as pafs


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path on it) of a path or URI."""
    if "://" in path or path.startswith("file:"):
        head, _, rest = path.partition(":")
        return pafs.FileSystem.from_uri(f"{head}://{rest}" if not rest.startswith("//") else path)
    return pafs.LocalFileSystem(), path


def files_below(path: str) -> Iterator[pafs.FileInfo]:
    """Files under a folder in order of their paths, hidden ones and those in hidden folders left out."""
    fs, root = open_fs(path)
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True))
    for info in sorted(found, key=lambda i: i.path):
        inside = info.path[len(root.rstrip("/")) + 1 :]
        if info.type == pafs.FileType.File and not any(p.startswith(("_", ".")) for p in inside.split("/")):
            yield info


class Progress:
    """Offsets that a query keeps beside Spark's own: where it began, and what it has finished.

    Spark keeps no initial offset before the first batch has run; without this, a query that starts at the end of a
    source and finds nothing new would begin at a later end after a restart.  The folder belongs inside the query's
    checkpoint, so both are dropped together.
    """

    def __init__(self, folder: str | None):
        self.folder = folder

    def load(self, name: str) -> dict | None:
        if not self.folder:
            return None
        fs, root = open_fs(self.folder)
        if fs.get_file_info(f"{root}/{name}.json").type != pafs.FileType.File:
            return None
        with fs.open_input_stream(f"{root}/{name}.json") as stream:
            return json.loads(stream.read())

    def save(self, name: str, offsets: dict) -> None:
        if not self.folder:
            return
        fs, root = open_fs(self.folder)
        fs.create_dir(root, recursive=True)
        part = f"{root}/_{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as stream:
            stream.write(json.dumps(offsets).encode())
        fs.move(part, f"{root}/{name}.json")


def bounded(start: dict[str, int], end: dict[str, int], limit: int | None) -> dict[str, int]:
    """``end``, or as far towards it that at most about ``limit`` is new, shared out in proportion to what each part has."""
    lag = {k: end[k] - start.get(k, 0) for k in end}
    total = sum(lag.values())
    if not limit or total <= limit:
        return end
    return {k: start.get(k, 0) + min(lag[k], max(1, limit * lag[k] // total)) if lag[k] > 0 else end[k] for k in end}
