"""Lines of files that grow: a streaming source whose position is a number of bytes for each file.

Every batch reads what was appended to known files, and new files, up to the last line end there is; a line that is
still being written waits for its end.  Ranges are split at about ``bytesPerPartition``, each task taking the lines
that begin in its range, so one large file is read by many tasks.

Options: ``path`` (a folder); ``suffix`` (files that count, default ``.csv``); ``bytesPerPartition``;
``maxBytesPerTrigger``; ``progress`` (a folder, see ``offsets.Progress``).  Columns: ``file`` (path within the folder),
``split`` (first byte of the task's range), ``position`` (the line's first byte), ``line`` (bytes, without its end).
A file that has become shorter than what was read of it is an error: it was replaced, not appended to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from verdant.sources.offsets import Progress, bounded, files_below, open_fs

SCHEMA = "file string, split long, position long, line binary"
BYTES_PER_PARTITION = 64 << 20
BLOCK = 4 << 20


@dataclass
class ByteRange(InputPartition):
    file: str
    low: int
    high: int
    whole: bool  # low is the beginning of a line

    def __post_init__(self):
        super().__init__(None)


def last_line_end(stream, low: int, high: int) -> int:
    """The place behind the last line end in [low, high); ``low`` if there is none."""
    end = high
    while end > low:
        start = max(low, end - BLOCK)
        found = stream.read_at(end - start, start).rfind(b"\n")
        if found >= 0:
            return start + found + 1
        end = start
    return low


def lines_of(stream, part: ByteRange) -> Iterator[pa.RecordBatch]:
    """Batches of the lines that begin in the range."""
    at, size = part.low, stream.size()
    if not part.whole:  # behind the first line end from the byte before the range on
        at -= 1
        while True:
            block = stream.read_at(min(BLOCK, size - at), at)
            found = block.find(b"\n")
            if found >= 0 or not block:
                at += found + 1
                break
            at += len(block)
        if not block:
            return
    held, begin = b"", at  # begin: place of the held bytes' first
    while begin < part.high:
        block = stream.read_at(min(BLOCK, size - at), at)
        if not block:
            return
        at += len(block)
        held += block
        data = np.frombuffer(held, np.uint8)
        ends = np.flatnonzero(data == 10)
        if not len(ends):
            continue
        starts = np.append(0, ends[:-1] + 1)
        own = starts + begin < part.high
        starts, ends, after = starts[own], ends[own], int(ends[-1]) + 1
        if len(starts):
            stop = ends - ((ends > starts) & (data[np.maximum(ends - 1, 0)] == 13))  # without a carriage return
            texts = [held[a:b] for a, b in zip(starts.tolist(), stop.tolist())]
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part.file] * n, pa.string()), pa.array([part.low] * n, pa.int64()), pa.array(starts + begin, pa.int64()), pa.array(texts, pa.binary())],
                ["file", "split", "position", "line"])
        if not own.all():
            return
        held, begin = held[after:], begin + after


class GrowingLinesReader(DataSourceStreamReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.suffix = options.get("suffix") or ".csv"
        self.bytes = int(options.get("bytesPerPartition") or BYTES_PER_PARTITION)
        self.limit = int(options.get("maxBytesPerTrigger") or 0) or None
        self.progress = Progress(options.get("progress"))
        self.at = self.progress.load("finished")

    def initialOffset(self) -> dict:
        self.at = {}
        return {}

    def latestOffset(self) -> dict:
        fs, root = open_fs(self.path)
        at, ends = self.at or {}, {}
        for info in files_below(self.path):
            name = info.path[len(root) + 1 :]
            if not name.endswith(self.suffix):
                continue
            if info.size < at.get(name, 0):
                raise ValueError(f"{name} has {info.size} bytes, of which {at[name]} had been read: not appended to but replaced")
            ends[name] = info.size
        if self.at is not None:
            ends = at | bounded(at, ends, self.limit)
        out = {}
        for name, size in ends.items():
            out[name] = at.get(name, 0)
            if size > out[name]:
                with fs.open_input_file(f"{root}/{name}") as stream:
                    out[name] = last_line_end(stream, out[name], size)
                    while out[name] == at.get(name, 0) and size < stream.size():  # a line longer than the bound
                        size = min(stream.size(), size + BLOCK)
                        out[name] = last_line_end(stream, out[name], size)
        return out

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        self.at = end
        return [ByteRange(name, a, min(high, a + self.bytes), a == start.get(name, 0))
                for name, high in sorted(end.items()) for a in range(start.get(name, 0), high, self.bytes)]

    def commit(self, end: dict) -> None:
        self.progress.save("finished", end)

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(self.path)
        with fs.open_input_file(f"{root}/{partition.file}") as stream:
            yield from lines_of(stream, partition)


class GrowingLinesSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "growinglines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> GrowingLinesReader:
        return GrowingLinesReader(self.options)
