"""Topics as logs of files: a streaming and batch source with (topic, partition, offset) positions.

Layout, as connectors land topics::

    <path>/topic=<topic>/partition=<p>/<first offset, 20 digits>-<rows>.parquet     columns key, value, timestamp

The name alone tells which offsets a file holds, so planning is one listing and opens no file.  Rows come out with
the broker's columns: key, value (bytes), topic, partition, offset, timestamp.

Options: ``path``; ``subscribe`` (comma list of topics); ``startingOffsets`` and, for batch reads, ``endingOffsets``
(``earliest``, ``latest`` or JSON ``{"topic": {"0": n}}``); ``rowsPerPartition`` (most rows of a task, so that a hot
partition is read by many); ``maxOffsetsPerTrigger``; ``progress`` (a folder, see ``offsets.Progress``; needed for
``latest``, and for the bound to hold for the first batch after a restart).

A stream starts at ``latest`` unless told otherwise: what was there before its first start is not read.  Partitions that
appear later are read from their first offset.  Offsets that retention has removed before they were read are an error.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from verdant.sources.offsets import Progress, bounded, files_below, open_fs

SCHEMA = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
ROWS_PER_PARTITION = 1_000_000
_SEPARATOR = "\x00"  # between topic and partition in flat names


@dataclass(frozen=True)
class Segment:
    path: str
    first: int
    rows: int


@dataclass
class Span(InputPartition):
    """Rows low <= offset < high of one file."""

    path: str
    topic: str
    partition: int
    first: int
    low: int
    high: int

    def __post_init__(self):
        super().__init__(None)


def segments(path: str, topics: tuple[str, ...] | None = None) -> dict[str, list[Segment]]:
    """Segments of every partition, named topic + NUL + partition, in order of offsets and without holes."""
    scheme = path[: len(path) - len(open_fs(path)[1])]
    found = defaultdict(list)
    for info in files_below(path):
        parts = info.path.split("/")
        if len(parts) < 3 or not parts[-3].startswith("topic=") or not parts[-2].startswith("partition="):
            continue
        topic, partition = unquote(parts[-3][6:]), parts[-2][10:]
        first, _, rows = parts[-1].removesuffix(".parquet").partition("-")
        if (topics is None or topic in topics) and first.isdigit() and rows.isdigit():
            found[f"{topic}{_SEPARATOR}{partition}"].append(Segment(scheme + info.path, int(first), int(rows)))
    out = {}
    for name, parts in found.items():
        parts.sort(key=lambda s: s.first)
        whole = [parts[0]]
        for s in parts[1:]:
            if s.first != whole[-1].first + whole[-1].rows:
                break  # a later segment whose predecessor is not there yet
            whole.append(s)
        out[name] = whole
    return out


def _nested(flat: dict[str, int]) -> dict[str, dict[str, int]]:
    out = defaultdict(dict)
    for name, offset in flat.items():
        topic, _, partition = name.partition(_SEPARATOR)
        out[topic][partition] = offset
    return dict(out)


def _flat(nested: dict[str, dict[str, int]]) -> dict[str, int]:
    return {f"{topic}{_SEPARATOR}{p}": offset for topic, parts in nested.items() for p, offset in parts.items()}


class _Log:
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        names = tuple(t.strip() for t in (options.get("subscribe") or "").split(",") if t.strip())
        self.topics = names or None
        self.rows_per_task = int(options.get("rowsPerPartition") or ROWS_PER_PARTITION)

    def ends(self) -> dict[str, int]:
        return {k: s[-1].first + s[-1].rows for k, s in segments(self.path, self.topics).items()}

    def resolve(self, text: str, known: dict[str, list[Segment]]) -> dict[str, int]:
        if text == "earliest":
            return {k: s[0].first for k, s in known.items()}
        if text == "latest":
            return {k: s[-1].first + s[-1].rows for k, s in known.items()}
        return _flat(json.loads(text))

    def spans(self, start: dict[str, int], end: dict[str, int]) -> list[Span]:
        known, out = segments(self.path, self.topics), []
        for name, high in end.items():
            parts = known.get(name, [])
            low = start.get(name, parts[0].first if parts else 0)
            if low >= high:
                continue
            if not parts or parts[0].first > low or parts[-1].first + parts[-1].rows < high:
                raise ValueError(f"offsets {low} to {high} of {name.replace(_SEPARATOR, ', partition ')} are no longer all there")
            topic, _, partition = name.partition(_SEPARATOR)
            for s in parts[bisect_right([s.first for s in parts], low) - 1 :]:
                a, b = max(low, s.first), min(high, s.first + s.rows)
                out += [Span(s.path, topic, int(partition), s.first, x, min(b, x + self.rows_per_task)) for x in range(a, b, self.rows_per_task)]
        return out


def _read(span: Span) -> Iterator[pa.RecordBatch]:
    fs, path = open_fs(span.path)
    with fs.open_input_file(path) as stream:
        file, at = pq.ParquetFile(stream), span.first
        groups = []
        for g in range(file.num_row_groups):
            rows = file.metadata.row_group(g).num_rows
            if at + rows > span.low and at < span.high:
                groups.append((g, at))
            at += rows
        if not groups:
            return
        at = groups[0][1]
        for batch in file.iter_batches(row_groups=[g for g, _ in groups], columns=["key", "value", "timestamp"]):
            a, b = max(span.low - at, 0), min(span.high - at, batch.num_rows)
            if b > a:
                part, n = batch.slice(a, b - a), b - a
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").cast(pa.binary()), part.column("value").cast(pa.binary()), pa.array([span.topic] * n, pa.string()),
                     pa.array([span.partition] * n, pa.int32()), pa.array(range(at + a, at + b), pa.int64()),
                     part.column("timestamp").cast(pa.timestamp("us", "UTC"))],
                    ["key", "value", "topic", "partition", "offset", "timestamp"])
            at += batch.num_rows


class TopicLogReader(DataSourceReader):
    """Bounded read of [startingOffsets, endingOffsets), by default all there is."""

    def __init__(self, options):
        self.log = _Log(options)
        self.starting, self.ending = options.get("startingOffsets") or "earliest", options.get("endingOffsets") or "latest"

    def partitions(self) -> list[Span]:
        known = segments(self.log.path, self.log.topics)
        return self.log.spans(self.log.resolve(self.starting, known), self.log.resolve(self.ending, known)) or [Span("", "", 0, 0, 0, 0)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _read(partition) if partition.path else iter(())


class TopicLogStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.log = _Log(options)
        self.starting = options.get("startingOffsets") or "latest"
        self.limit = int(options.get("maxOffsetsPerTrigger") or 0) or None
        self.progress = Progress(options.get("progress"))
        if self.starting == "latest" and not self.progress.folder:
            raise ValueError("a stream that starts at the latest offsets needs a progress folder")
        done = self.progress.load("finished")
        self.at = _flat(done) if done is not None else None

    def initialOffset(self) -> dict:
        first = self.progress.load("initial")
        if first is None:
            first = _nested(self.log.resolve(self.starting, segments(self.log.path, self.log.topics)))
            self.progress.save("initial", first)
        self.at = _flat(first)
        return first

    def latestOffset(self) -> dict:
        ends = self.log.ends()
        if self.at is None:
            return _nested(ends)
        return _nested(self.at | bounded(self.at, ends, self.limit))

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self.at = _flat(end)
        return self.log.spans(_flat(start), self.at)

    def commit(self, end: dict) -> None:
        self.progress.save("finished", end)

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class TopicLogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topiclog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TopicLogReader:
        return TopicLogReader(self.options)

    def streamReader(self, schema: StructType) -> TopicLogStreamReader:
        return TopicLogStreamReader(self.options)
