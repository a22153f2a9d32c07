"""Idempotent keyed tables on plain parquet: one folder per commit, last commit wins.

Layout::

    <root>/data/commit=<id>/part-*.parquet        rows of one commit (or of one base)
    <root>/_log/<entry>                            one empty file per commit, one small file per base

A write goes to a fresh data folder first; the rows count once their log entry exists.  The entry's name holds a
sequence number allotted at commit time by creating the file only if no other writer has that number, so the order of
commits is the order of writes, whichever process started first.  Per primary key the row of the greatest
(priority, sequence) is current: backfills have priority 0, all other writers 1.

A batch is known by (writer, batch id).  Writing it again (a stream that replays after a crash) replaces its rows
under its first sequence number, so nothing written since is outranked.

:meth:`UpsertTable.compact` writes the current rows as a base, each with the priority and sequence of its commit.  Its
entry names the *set* of commits it covers; every commit outside the set stays live, however it was numbered.
:meth:`UpsertTable.expire` removes covered commits and older bases after a grace period for readers.

Rows keep their key columns as data ('' and NULL stay apart).  Files are range-partitioned and sorted by the table's
partition column and clustering order, so their min/max statistics prune key and time filters, and a key that holds
most rows is split over many files.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.functions.decode import utc_instant
from verdant.operators.latest import latest_by_key
from verdant.schemas import TableSpec
from verdant.session import new_run_id

log = logging.getLogger(__name__)

NORMAL, BACKFILL = 1, 0
VERSION = ("priority", "sequence", "entry")
VERSION_FIELDS = [T.StructField("priority", T.IntegerType()), T.StructField("sequence", T.LongType()),
                  T.StructField("entry", T.LongType())]
#: Compact a streamed table after so many of its micro-batches unless told otherwise.
COMPACT_EVERY = 50
#: Covered commits and older bases stay readable for so long; what a crashed write left behind goes after it, too.
GRACE_SECONDS = 24 * 3600
#: A stream that has written nothing for so long has ended: its last batch is not kept for a replay.
LIVE_SECONDS = 7 * 24 * 3600
#: Marks the digests of streams' names in the log.
STREAM_MARK = "s-"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _fs(spark, path)
    return fs.exists(hpath)


@dataclass(frozen=True, order=True)
class Entry:
    """One entry of the log; ``number`` is its place in the log, ``sequence`` what its rows are ranked by."""

    number: int
    kind: str  # "commit" or "base"
    priority: int
    sequence: int
    batch: int
    writer: str  # digest of the writer's name
    commit: str
    time_ms: int = field(default=0, compare=False)

    @property
    def name(self) -> str:
        return f"{self.number:020d}.{self.kind}.{self.priority}.{self.sequence:020d}.{self.batch}.{self.writer}.{self.commit}"

    @staticmethod
    def parse(name: str, time_ms: int) -> Entry | None:
        parts = name.split(".")
        if len(parts) != 7 or not parts[0].isdigit():
            return None
        return Entry(int(parts[0]), parts[1], int(parts[2]), int(parts[3]), int(parts[4]), parts[5], parts[6], time_ms)


def _digest(name: str) -> str:
    return hashlib.md5(name.encode()).hexdigest()[:16]


class UpsertTable:
    def __init__(self, root: str, spec: TableSpec, run_id: str | None = None,
                 report: Callable[[str, int, int], None] | None = None, compact_every: int | None = None,
                 priority: int = NORMAL):
        self.root = root.rstrip("/")
        self.spec = spec
        #: The writer's name; with the batch id it makes a repeated write known.
        self.run_id = run_id or new_run_id()
        self.report = report
        # compact after every N-th micro-batch (None = never from the stream)
        self.compact_every = compact_every
        self.priority = priority
        self._is_stream = False

    @property
    def _writer(self) -> str:
        return (STREAM_MARK if self._is_stream else "") + _digest(self.run_id)

    @property
    def version_schema(self) -> T.StructType:
        return T.StructType(list(self.spec.schema.fields) + VERSION_FIELDS)

    # --------------------------------------------------------------- log

    @property
    def log_root(self) -> str:
        return f"{self.root}/_log"

    def data_path(self, commit: str) -> str:
        return f"{self.root}/data/commit={commit}"

    def entries(self, spark: SparkSession) -> list[Entry]:
        """The log in order (one listing; compaction and expiry keep it short)."""
        hpath, fs = _fs(spark, self.log_root)
        if not fs.exists(hpath):
            return []
        found = (Entry.parse(st.getPath().getName(), st.getModificationTime()) for st in fs.listStatus(hpath))
        return sorted(e for e in found if e is not None)

    def _claim(self, spark: SparkSession, number: int) -> bool:
        """Take a place in the log; False when another writer has it."""
        hpath, fs = _fs(spark, f"{self.log_root}/{number:020d}.claim")
        try:
            fs.create(hpath, False).close()
        except Exception as e:  # noqa: BLE001 - the JVM's own error classes
            if "already exists" in str(e) or "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def _append(self, spark: SparkSession, kind: str, priority: int, sequence: int | None, batch: int, commit: str,
                covers: Sequence[str] = ()) -> Entry:
        """Publish a finished data folder: claim the next place, then create the entry by one atomic rename."""
        number = max((e.number for e in self.entries(spark)), default=0) + 1
        while not self._claim(spark, number):
            number += 1
        entry = Entry(number, kind, priority, number if sequence is None else sequence, batch, self._writer, commit)
        part, fs = _fs(spark, f"{self.log_root}/_{uuid.uuid4().hex}")
        out = fs.create(part, False)
        out.write(bytearray(json.dumps({"covers": list(covers)}).encode()))
        out.close()
        if not fs.rename(part, _fs(spark, f"{self.log_root}/{entry.name}")[0]):
            raise OSError(f"cannot publish {entry.name} in {self.log_root}")
        return entry

    def _covers(self, spark: SparkSession, base: Entry) -> set[str]:
        hpath, fs = _fs(spark, f"{self.log_root}/{base.name}")
        stream = fs.open(hpath)
        try:
            return set(json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["covers"])
        finally:
            stream.close()

    def _live(self, spark: SparkSession) -> tuple[Entry | None, list[Entry]]:
        """(current base, commits it does not cover), of a batch written again only the last entry under the first sequence."""
        entries = self.entries(spark)
        base = max((e for e in entries if e.kind == "base"), default=None)
        covered = self._covers(spark, base) if base else set()
        last: dict[tuple[str, int], Entry] = {}
        for e in entries:
            if e.kind == "commit":
                last[e.writer, e.batch] = e
        return base, [e for e in last.values() if e.commit not in covered]

    # ------------------------------------------------------------ writes

    def _dealt(self, df: DataFrame) -> DataFrame:
        """Range partitions of (partition column, clustering order), sorted: few keys or many, no task gets them all."""
        spec = self.spec
        order = [F.col(spec.partition_column)] + [F.col(c).asc() if asc else F.col(c).desc() for c, asc in spec.sort_order]
        return df.repartitionByRange(*order).sortWithinPartitions(*order)

    def _typed(self, df: DataFrame) -> DataFrame:
        out = []
        for f in self.spec.schema.fields:
            c = F.col(f.name)
            if isinstance(f.dataType, T.TimestampType) and isinstance(df.schema[f.name].dataType, T.TimestampNTZType):
                c = utc_instant(c)  # a naive time is a UTC wall clock
            out.append(c.cast(f.dataType).alias(f.name))
        return df.select(*out)

    def _sorted(self, df: DataFrame) -> DataFrame:
        """Each partition as it is, sorted: one pass over the rows, files merged by the next compaction."""
        order = [F.col(self.spec.partition_column)] + [F.col(c).asc() if asc else F.col(c).desc() for c, asc in self.spec.sort_order]
        most = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # as many as a stateful aggregation has
        return df.coalesce(most).sortWithinPartitions(*order)

    def write_batch(self, df: DataFrame, batch_id: int, observe: bool = True) -> int | None:
        """Write one batch and commit it; the same batch of the same writer again replaces it.
        Returns the number of rows written (observed during the write, no extra job)."""
        return self._write(self._dealt(self._typed(df)), int(batch_id), observe)

    def _write(self, out: DataFrame, batch_id: int, observe: bool = True, skip_empty: bool = False) -> int | None:
        """Write rows to a folder of their own, then commit it; with ``skip_empty`` a folder without rows goes instead."""
        spark = out.sparkSession
        observed = Observation(f"rows_{self.spec.name}") if observe else None
        if observed is not None:  # after the range partitions, whose bounds take a pass of their own
            out = out.observe(observed, F.count(F.lit(1)).alias("rows"))
        commit = uuid.uuid4().hex
        out.write.parquet(self.data_path(commit))
        rows = int(observed.get["rows"]) if observed is not None else None
        if skip_empty and rows == 0:
            hpath, fs = _fs(spark, self.data_path(commit))
            fs.delete(hpath, True)
            return 0
        earlier = [e for e in self.entries(spark)
                   if e.kind == "commit" and (e.writer, e.batch) == (self._writer, batch_id)]
        self._append(spark, "commit", self.priority, min((e.sequence for e in earlier), default=None), batch_id, commit)
        return rows

    def foreach_batch(self) -> Callable[[DataFrame, int], None]:
        """Micro-batch callback: one job writes the batch and counts it; an empty one leaves nothing.

        The rows stay in the partitions of the stateful aggregation, so it runs once and nothing is cached.
        """
        def write(batch_df: DataFrame, batch_id: int) -> None:
            # the query's id stays the same over restarts from its checkpoint, and is new with a new one
            query = batch_df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
            if query:
                self.run_id, self._is_stream = f"stream-{query}", True
            rows = self._write(self._sorted(self._typed(batch_df)), int(batch_id), skip_empty=True)
            if rows:
                log.info("table=%s batch=%s rows=%s persisted", self.spec.name, batch_id, rows)
                if self.report is not None:
                    self.report(self.spec.name, int(batch_id), rows)
            if self.compact_every and (int(batch_id) + 1) % self.compact_every == 0:
                try:
                    self.compact(batch_df.sparkSession)
                    self.expire(batch_df.sparkSession)
                except Exception:  # noqa: BLE001 - the batch is written; the next compaction retries
                    log.exception("table=%s compaction after batch %s failed", self.spec.name, batch_id)

        return write

    # ------------------------------------------------------------- reads

    def _commit_rows(self, spark: SparkSession, commits: Sequence[Entry]) -> DataFrame:
        """Rows of the commits, each with its version (the commits since the last base: a short list)."""
        columns = zip(*((e.commit, e.priority, e.sequence, e.number) for e in commits))
        types = (pa.string(), pa.int32(), pa.int64(), pa.int64())
        named = spark.createDataFrame(pa.table({n: pa.array(c, t) for n, c, t in zip(("commit", *VERSION), columns, types)}))
        rows = (spark.read.schema(T.StructType(list(self.spec.schema.fields) + [T.StructField("commit", T.StringType())]))
                .option("basePath", f"{self.root}/data").parquet(*(self.data_path(e.commit) for e in commits)))
        return rows.join(named, "commit").select(*self.spec.columns, *VERSION)

    def _base_rows(self, spark: SparkSession, base: Entry) -> DataFrame:
        return spark.read.schema(self.version_schema).parquet(self.data_path(base.commit))

    def _parts(self, spark: SparkSession) -> tuple[DataFrame | None, DataFrame | None]:
        base, commits = self._live(spark)
        return (self._base_rows(spark, base) if base else None,
                self._commit_rows(spark, commits) if commits else None)

    def versions(self, spark: SparkSession) -> DataFrame:
        """Every live row with its priority and sequence (base and newer commits)."""
        base, newer = self._parts(spark)
        if base is None and newer is None:
            return spark.createDataFrame([], self.version_schema)
        return newer if base is None else base if newer is None else base.unionByName(newer)

    def latest(self, spark: SparkSession, key: Sequence[str] | None = None, tie: Sequence[str] = (),
               keep_version: bool = False) -> DataFrame:
        """Current table content: the last write of each primary key (or of each ``key``, ties by ``tie``).

        A base holds one row per primary key, so only the keys that newer commits touch are ranked again; Spark
        picks the join from what it measures.
        """
        cols = [*self.spec.columns, *(VERSION if keep_version else ())]
        key = tuple(key or self.spec.primary_key)
        base, newer = self._parts(spark)
        if base is None or key != tuple(self.spec.primary_key):
            return latest_by_key(self.versions(spark), key, VERSION, tie=tie, keep_version=keep_version).select(*cols)
        if newer is None:
            return base.select(*cols)
        touched = newer.select(*[F.col(k).alias(f"_t_{k}") for k in key]).distinct()
        match = F.lit(True)
        for k in key:
            match = match & F.col(k).eqNullSafe(F.col(f"_t_{k}"))
        ranked = latest_by_key(newer.unionByName(base.join(touched, match, "left_semi")), key, VERSION, tie=tie,
                               keep_version=keep_version)
        return base.join(touched, match, "left_anti").select(*cols).unionByName(ranked.select(*cols))

    # ------------------------------------------------------- maintenance

    def current_base(self, spark: SparkSession) -> Entry | None:
        return self._live(spark)[0]

    def compact(self, spark: SparkSession) -> Entry | None:
        """Write the current content as a new base and return its entry (the current one when nothing is newer).

        The base covers exactly the commits it was made from; one published meanwhile stays live.  Two compactions at
        once both write correct bases, of which the later one is read.
        """
        base, commits = self._live(spark)
        if not commits:
            return base
        entries = self.entries(spark)
        covers = self._covers(spark, base) if base else set()
        known = {e.commit for e in entries}
        made_of = {e.commit for e in commits}
        # earlier entries of batches written again are part of what the base stands for
        replaced = {e.commit for e in entries if e.kind == "commit" and e.number <= max(c.number for c in commits)
                    and any((c.writer, c.batch) == (e.writer, e.batch) for c in commits)}
        commit = uuid.uuid4().hex
        self._snapshot(spark, base, commits).write.parquet(self.data_path(commit))
        return self._append(spark, "base", NORMAL, None, 0, commit, sorted((covers & known) | made_of | replaced))

    def _snapshot(self, spark: SparkSession, base: Entry | None, commits: Sequence[Entry]) -> DataFrame:
        rows = self._commit_rows(spark, commits)
        if base is not None:
            rows = rows.unionByName(self._base_rows(spark, base))
        return self._dealt(latest_by_key(rows, self.spec.primary_key, VERSION, keep_version=True))

    def expire(self, spark: SparkSession, grace_seconds: float = GRACE_SECONDS, live_seconds: float = LIVE_SECONDS) -> int:
        """Remove what the current base covers, and older bases, once the base is older than the grace period, and
        what crashed writes have left.  Returns the number of entries removed.  Data folders go after their entries,
        so no entry lacks its rows.

        Kept are the last commit of the log and the last one of each stream that has written within ``live_seconds``, so
        that a batch that is replayed is still known.  A batch job is a writer of its own each time it runs; its
        commits go as soon as they are covered.
        """
        now = time.time() * 1000
        entries = self.entries(spark)
        base = max((e for e in entries if e.kind == "base"), default=None)
        gone = []
        if base is not None and now - base.time_ms >= grace_seconds * 1000:
            covered = self._covers(spark, base)
            commits = [e for e in entries if e.kind == "commit"]
            kept = {e.writer: e for e in commits if e.writer.startswith(STREAM_MARK) and now - e.time_ms < live_seconds * 1000}
            kept["last"] = commits[-1] if commits else None
            gone = [e for e in entries if (e.kind == "base" and e < base)
                    or (e.kind == "commit" and e.commit in covered and e not in kept.values())]
            for e in gone:
                for path in (f"{self.log_root}/{e.name}", f"{self.log_root}/{e.number:020d}.claim", self.data_path(e.commit)):
                    hpath, fs = _fs(spark, path)
                    fs.delete(hpath, True)
        self._sweep(spark, now - grace_seconds * 1000)
        return len(gone)

    def _sweep(self, spark: SparkSession, before_ms: float) -> int:
        """Remove data folders, claims and unpublished entries that no entry names and that are older than ``before_ms``."""
        listed = {name: _fs(spark, f"{self.root}/{name}") for name in ("data", "_log")}
        old = {name: [st for st in fs.listStatus(hpath) if st.getModificationTime() <= before_ms] if fs.exists(hpath) else []
               for name, (hpath, fs) in listed.items()}
        entries = self.entries(spark)  # after the folders: a write that commits meanwhile is found here
        commits, numbers = {e.commit for e in entries}, {e.number for e in entries}
        left = [st for st in old["data"] if st.getPath().getName().partition("=")[2] not in commits]
        for st in old["_log"]:
            name = st.getPath().getName()
            if name.startswith("_") or (name.endswith(".claim") and int(name.removesuffix(".claim")) not in numbers):
                left.append(st)
        for st in left:
            listed["data"][1].delete(st.getPath(), True)
        return len(left)
