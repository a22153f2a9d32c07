"""Removing every byte that a long string covers which also starts somewhere else in the corpus.

1. Anchors.  The least hash among the ``GRAM``-byte strings inside a 400-byte string depends on its content alone, so
   equal 400-byte strings have equal anchors.  A document falls into segments: runs of neighbouring starts with one
   anchor.  Segments are counted by anchor and digest; the starts of a segment that occurs twice all repeat, and a
   segment whose anchor no other segment has cannot repeat (but for a periodic one, within itself).
2. Suffix buckets.  What is left are distinct segments that share an anchor (edges of passages, near copies).  Spark
   deals them out by anchor, one copy of each with its 400-byte context, and a task sorts their suffixes, a block of
   buckets at a time: by the first bytes, and long ties by the ranks of a difference-cover sample of the block's
   positions (every two positions meet the sample after the same few steps, at most ``PERIOD``).  Neighbours in that
   order with 400 bytes in common repeat.  A hot bucket, of more than ``HOT_BUCKET`` segments or ``BLOCK_BYTES``, is not
   sorted but dealt again in pieces: strings whose anchor stands at about the same place in them, by a hash of what
   all such strings of the piece cover.  Equal pieces are counted as segments are, and a bucket of pieces that is hot
   still is dealt by the whole 400 bytes, where counting is enough.  So memory is bounded by two blocks.
3. Marks go back to their documents, and the covered bytes are cut out.

Texts are UTF-8 bytes.  Defined results: a null or empty text has no bytes; one shorter than 400 bytes loses none;
repeated rows are documents of their own, so theirs repeat; a null id is an id; an empty table gives no rows; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.arrays import mix, powers, ragged, range_hash, steps, utf8
from verdant.session import scratch_path

LENGTH = 400
GRAM = 64
#: Modulus of the difference cover; 31 has one of six residues in which every difference occurs once.
PERIOD = 31
#: Bytes of segments with their contexts whose suffixes are sorted together (a bucket is no larger).
BLOCK_BYTES = 3 << 20
#: A bucket of more distinct segments is dealt out further, by their content.
HOT_BUCKET = 20_000
#: Places of the anchor that the strings of a piece may have; with one place a piece is one string.
PLACES = (32, 1)


@lru_cache(1)
def cover() -> tuple[np.ndarray, np.ndarray]:
    """(whether a residue is in the cover, steps from residues i and j until both are)."""
    for size in range(1, PERIOD):
        for rest in combinations(range(1, PERIOD), size - 1):
            members = (0, *rest)
            if len({(a - b) % PERIOD for a in members for b in members}) == PERIOD:
                inside = np.isin(np.arange(PERIOD), members)
                step = np.array([[next(d for d in range(PERIOD) if inside[(i + d) % PERIOD] and inside[(j + d) % PERIOD])
                                  for j in range(PERIOD)] for i in range(PERIOD)])
                return inside, step
    raise AssertionError("every modulus has a cover")


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of values[i : i + width] for every i that has so many."""
    n = len(values)
    if n < width:
        return values[:0]
    blocks = -(-n // width)
    table = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    table[:n] = values
    table = table.reshape(blocks, width)
    before = np.minimum.accumulate(table, axis=1).ravel()
    after = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], before[width - 1 : n])


def grams(data: np.ndarray) -> np.ndarray:
    at = np.arange(len(data) - GRAM + 1)
    return mix(range_hash(data, at, at + GRAM))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of every 400-byte string of the data, and whether the string begins with it."""
    n = len(data) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    hashes = grams(data)
    least = sliding_least(hashes, LENGTH - GRAM + 1)
    return least, hashes[: len(least)] == least


def segments(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first start, number of starts, anchor, digest, whether its place moves) of the runs of starts with one anchor.

    Two strings of one segment can be equal only if the anchor occurs again further on, after a start at it.
    """
    anchor, leads = anchors(data)
    if not len(anchor):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, anchor, anchor, leads
    size = np.diff(offsets)
    inside = np.zeros(len(anchor) + 1, bool)
    doc = np.flatnonzero(size >= LENGTH)
    row, k = ragged(size[doc] - LENGTH + 1)
    inside[offsets[doc][row] + k] = True
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2] | (anchor[1:] != anchor[:-1])
    first[offsets[doc]] = True
    starts = np.flatnonzero(first)
    last = inside[:-1] & ~np.append(inside[1:-1] & ~first[1:], False)
    count = np.flatnonzero(last) + 1 - starts
    document = np.searchsorted(offsets, starts, "right") - 1
    led = np.append(0, np.cumsum(leads))
    moves = led[starts + count - 1] > led[starts]
    return document, starts - offsets[document], count, anchor[starts], range_hash(data, starts, starts + count - 1 + LENGTH), moves


def pieces(whole: np.ndarray, n: int, anchor: np.uint64, places: int) -> tuple[np.ndarray, ...]:
    """(first start, number of starts, bucket, digest) of the pieces of a segment of n starts; equal strings have equal buckets.

    The strings of a piece begin one after the other before the same occurrence of the anchor, the first in each of them,
    so no two of one piece are equal.
    """
    start, found = np.arange(n), np.flatnonzero(grams(whole) == anchor)
    at = found[np.searchsorted(found, start)]
    place = (at - start) // places
    first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (place[1:] != place[:-1])))
    last = np.append(first[1:], n)
    core = at[first] - places * place[first]
    bucket = mix(range_hash(whole, core, core + LENGTH + 1 - places) ^ mix(place[first].astype(np.uint64) + np.uint64(places << 32)) ^ anchor)
    return first, last - first, bucket, range_hash(whole, first, last - 1 + LENGTH)


class Block:
    """The suffixes of some segments' starts, sorted; which of them share their first 400 bytes with another."""

    def __init__(self, texts: list[bytes], counts: np.ndarray):
        size = np.array([len(t) for t in texts])
        padding = bytes(40)
        self.data = np.frombuffer(padding.join(texts) + padding, np.uint8)
        at = np.cumsum(size + len(padding)) - size - len(padding)
        self.row, self.local = ragged(counts)
        self.start = at[self.row] + self.local
        self.residue = self.local % PERIOD
        self.words = np.zeros(len(self.data) - 7, np.uint64)
        for k in range(8):
            self.words = (self.words << np.uint64(8)) | self.data[k : len(self.data) - 7 + k]
        self._rank(at, size)

    def _rank(self, at: np.ndarray, size: np.ndarray) -> None:
        """Ranks of the cover's positions by their next 31, 62, ... bytes; a text's end sorts first."""
        row, local = ragged(size)
        sampled = cover()[0][local % PERIOD]
        place = (at[row] + local)[sampled]
        left = (size[row] - local)[sampled]
        keys = [self.words[place + 8 * k] for k in range(4)]
        keys[3] &= ~np.uint64(0xFF)  # 31 bytes
        order = np.lexsort(keys[::-1])
        step = np.append(True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0))
        rank = np.zeros(len(self.data) + 1, np.int64)
        dense = np.empty(len(place), np.int64)
        dense[order] = np.cumsum(step)
        rank[place] = dense
        depth = PERIOD
        while depth < LENGTH:
            if depth == 8 * PERIOD:
                self.rank_248 = rank.copy()
            onward = np.where(left > depth, rank[np.minimum(place + depth, len(self.data))], 0)
            pair = (dense << 32) | onward
            order = np.argsort(pair, kind="stable")
            dense = np.empty(len(place), np.int64)
            dense[order] = np.cumsum(np.append(True, pair[order][1:] != pair[order][:-1]))
            rank = np.zeros(len(self.data) + 1, np.int64)
            rank[place] = dense
            depth *= 2
        self.rank = rank

    def sorted(self) -> np.ndarray:
        keys = [self.words[self.start + 8 * k] for k in range(4)]
        keys[3] = keys[3] & ~np.uint64(0xFF)
        order = np.lexsort(keys[::-1])
        group = np.cumsum(np.append(True, np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)))
        step = cover()[1]
        open_ = np.arange(len(order))
        while len(open_):
            g = group[open_]
            first = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            length = np.diff(np.append(first, len(g)))
            pivot = np.repeat(order[open_[first + length // 2]], length)
            mine = order[open_]
            ahead = step[self.residue[mine], self.residue[pivot]]
            side = np.sign(self.rank[self.start[mine] + ahead] - self.rank[self.start[pivot] + ahead])
            move = np.lexsort((side, g))
            order[open_], side = mine[move], side[move]
            new = np.append(True, (g[1:] != g[:-1]) | (side[1:] != side[:-1]))
            number = np.cumsum(new) - 1
            many = np.bincount(number)[number] > 1
            open_, group_open = open_[many & (side != 0)], number[many & (side != 0)]
            group[open_] = group_open  # numbers are compared among open places only
        return order

    def repeated(self) -> np.ndarray:
        """For every start: whether another start of the block has the same 400 bytes."""
        order = self.sorted()
        a, b = order[:-1], order[1:]
        same = np.ones(len(a), bool)
        ahead = cover()[1][self.residue[a], self.residue[b]]
        for k in (0, 8, 16, 23):
            same &= self.words[self.start[a] + k] == self.words[self.start[b] + k]
        for k in (0, 3 * PERIOD):
            same &= self.rank_248[self.start[a] + ahead + k] == self.rank_248[self.start[b] + ahead + k]
        for k in (*range(3 * PERIOD + 8 * PERIOD, LENGTH - 8, 8), LENGTH - 8):
            same &= self.words[self.start[a] + k] == self.words[self.start[b] + k]
        out = np.zeros(len(order), bool)
        out[a[same]] = out[b[same]] = True
        return out


KEY = "doc_id {id}, version long"


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows are named by their content: (id, hash of id and text); repeated rows share a name and all that is found."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.withColumn("version", F.xxhash64("doc_id", "text"))


def _same_row(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["version"] == b["version"])


def _find_segments(keyed: DataFrame, id_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            doc, start, count, anchor, digest, moves = segments(*utf8(batch.column("text")))
            pick = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pick), batch.column("version").take(pick), pa.array(start.astype(np.int64)),
                 pa.array(count.astype(np.int64)), pa.array(anchor.view(np.int64)), pa.array(digest.view(np.int64)), pa.array(moves)],
                ["doc_id", "version", "start", "n", "anchor", "digest", "moves"])

    return keyed.mapInArrow(run, f"{KEY.format(id=id_type)}, start long, n long, anchor long, digest long, moves boolean")


def _contexts(wanted: DataFrame, id_type: str) -> DataFrame:
    """The texts of the wanted segments, each with what its last string covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps([batch], "text"):
                data, offsets = utf8(step.column("text"))
                out = []
                for k, (doc_id, version, found) in enumerate(zip(step.column("doc_id").to_pylist(), step.column("version").to_pylist(), step.column("found").to_pylist())):
                    text = data[offsets[k] : offsets[k + 1]]
                    for s in found:
                        out.append((s["bucket"], doc_id, version, s["start"], s["n"], s["copies"], text[s["start"] : s["start"] + s["n"] - 1 + LENGTH].tobytes()))
                if out:
                    bucket, doc_id, version, start, n, copies, text = zip(*out)
                    long = lambda x: pa.array(x, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [long(bucket), pa.array(doc_id, step.column("doc_id").type), long(version), long(start), long(n), long(copies), pa.array(text, pa.binary())],
                        ["bucket", "doc_id", "version", "start", "n", "copies", "context"])

    return wanted.select("doc_id", "version", "text", "found").mapInArrow(
        run, f"bucket long, {KEY.format(id=id_type)}, start long, n long, copies long, context binary")


def _find_pieces(wanted: DataFrame, id_type: str, places: int) -> DataFrame:
    """The pieces of the wanted segments, in the columns of segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps([batch], "text"):
                data, offsets = utf8(step.column("text"))
                for k, found in enumerate(step.column("found").to_pylist()):
                    text = data[offsets[k] : offsets[k + 1]]
                    for s in found:
                        first, n, bucket, digest = pieces(text[s["start"] : s["start"] + s["n"] - 1 + LENGTH], s["n"], np.uint64(s["anchor"] & (1 << 64) - 1), places)
                        row = pa.array(np.full(len(first), k))
                        yield pa.RecordBatch.from_arrays(
                            [step.column("doc_id").take(row), step.column("version").take(row), pa.array(s["start"] + first), pa.array(n),
                             pa.array(np.full(len(first), s["anchor"])), pa.array(bucket.view(np.int64)), pa.array(digest.view(np.int64)),
                             pa.array(np.full(len(first), s["copies"])), pa.array(np.zeros(len(first), bool))],
                            ["doc_id", "version", "start", "n", "anchor", "bucket", "digest", "copies", "moves"])

    return wanted.select("doc_id", "version", "text", "found").mapInArrow(
        run, f"{KEY.format(id=id_type)}, start long, n long, anchor long, bucket long, digest long, copies long, moves boolean")


def _sort_buckets(contexts: DataFrame, id_type: str) -> DataFrame:
    """Runs of starts in single segments whose 400 bytes some other start of the bucket has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last, doc_type = [], 0, None, None

        def flush() -> Iterator[pa.RecordBatch]:
            counts = np.array([r[4] for r in held])
            block = Block([r[6] for r in held], counts)
            hit = block.repeated() & (np.array([r[5] for r in held])[block.row] == 1)
            begins = hit & ~(np.append(False, hit[:-1]) & (block.local != 0))
            ends = hit & ~(np.append(hit[1:], False) & np.append(block.local[1:] != 0, False))
            first, final = np.flatnonzero(begins), np.flatnonzero(ends)
            rows = [held[r] for r in block.row[first].tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[1] for r in rows], doc_type), pa.array([r[2] for r in rows], pa.int64()),
                 pa.array(np.array([r[3] for r in rows], np.int64) + block.local[first]), pa.array(final - first + 1)],
                ["doc_id", "version", "start", "n"])

        for batch in batches:
            doc_type = batch.column("doc_id").type
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[0] != last and size >= BLOCK_BYTES:
                    yield from flush()
                    held, size = [], 0
                last = row[0]
                held.append(row)
                size += len(row[6])
        if held:
            yield from flush()

    return contexts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, f"{KEY.format(id=id_type)}, start long, n long")


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "repeats", name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _wanted(keyed: DataFrame, counted: DataFrame) -> DataFrame:
    """The rows that hold one copy of each of the counted segments, with a list of them."""
    lists = (counted.groupBy("one.doc_id", "one.version")
             .agg(F.collect_list(F.struct("one.start", "one.n", "one.anchor", "bucket", "copies")).alias("found")))
    return keyed.join(lists, _same_row(keyed, lists)).select(keyed["doc_id"], keyed["version"], "text", "found")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept): maximal removed runs [start, end) in bytes and the remaining bytes."""
    keyed = _keyed(docs, id_col, text_col)
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    found = _stored(_find_segments(keyed, id_type), "segments").withColumn("bucket", F.col("anchor")).withColumn("copies", F.lit(1).cast("long"))
    marks = []
    for level, places in enumerate((*PLACES, None)):
        counted = found.groupBy("bucket", "digest").agg(
            F.sum("copies").alias("copies"), F.max("moves").alias("moves"), F.min(F.struct("doc_id", "version", "start", "n", "anchor")).alias("one"))
        counted = _stored(counted, f"counted{level}")
        marks.append(found.join(counted.where("copies > 1").select("bucket", "digest"), ["bucket", "digest"]).select("doc_id", "version", "start", "n"))
        if places is None:
            break  # a bucket is one string
        hot = (F.col("kinds") > HOT_BUCKET) | (F.col("bytes") > BLOCK_BYTES)
        several = _stored(
            counted.groupBy("bucket").agg(F.count("*").alias("kinds"), F.min("copies").alias("least"), F.max("moves").alias("moves"), F.sum(F.col("one.n") + LENGTH - 1).alias("bytes"))
            .where("least = 1 and (kinds > 1 or moves)").select("bucket", hot.alias("hot")), f"several{level}")
        contexts = _contexts(_wanted(keyed, counted.join(several.where("not hot"), "bucket")), id_type)
        marks.append(_stored(_sort_buckets(contexts, id_type), f"single{level}"))
        hot = several.where("hot").select("bucket")
        if hot.isEmpty():
            break
        # few: each holds HOT_BUCKET segments or BLOCK_BYTES
        found = _stored(_find_pieces(_wanted(keyed, counted.join(F.broadcast(hot), "bucket")), id_type, places), f"pieces{level}")
    marks = reduce(DataFrame.unionByName, marks).groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    marked = keyed.join(marks, _same_row(keyed, marks), "left").select(keyed["doc_id"], "text", "found")
    return _cut(marked, id_type)


def _cut(marked: DataFrame, id_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for step in steps([batch], "text"):
                data, offsets = utf8(step.column("text"))
                lists = step.column("found")
                change = np.zeros(len(data) + 1, np.int64)
                runs = lists.flatten()
                row = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy(False))
                start = offsets[row] + runs.field("start").to_numpy(False)
                np.add.at(change, start, 1)
                np.add.at(change, start + runs.field("n").to_numpy(False) - 1 + LENGTH, -1)
                gone = np.zeros(len(data) + 1, bool)
                gone[:-1] = np.cumsum(change[:-1]) > 0
                spans, kept = [], []
                for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                    mask = gone[a:b]
                    edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
                    spans.append([{"start": s, "end": e} for s, e in edge.reshape(-1, 2).tolist()])
                    kept.append(data[a:b][~mask].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [step.column("doc_id"), pa.array(np.diff(offsets)),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return marked.mapInArrow(run, f"doc_id {id_type}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
