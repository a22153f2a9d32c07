"""Packing documents into fixed windows by best-fit decreasing.

A document's ids are cut into full windows first; the remainders of a batch of documents are placed longest
first, each into the tightest open window, found by a segment tree over remaining capacities.  Spark deals the
documents out (scan partitions); a task packs batches of ``BATCH_TOKENS`` ids, so its memory does not grow with
its partition, and no row is shuffled.

Defined results: a null or empty text has only the end id; repeated rows are packed each by itself; equal
lengths keep their row order; an empty table gives no rows; columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.arrays import steps, utf8
from verdant.llm.token_ids import encoder

WINDOW = 2048
END_ID = 1
#: Ids that are packed together: about 2,000 windows, of which the last few stay partly filled.
BATCH_TOKENS = 4 << 20
#: sequence_id = task's partition * SEQUENCES_PER_TASK + running number.
SEQUENCES_PER_TASK = 1 << 33


class CapacityTree:
    """Segment tree over capacities 0..window: which capacities have an open sequence."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def put(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        node = self.leaves + capacity
        while node:
            self.filled[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the tightest sequence with at least this capacity left."""
        filled, node = self.filled, self.leaves + least
        if not filled[node]:
            while node > 1 and (node & 1 or not filled[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not filled[node]:
                    node += 1
        capacity = node - self.leaves
        sequence = self.open[capacity].pop()
        while node:
            filled[node] -= 1
            node >>= 1
        return capacity, sequence


def best_fit(lengths: list[int], window: int, first: int) -> tuple[list[tuple[int, int]], int]:
    """(sequence, offset) of every piece, placed longest first; the next free sequence number."""
    tree, placed, sequence = CapacityTree(window), [(0, 0)] * len(lengths), first
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = tree.take(lengths[i])
        if found is None:
            found, sequence = (window, sequence), sequence + 1
        capacity, where = found
        placed[i] = where, window - capacity
        if capacity > lengths[i]:
            tree.put(capacity - lengths[i], where)
    return placed, sequence


def _pack(documents: list[tuple[object, np.ndarray]], window: int, first: int) -> tuple[list[tuple], int]:
    pieces, rest, sequence = [], [], first
    for doc_id, ids in documents:
        full = len(ids) // window * window
        for start in range(0, full, window):
            pieces.append((doc_id, start, ids[start : start + window], len(ids), sequence, 0))
            sequence += 1
        if full < len(ids):
            rest.append((doc_id, full, ids[full:], len(ids)))
    placed, sequence = best_fit([len(r[2]) for r in rest], window, sequence)
    return pieces + [r + p for r, p in zip(rest, placed)], sequence


def _ids_column(ids: list[np.ndarray]) -> pa.Array:
    return pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))


def _crc_column(ids: list[np.ndarray]) -> pa.Array:
    return pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64())


def pack(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         end_id: int = END_ID, content: tuple[str, str, Callable] = ("ids", "array<int>", _ids_column)) -> DataFrame:
    """One row per piece: its document, place in the document, place in a sequence, and its ids.

    ``content`` is (name, type, function of the pieces' id arrays) of the column that carries the ids.
    """
    name, kind, make = content
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(tokenizer)
        sequence = TaskContext.get().partitionId() * SEQUENCES_PER_TASK
        held, tokens, doc_type = [], 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            pieces, sequence = _pack(held, window, sequence)
            for at in range(0, len(pieces), 8192):
                doc, start, ids, total, where, offset = zip(*pieces[at : at + 8192])
                long = lambda x: pa.array(x, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, doc_type), long(start), long(list(map(len, ids))), make(ids), long(total), long(where),
                     long(offset)], ["doc_id", "start", "length", name, "doc_tokens", "sequence_id", "offset"])

        for batch in steps(batches, "text"):
            doc_type = batch.column("doc_id").type
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), words.encode(*utf8(batch.column("text")))):
                held.append((doc_id, np.append(ids, np.uint16(end_id))))
                tokens += len(ids) + 1
            if tokens >= BATCH_TOKENS:
                yield from flush()
                held, tokens = [], 0
        if held:
            yield from flush()

    return docs.mapInArrow(run, f"doc_id {id_type}, start long, length long, {name} {kind}, doc_tokens long, "
                                "sequence_id long, offset long")


#: Content that is the crc32 of the piece's ids as little-endian unsigned 32-bit integers, in place of the ids.
CRC32 = ("ids_crc32", "long", _crc_column)
