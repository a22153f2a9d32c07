"""Token ids of documents in an entropy-coded block format, written and read by Spark.

Ids are coded by a static range asymmetric numeral system (rANS): one frequency table, counted over all
documents, is shared by all blocks.  A block holds whole consecutive documents of ``BLOCK_IDS`` ids together (a longer document has
blocks of its own), dealt round robin to interleaved lanes that are coded in step, so numpy works on all lanes at once and
every block decodes alone.  Its record carries the lanes' final states (the checkpoint from which decoding
starts), the coded words, where its documents begin, and a crc32 of its ids.

Files: a folder with ``ids`` (parquet rows, one per block: part, place, documents and their counts, payload, crc32)
and ``table`` (token id, frequency).  Spark commits both, so a lost executor leaves no partial file.

Defined results: a null or empty text has only the end id; documents are ordered by id, equal ids (repeated
rows) by token count and then content, null ids first; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm.arrays import steps, utf8
from verdant.llm.token_ids import encoder
from verdant.session import scratch_path

END_ID = 2
#: Frequencies add up to 2 ** SCALE; states stay in [2 ** 31, 2 ** 63), words have 32 bits.
SCALE = 20
LOW = np.uint64(1 << 31)
BLOCK_IDS = 1 << 20
LANES = 1 << 11
#: Parquet bytes of token ids that one output part holds.
PART_IDS = 8 << 20

_S, _W, _MASK = np.uint64(SCALE), np.uint64(32), np.uint64((1 << SCALE) - 1)


class Table:
    """Frequencies of ids scaled to 2 ** SCALE, at least one for every id that occurs."""

    def __init__(self, ids: np.ndarray, frequency: np.ndarray):
        self.ids, self.frequency = ids.astype(np.uint32), frequency.astype(np.uint64)
        self.start = np.cumsum(self.frequency) - self.frequency
        self.place = np.full(int(ids.max()) + 1 if len(ids) else 1, -1, np.int64)
        self.place[self.ids] = np.arange(len(ids))
        self.symbol = np.repeat(np.arange(len(ids), dtype=np.int32), frequency.astype(np.int64))

    @staticmethod
    def scaled(ids: np.ndarray, counts: np.ndarray) -> Table:
        whole = 1 << SCALE
        if len(ids) > whole:
            raise ValueError(f"{len(ids)} distinct ids do not fit a table of {whole}")
        share = counts / counts.sum() * (whole - len(ids)) if len(ids) else counts
        frequency = 1 + np.floor(share).astype(np.int64)
        if len(ids):
            frequency[np.argsort(-(share % 1), kind="stable")[: whole - int(frequency.sum())]] += 1
        return Table(ids, frequency)

    def encode(self, ids: np.ndarray) -> bytes:
        """Lane states after the last step (little-endian 64 bits), then the words in the order of decoding."""
        n, lanes = len(ids), min(LANES, max(1, len(ids)))
        place = self.place[ids]
        frequency, start = self.frequency[place], self.start[place]
        limit = frequency << np.uint64(63 - SCALE)  # ((2**31 >> SCALE) << 32) * frequency
        state, words = np.full(lanes, LOW), []
        for at in range((n - 1) // lanes * lanes, -1, -lanes):
            f, x = frequency[at : at + lanes], state[: min(lanes, n - at)]
            full = x >= limit[at : at + lanes]
            if full.any():
                words.append(x[full].astype("<u4")[::-1])
                x = np.where(full, x >> _W, x)
            quotient = x // f
            state[: len(x)] = (quotient << _S) + (x - quotient * f) + start[at : at + lanes]
        coded = np.concatenate(words)[::-1] if words else np.zeros(0, "<u4")
        return state.astype("<u8").tobytes() + coded.astype("<u4").tobytes()

    def decode(self, payload: bytes, n: int) -> np.ndarray:
        lanes = min(LANES, max(1, n))
        state = np.frombuffer(payload, "<u8", lanes).astype(np.uint64)
        words = np.frombuffer(payload, "<u4", offset=8 * lanes).astype(np.uint64)
        out, used = np.empty(n, np.int32), 0
        for at in range(0, n, lanes):
            x = state[: min(lanes, n - at)]
            slot = x & _MASK
            symbol = self.symbol[slot.astype(np.int64)]
            out[at : at + lanes] = symbol
            x = self.frequency[symbol] * (x >> _S) + slot - self.start[symbol]
            low = np.flatnonzero(x < LOW)
            if used + len(low) > len(words):
                raise ValueError("a block of token ids is damaged: it has too few words")
            x[low] = (x[low] << _W) | words[used : used + len(low)]
            used += len(low)
            state[: len(x)] = x
        if used != len(words) or (state != LOW).any():
            raise ValueError("a block of token ids is damaged: its lanes do not end where they began")
        return self.ids[out]


def tokenized(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID) -> DataFrame:
    """(doc_id, n_tokens, ids): ids as little-endian unsigned 16-bit integers, with the end id."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = encoder(tokenizer), np.array([end_id], np.uint16)
        for batch in steps(batches, "text"):
            ids = [np.append(x, end) for x in words.encode(*utf8(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) for x in ids], pa.int64()),
                 pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary())], ["doc_id", "n_tokens", "ids"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def count_ids(tokens: DataFrame) -> DataFrame:
    """(token, n) over all rows; each task adds up its own ids before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            raw = utf8(batch.column("ids"))[0]
            total += np.bincount(raw.view("<u2"), minlength=1 << 16)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["token", "n"])

    return tokens.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


BLOCK_SCHEMA = ("part int, start long, cut boolean, docs array<long>, doc_ids array<{id}>, lengths array<long>, "
                "n_ids long, payload binary, crc32 long")


def write(docs: DataFrame, path: str, tokenizer: str, **columns) -> None:
    """Write the ids of all documents, in ascending order of their ids, to the folder ``path``."""
    spark = docs.sparkSession
    stage = scratch_path(spark, "token_ids")
    tokenized(docs, tokenizer, **columns).write.option("compression", "zstd").parquet(stage)
    tokens = spark.read.parquet(stage)
    id_type = tokens.schema["doc_id"].dataType.simpleString()
    counts = count_ids(tokens).orderBy("token").toArrow()  # at most one row per id of the vocabulary
    ids, n = counts.column("token").to_numpy(), counts.column("n").to_numpy()
    table = Table.scaled(ids, n)
    spark.createDataFrame(pa.table({"token": ids, "frequency": table.frequency.astype(np.int64)})).write.parquet(f"{path}/table")
    parts = max(1, -(-int(n.sum()) // PART_IDS))
    shared = spark.sparkContext.broadcast((ids, table.frequency))  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        part, start, doc_type = TaskContext.get().partitionId(), 0, None
        held: list[tuple] = []  # (number in the part, id, ids)

        def record(cut: bool) -> pa.RecordBatch:
            nonlocal start
            docs, names, pieces = zip(*held)
            ids = np.concatenate(pieces)
            row = {"part": ([part], pa.int32()), "start": ([start], pa.int64()), "cut": ([cut], pa.bool_()),
                   "docs": ([docs], pa.list_(pa.int64())), "doc_ids": ([names], pa.list_(doc_type)),
                   "lengths": ([list(map(len, pieces))], pa.list_(pa.int64())), "n_ids": ([len(ids)], pa.int64()),
                   "payload": ([table.encode(ids)], pa.binary()),
                   "crc32": ([zlib.crc32(ids.astype("<u4").tobytes())], pa.int64())}
            start += len(ids)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(*x) for x in row.values()], list(row))

        number, size = -1, 0
        for batch in batches:
            doc_type = batch.column("doc_id").type
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids, number = np.frombuffer(raw.as_buffer(), "<u2"), number + 1
                if held and size + len(ids) > BLOCK_IDS:
                    yield record(False)
                    size = 0
                if len(ids) > BLOCK_IDS:
                    for at in range(0, len(ids), BLOCK_IDS):
                        held.append((number, doc_id, ids[at : at + BLOCK_IDS]))
                        yield record(True)
                else:
                    held.append((number, doc_id, ids))
                    size += len(ids)
        if held:
            yield record(False)

    (tokens.repartitionByRange(parts, "doc_id", "n_tokens", F.xxhash64("ids")).sortWithinPartitions("doc_id", "n_tokens", F.xxhash64("ids"))
     .mapInArrow(run, BLOCK_SCHEMA.format(id=id_type)).write.option("compression", "none").parquet(f"{path}/ids"))


def _table(spark: SparkSession, path: str) -> Table:
    rows = spark.read.parquet(f"{path}/table").orderBy("token").toArrow()
    return Table(rows.column("token").to_numpy(), rows.column("frequency").to_numpy())


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): documents from the files; ids as little-endian unsigned 32-bit integers.

    Blocks decode alone, in any order; only the pieces of documents longer than a block are shuffled.
    """
    table = _table(spark, path)
    shared = spark.sparkContext.broadcast((table.ids, table.frequency))
    blocks = spark.read.parquet(f"{path}/ids")
    # Ids before each part: one total per part, of which there is one for every PART_IDS ids.
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, at = {}, 0
    for row in totals:
        before[row.part], at = at, at + row.n
    id_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(*shared.value)
        for batch in batches:
            names = batch.column("doc_ids")
            for k, row in enumerate(batch.drop_columns(["doc_ids"]).to_pylist()):
                ids = table.decode(row["payload"], row["n_ids"])
                if zlib.crc32(ids.astype("<u4").tobytes()) != row["crc32"]:
                    raise ValueError(f"part {row['part']}, ids from {row['start']}: not the checksum written")
                size = np.array(row["lengths"])
                end = np.cumsum(size)
                raw = pa.Array.from_buffers(pa.large_binary(), len(size), [
                    None, pa.py_buffer(np.append(0, 4 * end).astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(size), row["part"], np.int32)), pa.array(row["docs"], pa.int64()), names[k].values,
                     pa.array(before[row["part"]] + row["start"] + end - size), pa.array(size), raw.cast(pa.binary())],
                    ["part", "doc", "doc_id", "start", "n_tokens", "ids"])

    def decoded(cut: bool) -> DataFrame:
        return blocks.where(F.col("cut") == cut).mapInArrow(
            run, f"part int, doc long, doc_id {id_type}, start long, n_tokens long, ids binary")

    pieces = F.array_sort(F.collect_list(F.struct("start", "n_tokens", "ids")))
    joined = decoded(True).groupBy("part", "doc", "doc_id").agg(F.min("start").alias("start"), F.sum("n_tokens").alias("n_tokens"), pieces.alias("pieces"))
    whole = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    return decoded(False).drop("part", "doc").unionByName(joined.select("doc_id", "start", "n_tokens", whole))
