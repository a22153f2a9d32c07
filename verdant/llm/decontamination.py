"""Benchmark decontamination with suffix arrays of the training texts.

Every task builds suffix arrays over the words of its documents, one for each batch of texts (a shard), and
binary-searches every suffix of every benchmark item in each: the neighbours of its place give its longest
verbatim match, and the range of suffixes that begin with the item's window gives all occurrences.  Training
words that no item has cannot begin a match, so their suffixes are left out of the array.  Words are known by
64-bit hashes.  Documents stay where they are read; only the benchmark travels, in blocks of bounded size that
are gone through one after the other.

Defined results: a null or empty text or item has no words and matches nothing; repeated rows are judged each by
itself; equal items all count; an empty benchmark leaves every document clean; other columns are not read by
``find`` and are passed on untouched by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.arrays import Words, ragged, steps, utf8

WINDOW = 10
#: Most bytes of benchmark text that are collected and broadcast together; a larger benchmark goes in several blocks.
BLOCK_BYTES = 16 << 20

#: Bytes of words: digits, letters (after A-Z are lower-cased) and all of every character beyond ASCII.
WORD = np.zeros(256, bool)
WORD[ord("0") : ord("9") + 1] = WORD[ord("a") : ord("z") + 1] = WORD[ord("A") : ord("Z") + 1] = WORD[128:] = True


class Items:
    """The suffixes of a block of benchmark items, as rows of word numbers (0: past the item's end)."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        words = Words(*utf8(pa.array(texts, pa.string())), WORD)
        self.ids = ids
        self.vocabulary, number = np.unique(words.hash, return_inverse=True)
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.per_key = 63 // self.bits
        item, at = ragged(words.count)
        self.item, self.at = item, at
        self.left = words.count[item] - at  # words of the suffix
        self.window = np.minimum(window, words.count)[item]
        self.whole = np.flatnonzero(self.left >= self.window)  # suffixes that begin with a window
        depth = int(words.count.max()) if len(texts) else 0
        self.keys = pack_keys(number + 1, np.arange(len(item)), words.first[item + 1], depth, self.bits, self.per_key)


def pack_keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int, bits: int, per_key: int) -> np.ndarray:
    """Keys [i, j] of words starts[i] + j * per_key and on, ``per_key`` to a key, 0 past ends[i]; keys sort as the words do."""
    keys = np.zeros((len(starts), -(-depth // per_key)), np.uint64)
    for j in range(keys.shape[1] * per_key):
        at = starts + j
        word = words[np.minimum(at, len(words) - 1)] * (at < ends)
        keys[:, j // per_key] |= word.astype(np.uint64) << np.uint64(bits * (per_key - 1 - j % per_key))
    return keys


class SuffixArray:
    """Suffixes of a shard's documents, sorted to ``depth`` words; words outside the vocabulary are 0."""

    def __init__(self, number: np.ndarray, ends: np.ndarray, depth: int, bits: int, per_key: int):
        self.number, self.ends, self.bits, self.per_key = number, ends, bits, per_key
        start = np.flatnonzero(number)
        first = self.key(start, 0)
        order = np.argsort(first, kind="stable")
        start, first = start[order], first[order]
        rounds = -(-depth // per_key)
        group = np.cumsum(np.append(True, first[1:] != first[:-1])) if len(first) else first.astype(np.int64)
        for j in range(1, rounds):  # only ties are looked at further
            same = np.zeros(len(group), bool)
            same[1:] = group[1:] == group[:-1]
            same[:-1] |= same[1:]
            tied = np.flatnonzero(same)
            if not len(tied):
                break
            key = self.key(start[tied], j)
            go_on = np.lexsort((key, group[tied]))
            start[tied] = start[tied][go_on]
            key = key[go_on]
            step = np.append(True, group[1:] != group[:-1])
            step[tied[1:]] |= (key[1:] != key[:-1]) & (group[tied[1:]] == group[tied[:-1]])
            group = np.cumsum(step)
        self.start = start
        self.first = self.key(start, 0)

    def key(self, start: np.ndarray, j: int) -> np.ndarray:
        out = np.zeros(len(start), np.uint64)
        end = self.ends[start] if len(start) else start
        for k in range(self.per_key):
            at = start + j * self.per_key + k
            word = self.number[np.minimum(at, len(self.number) - 1)] * (at < end)
            out = (out << np.uint64(self.bits)) | word.astype(np.uint64)
        return out

    def bound(self, keys: np.ndarray, words: np.ndarray, upper: bool) -> np.ndarray:
        """First place whose suffix is not below (upper: is above) each query, judged by the query's first words only."""
        masked = [self._cut(keys[:, j], words - j * self.per_key) for j in range(keys.shape[1])]
        # The first key narrows the range; deeper keys are compared by bisection.
        low = np.searchsorted(self.first, masked[0], "left")
        fill = self._fill(words)
        high = np.searchsorted(self.first, masked[0] | fill, "right")
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            side = np.zeros(len(open_), np.int8)
            for j in range(keys.shape[1]):
                undecided = np.flatnonzero((side == 0) & (words[open_] > j * self.per_key))
                if not len(undecided):
                    break
                rows = open_[undecided]
                mine = self._cut(self.key(self.start[middle[undecided]], j), words[rows] - j * self.per_key)
                side[undecided] = np.where(mine < masked[j][rows], -1, (mine > masked[j][rows]).astype(np.int8))
            right = (side <= 0) if upper else (side < 0)
            low[open_[right]] = middle[right] + 1
            high[open_[~right]] = middle[~right]
        return low

    def _fill(self, words: np.ndarray) -> np.ndarray:
        free = np.clip(self.per_key - words, 0, self.per_key) * self.bits
        return (np.uint64(1) << free.astype(np.uint64)) - np.uint64(1)

    def _cut(self, key: np.ndarray, words: np.ndarray) -> np.ndarray:
        return key & ~self._fill(words)

    def match(self, place: np.ndarray, keys: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Words that the suffix at ``place`` (may be out of range) and each query have in common from the start."""
        out = np.zeros(len(place), np.int64)
        rows = np.flatnonzero((place >= 0) & (place < len(self.start)))
        for j in range(keys.shape[1]):
            if not len(rows):
                break
            differ = self.key(self.start[place[rows]], j) ^ keys[rows, j]
            full = np.full(len(rows), self.per_key)
            for k in range(self.per_key):  # words up to the first that differs
                bad = (differ >> np.uint64(self.bits * (self.per_key - 1 - k)) != 0) & (full == self.per_key)
                full[bad] = k
            out[rows] += full
            rows = rows[full == self.per_key]
        return np.minimum(out, words)


def search_shard(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(suffix of the items, word of the shard, length) of every window found, and each suffix's longest match."""
    none = np.zeros(0, np.int64)
    if not len(words.hash) or not len(items.vocabulary):
        return none, none, none, np.zeros(len(items.item), np.int64)
    place = np.searchsorted(items.vocabulary, words.hash)
    place[place == len(items.vocabulary)] = 0
    number = np.where(items.vocabulary[place] == words.hash, place + 1, 0)
    array = SuffixArray(number, np.repeat(words.first[1:], words.count), items.keys.shape[1] * items.per_key, items.bits, items.per_key)
    at = array.bound(items.keys, items.left, False)
    longest = np.maximum(array.match(at, items.keys, items.left), array.match(at - 1, items.keys, items.left))
    found = items.whole[longest[items.whole] >= items.window[items.whole]]
    low = array.bound(items.keys[found], items.window[found], False)
    high = array.bound(items.keys[found], items.window[found], True)
    row, k = ragged(high - low)
    return found[row], array.start[low[row] + k], items.window[found][row], longest


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list[str], list[str]]]:
    """(ids, texts) of the benchmark in blocks of at most about ``BLOCK_BYTES``, which the driver collects one by one."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // (BLOCK_BYTES // 2)))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else rows
        found = part.orderBy("id", "text").toArrow()
        yield found.column("id").to_pylist(), found.column("text").to_pylist()


def find(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: n_words, hits (start and length in words of maximal runs covered by windows), items."""
    spark = docs.sparkSession
    found = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = found.schema["doc_id"].dataType.simpleString()
    hits, names = "array<struct<start:long,length:long>>", "array<string>"
    found = found.select("doc_id", "text", F.lit(0).cast("long").alias("n_words"), F.array().cast(hits).alias("hits"),
                         F.array().cast(names).alias("items"))
    for ids, texts in blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value, window)
            for batch in steps(batches, "text"):
                words = Words(*utf8(batch.column("text")), WORD)
                suffix, word, length, _ = search_shard(words, items)
                yield _report(batch, words, items, suffix, word, length)

        found = found.mapInArrow(run, f"doc_id {id_type}, text string, n_words long, hits {hits}, items {names}")
    return found.drop("text")


def _report(batch: pa.RecordBatch, words: Words, items: Items, suffix: np.ndarray, word: np.ndarray, length: np.ndarray) -> pa.RecordBatch:
    """The batch with what this block of items adds to what earlier blocks found."""
    n = batch.num_rows
    doc = np.searchsorted(words.first, word, "right") - 1
    cover = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + length, -1)
    covered = np.cumsum(cover[:-1]) > 0
    for k, earlier in enumerate(batch.column("hits").to_pylist()):
        for run in earlier:
            a = words.first[k] + run["start"]
            covered[a : a + run["length"]] = True
    begins = covered.copy()
    begins[1:] &= ~covered[:-1]
    cuts = words.first[(words.first > 0) & (words.first < len(covered))]
    begins[cuts] |= covered[cuts]
    starts = np.flatnonzero(begins)
    where = np.searchsorted(words.first, starts, "right") - 1
    sizes = np.add.reduceat(covered, starts, dtype=np.int64) if len(starts) else starts
    runs = [[] for _ in range(n)]
    for k, a, size in zip(where.tolist(), (starts - words.first[where]).tolist(), sizes.tolist()):
        runs[k].append({"start": a, "length": size})
    names = batch.column("items").to_pylist()
    pairs = np.unique(np.stack([doc, items.item[suffix]]), axis=1)
    for k, item in pairs.T.tolist():
        names[k].append(items.ids[item])
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("text"), pa.array(words.count), pa.array(runs, batch.column("hits").type),
         pa.array(names, batch.column("items").type)], ["doc_id", "text", "n_words", "hits", "items"])


def matches(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Longest verbatim match of every benchmark suffix with the whole table: item, place in it, length in words."""
    spark, out = docs.sparkSession, None
    texts_only = docs.select(F.col(text_col).alias("text"))
    for ids, texts in blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value, WINDOW)
            best = np.zeros(len(items.item), np.int64)
            for batch in steps(batches, "text"):
                best = np.maximum(best, search_shard(Words(*utf8(batch.column("text")), WORD), items)[3])
            yield pa.RecordBatch.from_arrays(
                [pa.array([items.ids[i] for i in items.item.tolist()], pa.string()), pa.array(items.at), pa.array(best)], ["item", "start", "length"])

        part = texts_only.mapInArrow(run, "item string, start long, length long").groupBy("item", "start").agg(F.max("length").alias("length"))
        out = part if out is None else out.unionByName(part)
    return out


def remove(docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of the benchmark occurs, all columns as they are."""
    spark = docs.sparkSession
    for ids, texts in blocks(benchmark, item_col, item_text_col):
        shared = spark.sparkContext.broadcast((ids, texts))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(*shared.value, window)
            for batch in steps(batches, text_col):
                words = Words(*utf8(batch.column(text_col)), WORD)
                word = search_shard(words, items)[1]
                keep = np.ones(batch.num_rows, bool)
                keep[np.searchsorted(words.first, word, "right") - 1] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
