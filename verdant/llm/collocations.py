"""Phrases whose words occur together more often than apart, counted over a prefix-free parse of the texts.

Every text is parsed into chunks: a chunk begins where the hash of the next ``longest - 1`` words (the window) is
divisible by ``PARSE``, and ends with the window that begins the next one.  Where a chunk begins depends on the words there
alone, so passages that repeat give the same chunks, whatever stands around them.  The distinct chunks with their numbers
of occurrences are the dictionary; it is all that is counted from.  A phrase belongs to the chunk in whose own part, before
the closing window, it begins; there it lies whole, so a chunk's phrases count as often as the chunk occurs and phrases in an
overlap count once.  A chunk without a trigger is closed after ``LONGEST_CHUNK`` words in the same way.

Phrases are counted by length.  One of n words reaches ``min_count`` only if both phrases of n - 1 words in it do, so the
frequent ones of a length go into a Bloom filter of fixed size, and only phrases whose two parts pass it are summed for the
next length.  The filter only saves work: each phrase that passes is counted exactly.  Words and phrases travel as 64-bit
hashes; a phrase is known by two of them, of all its words but the last and of the last word.  Phrases of three words and more
are counted over what is left of the chunks when only runs of words whose pairs pass the filter are kept.

Defined results: a null language is ``und``; a null or empty text and a text without words have no phrases; repeated rows
all count; texts with fewer words than the window are one chunk; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.arrays import LOWER, Words, mix, ragged, range_hash, steps, utf8
from verdant.session import scratch_path

#: Words to a chunk on average, and at most.
PARSE, LONGEST_CHUNK = 48, 2048
#: The filter has 2 ** FILTER_BITS bits, which is 8 MB, whatever the input.
FILTER_BITS = 26
#: Bytes of chunks that are counted together in a task.
STEP_BYTES = 4 << 20
#: Parts in which each language's phrases are ranked before the whole.
RANK_PARTS = 64

#: Bytes that end a piece (fixed: . , ; : ! ? and the line ends \n \v \f \r), and bytes of words.
BREAK = np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~BREAK
WORD[[0x20, 0x09]] = False


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """data[start:end] for many ranges, as one column."""
    size = ends - starts
    offsets = np.append(0, np.cumsum(size))
    at = np.repeat(starts - offsets[:-1], size)
    at += np.arange(offsets[-1])
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data[at]))


def _chunks(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of own words, last word) of every chunk of a batch of texts."""
    n = len(words.hash)
    rolled = np.zeros(n, np.uint64)
    for k in range(window):
        keep = max(0, n - k)
        rolled[:keep] = mix(rolled[:keep] + words.hash[k:])
    text_end = np.repeat(words.first[1:], words.count)
    begins = (rolled % np.uint64(PARSE) == 0) & (np.arange(n) + window <= text_end)
    begins[words.first[:-1][words.count > 0]] = True
    start = np.flatnonzero(begins)
    own = np.diff(np.append(start, n))  # a text's first word begins a chunk, so no chunk leaves its text
    row, part = ragged(-(-own // LONGEST_CHUNK))
    start, own = start[row] + part * LONGEST_CHUNK, np.minimum(LONGEST_CHUNK, own[row] - part * LONGEST_CHUNK)
    return start, own, np.minimum(start + own + window, text_end[start]) - 1


def parse(docs: DataFrame, *, longest: int = 5, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The dictionary of the parse: lang, chunk (its text, A-Z lower-cased), own (words before the closing window), n."""
    window = longest - 1
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            data, offsets = utf8(batch.column("text"))
            words = Words(data, offsets, WORD)
            if not len(words.hash):
                continue
            start, own, last = _chunks(words, window)
            text = np.searchsorted(words.first, start, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(text)), _slices(LOWER[data], words.start[start], words.end[last]), pa.array(own, pa.int32())],
                ["lang", "chunk", "own"])

    return rows.mapInArrow(run, "lang string, chunk string, own int").groupBy("lang", "chunk", "own").agg(F.count("*").alias("n"))


class Grams:
    """Hashes of the words of a batch of chunks; no two languages share a word's hash."""

    def __init__(self, batch: pa.RecordBatch, text: str):
        data, offsets = utf8(batch.column(text))
        self.words, self.data = Words(data, offsets, WORD), data
        words, lang = self.words, _lang_hash(batch.column("lang"))
        self.row = np.repeat(np.arange(batch.num_rows), words.count)
        self.word = join(lang[self.row], words.hash)

    def own(self, size: np.ndarray) -> np.ndarray:
        """Whether a word is one of the first ``size`` of its chunk, for every word."""
        return np.arange(len(self.word)) < np.repeat(self.words.first[:-1] + size, self.words.count)

    def broken(self) -> np.ndarray:
        """Whether a word and the next are in different pieces, for every word but the last."""
        end, gap = self.words.end[:-1], self.words.start[1:] - self.words.end[:-1]
        out = (self.row[1:] != self.row[:-1]) | BREAK[self.data[end]]
        wide = np.flatnonzero((gap > 1) & ~out)  # few: most words are one byte apart
        which, k = ragged(gap[wide])
        out[wide[which[BREAK[self.data[end[wide][which] + k]]]]] = True
        return out

    def whole(self, n: int) -> np.ndarray:
        """Whether the phrase of n words is in one piece, for every word it fits behind."""
        keep = max(0, len(self.word) - n + 1)
        whole, broken = np.ones(keep, bool), self.broken()
        for k in range(n - 1):
            whole &= ~broken[k : k + keep]
        return whole

    def of(self, n: int) -> np.ndarray:
        """Hashes of the phrases of n words that begin at every word they fit behind."""
        keep = max(0, len(self.word) - n + 1)
        gram = self.word[:keep]
        for k in range(1, n):
            gram = join(gram, self.word[k : k + keep])
        return gram


def _lang_hash(langs: pa.Array) -> np.ndarray:
    data, offsets = utf8(langs)
    return range_hash(data, offsets[:-1], offsets[1:])


def join(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase and the word behind it."""
    return mix(phrase * np.uint64(0xD1342543DE82EF95) + word)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


class Filter:
    """A Bloom filter of hashes with two places each."""

    SECOND = 0x9E3779B97F4A7C15

    @classmethod
    def places(cls, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shift = np.uint64(64 - FILTER_BITS)
        return (hashes >> shift).astype(np.int64), ((hashes * np.uint64(cls.SECOND)) >> shift).astype(np.int64)

    @classmethod
    def of(cls, frequent: DataFrame) -> np.ndarray:
        """The bits of the column ``gram``: made by the tasks, joined by Spark, 2 ** FILTER_BITS bits on the driver."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                places = np.unique(np.concatenate(cls.places(_unsigned(batch.column("gram")))))
                bits = np.left_shift(np.uint64(1), (places & 63).astype(np.uint64))
                cells, first = np.unique(places >> 6, return_index=True)
                if len(cells):
                    yield pa.RecordBatch.from_arrays([pa.array(cells), _signed(np.bitwise_or.reduceat(bits, first))], ["cell", "bits"])

        cells = frequent.select("gram").mapInArrow(run, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
        out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
        out[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy().view(np.uint64)
        return out

    @classmethod
    def has(cls, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        first, second = cls.places(hashes)
        found = cls._set(bits, first)
        likely = np.flatnonzero(found)
        found[likely] = cls._set(bits, second[likely])
        return found

    @staticmethod
    def _set(bits: np.ndarray, place: np.ndarray) -> np.ndarray:
        return (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) > 0


def _add_up(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one occurrence, sum of weights) of every distinct hash."""
    if not len(hashes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(hashes)
    run = hashes[order]
    first = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    return order[first], np.add.reduceat(weights[order], first)


def word_counts(dictionary: DataFrame) -> DataFrame:
    """lang, phrase (one word), a (its occurrences) and gram (its hash) of every word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "chunk", STEP_BYTES):
            grams = Grams(batch, "chunk")
            words = grams.words
            own = np.flatnonzero(grams.own(batch.column("own").to_numpy()))
            first, total = _add_up(grams.word[own], batch.column("n").to_numpy()[grams.row[own]])
            at = own[first]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(pa.array(grams.row[at])), _slices(grams.data, words.start[at], words.end[at]), pa.array(total)],
                ["lang", "phrase", "a"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.append_column("gram", _signed(Grams(batch, "phrase").word))

    summed = dictionary.mapInArrow(count, "lang string, phrase string, a long").groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return summed.mapInArrow(name, "lang string, phrase string, a long, gram long")


def runs(dictionary: DataFrame, pairs: Broadcast) -> DataFrame:
    """The dictionary with only the runs of three or more words whose neighbours pass the filter of pairs; a full stop ends each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "chunk", STEP_BYTES):
            grams = Grams(batch, "chunk")
            linked = grams.whole(2) & Filter.has(pairs.value, grams.of(2))
            linked = np.concatenate([[False], linked, [False]])  # of word k with the one before; with the next at k + 1
            both = np.concatenate([[False], linked[:-1] & linked[1:], [False]])[: len(grams.word) + 2]
            kept = both[:-2] | both[1:-1] | both[2:]
            before, after = linked[:-1][: len(kept)], linked[1:][: len(kept)]
            first, last = (np.flatnonzero(kept & ~side) for side in (before, after))
            if not len(first):
                continue
            start, size = grams.words.start[first], grams.words.end[last] - grams.words.start[first] + 1
            end = np.cumsum(size)
            at = np.repeat(start - (end - size), size)
            at += np.arange(end[-1])
            text = grams.data[np.minimum(at, len(grams.data) - 1)]
            text[end - 1] = ord(".")
            own = np.bincount(grams.row, kept & grams.own(batch.column("own").to_numpy()), batch.num_rows).astype(np.int32)
            row_end = np.cumsum(np.bincount(grams.row[first], size, batch.num_rows).astype(np.int32), dtype=np.int32)
            column = pa.StringArray.from_buffers(batch.num_rows, pa.py_buffer(np.append(np.int32(0), row_end)), pa.py_buffer(text))
            found = pa.RecordBatch.from_arrays([batch.column("lang"), column, pa.array(own), batch.column("n")], ["lang", "chunk", "own", "n"])
            yield found.filter(pa.array(own > 0))

    return dictionary.select("lang", "chunk", "own", "n").mapInArrow(run, "lang string, chunk string, own int, n long")


def longer_counts(dictionary: DataFrame, n: int, shorter: Broadcast, min_count: int) -> DataFrame:
    """before, last (hashes), a and gram of the phrases of n words that occur ``min_count`` times or more.

    shorter: the filter of the phrases of n - 1 words that do.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "chunk", STEP_BYTES):
            grams = Grams(batch, "chunk")
            before, whole = grams.of(n - 1), grams.whole(n)
            passed = Filter.has(shorter.value, before)
            at = np.flatnonzero(whole & grams.own(batch.column("own").to_numpy())[: len(whole)] & passed[: len(whole)] & passed[1 : len(whole) + 1])
            first, total = _add_up(join(before[at], grams.word[at + n - 1]), batch.column("n").to_numpy()[grams.row[at]])
            at = at[first]
            yield pa.RecordBatch.from_arrays([_signed(before[at]), _signed(grams.word[at + n - 1]), pa.array(total)], ["before", "last", "a"])

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("gram", _signed(join(_unsigned(batch.column("before")), _unsigned(batch.column("last")))))

    summed = dictionary.mapInArrow(count, "before long, last long, a long").groupBy("before", "last").agg(F.sum("a").alias("a"))
    return summed.where(F.col("a") >= min_count).mapInArrow(name, "before long, last long, a long, gram long")


def frequent(docs: DataFrame, *, min_count: int = 100, longest: int = 5, text_col: str = "text",
             lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang and n, its number of words; lang, phrase, words, a of all phrases up to ``longest`` words that are frequent)."""
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "collocations")

    def keep(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    dictionary = keep(parse(docs, longest=longest, text_col=text_col, lang_col=lang_col), "dictionary")
    words = keep(word_counts(dictionary), "words")
    levels = [words.where(F.col("a") >= min_count).select("lang", "phrase", F.lit(1).alias("words"), "a", "gram")]
    last_word = levels[0].select(F.col("gram").alias("last"), F.col("phrase").alias("last_word"))
    for n in range(2, longest + 1):
        bits = Filter.of(levels[-1])
        if not bits.any():
            break
        shorter = spark.sparkContext.broadcast(bits)
        if n == 3:
            dictionary = keep(runs(dictionary, shorter), "runs")
        spelled = levels[-1].select(F.col("gram").alias("before"), "lang", "phrase")
        found = longer_counts(dictionary, n, shorter, min_count).join(spelled, "before").join(last_word, "last")
        levels.append(keep(found.select("lang", F.concat_ws(" ", "phrase", "last_word").alias("phrase"), F.lit(n).alias("words"), "a", "gram"), f"{n}"))
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return words.groupBy("lang").agg(F.sum("a").alias("n")), every.drop("gram")


def _part(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def mine(docs: DataFrame, *, min_count: int = 100, longest: int = 5, top: int = 2000, cover: int = 100, text_col: str = "text",
         lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase's score is that of its weakest cut.  A phrase is left out where a longer one that holds it occurs at least
    ``cover`` per cent as often.  Sums and products of the score are decimals of 38 digits.
    """
    totals, phrases = frequent(docs, min_count=min_count, longest=longest, text_col=text_col, lang_col=lang_col)
    candidates = phrases.where("words > 1").withColumn("parts", F.split("phrase", " "))
    inner = candidates.where("words > 2").select(
        "lang", F.col("a").alias("longer"), "parts", "words",
        F.explode(F.expr("sequence(2, words - 1)")).alias("size"))
    inner = inner.select("lang", "longer", "parts", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("start"))
    inner = inner.select("lang", "longer", _part(F.col("parts"), F.col("start"), F.col("size")).alias("phrase"))
    held = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = (candidates.join(held, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (F.col("longer").cast("decimal(38,0)") * 100 < F.col("a").cast("decimal(38,0)") * cover)))
    cuts = kept.select("lang", "phrase", "a", "parts", "words", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _part(F.col("parts"), F.lit(1), F.col("k")).alias("first"),
                       _part(F.col("parts"), F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"))
    counts = phrases.select("lang", "phrase", "a")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l")), ["lang", "first"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r")), ["lang", "rest"])
    a, l, r, n = (f"cast({c} as decimal(19,0))" for c in ("1000 * a", "l", "r", "n"))
    scored = cuts.join(totals, "lang").withColumn("score", F.expr(f"({a} * {n}) div ({l} * {r})").cast("long"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))).where(F.col("rank") <= top)
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
