"""Exact Jaccard self-join of documents' word n-gram sets, and the groups that its links form.

Two sets link when 100 * |intersection| >= percent * |union|, by default 85 on 4-word shingles; then they differ in at
most (100 - percent) (a + b) / (100 + percent) elements, for sizes a and b.  Sizes fall into bands; a band splits the universe of shingles into segments by hash, so of two
linked sets all but that many segments agree (pigeonhole).  A set is indexed under those segments only that the
bound calls for, chosen by cost: those with most shingles, which the fewest other sets share.  Small sets, whose
segments would be nearly empty, get half as many segments and are indexed under each segment and its one-deletion
neighbourhood instead; the cheaper of both ways is taken band by band.  A set near a band's lower edge is indexed
in the band below as well.  Equal sets are one class and are indexed once.

Sets that share a key are candidates, verified exactly.  First every set is compared with the smallest document of
each of its keys; this links nearly all of a large group with work in proportion to its size.  Then only sets that
share a key and are not yet in one component can matter: of those, the pairs whose parity sketches (an exact lower
bound of their difference) leave a link possible are verified, so every link between components is found.

Shingles are known by 64-bit hashes.  Defined results: a null, empty or wordless text has no shingles and links with
nothing; with fewer words than the n-gram has, all words are the only shingle; repeated rows are equal sets; an id
with different texts is one document, linked by the least of them; a row without an id has the component of an equal
set, or null; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verdant.llm.arrays import Words, mix, steps, utf8
from verdant.llm.components import components
from verdant.session import scratch_path

#: Words are runs of bytes other than blanks.
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False

#: A band's sizes go from its first up to BAND times that.
BAND = 1.6
#: More segments than the bound calls for, so that the costly (nearly empty) ones need not be indexed.
SPARE = 1.25
#: What a key that many unrelated sets share costs, in keys.
SHARED_COST = 64.0

_ODD = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingles of every text."""
    words = Words(data, offsets, WORD)
    h, count = words.hash, len(words.hash)
    rolled = np.zeros(count, np.uint64)
    for k in range(n):
        keep = max(0, count - k)
        rolled[:keep] += h[k:] * _ODD[k % 4] * np.uint64(2 * (k // 4) + 1)
    rolled = mix(rolled)
    out = []
    for a, b in zip(words.first.tolist(), words.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            short = np.full(1, b - a, np.uint64)
            for k in range(b - a):
                short = short + h[a + k : a + k + 1] * _ODD[k % 4]
            out.append(mix(short))
        else:
            out.append(rolled[:0])
    return out


#: Least Jaccard similarity of linked sets, in per cent.
PERCENT = 85


def linked(common: int, a: int, b: int, percent: int = PERCENT) -> bool:
    return 100 * common >= percent * (a + b - common)


@lru_cache(None)
def band_starts(percent: int = PERCENT) -> list[int]:
    """First sizes of the bands; smaller sets (up to 5 shingles at 85 per cent) link only if equal."""
    if not 70 <= percent < 100:  # below, linked sets may lie two bands apart
        raise ValueError(f"percent is {percent}, not from 70 to 99")
    out = [-(-percent // (100 - percent))]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * BAND)))
    return out


@lru_cache(None)
def plan(band: int, percent: int = PERCENT) -> tuple[int, bool]:
    """(segments, whether one-deletion neighbourhoods are indexed) of a band: the cheaper way."""
    first, last = band_starts(percent)[band], band_starts(percent)[band + 1] - 1
    most = (100 - percent) * last // percent  # elements in which two linked sets may differ, one of them in this band and not the larger

    def few(mean: float, n: int) -> float:
        return sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(n + 1))

    exact, near = math.ceil((most + 1) * SPARE), (most + 2) // 2
    cost_exact = (most + 1) * (1 + SHARED_COST * few(first / exact, 1))
    cost_near = (last + near) * (1 + SHARED_COST * few(first / near, 2))
    return (near, True) if cost_near < cost_exact else (exact, False)


def keys(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """64-bit index keys of one set of sorted distinct shingles."""
    n, out, starts = len(tokens), [], band_starts(percent)
    if n < starts[0]:
        return np.zeros(0, np.uint64)
    own = int(np.searchsorted(starts, n, "right")) - 1
    below = starts[own] - 1
    for band, differ in ((own, (100 - percent) * n // percent), (own - 1, (100 - percent) * (n + below) // (100 + percent))):
        if band != own and (band < 0 or 100 * below < percent * n):
            continue  # no smaller set of the band below can link
        segments, near = plan(band, percent)
        where = (tokens % np.uint64(segments)).astype(np.int64)
        scrambled = mix(tokens)
        total = np.zeros(segments, np.uint64)
        np.add.at(total, where, scrambled)
        name = mix(np.arange(segments, dtype=np.uint64) + np.uint64((band + 1) << 32))
        if near:
            out += [mix(total ^ name), mix((total[where] - scrambled) ^ name[where])]
        else:
            key = mix(total ^ name)
            cost = -np.bincount(where, minlength=segments)
            out.append(key[np.lexsort((key, cost))[: differ + 1]])
    return np.unique(np.concatenate(out))


def digests(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2): the size and a 128-bit digest of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = shingle_sets(*utf8(batch.column("text")), n)
            d1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            d2 = np.array([mix(s ^ _ODD[0]).sum(dtype=np.uint64) for s in sets], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64))],
                ["doc_id", "n_shingles", "d1", "d2"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, d1 long, d2 long")


def index(docs: DataFrame, n: int, percent: int = PERCENT) -> DataFrame:
    """(doc_id, keys): every row's index keys.  Made from the texts anew rather than stored, as they are as large."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            found = [keys(s, percent) for s in shingle_sets(*utf8(batch.column("text")), n)]
            ends = np.append(0, np.cumsum([len(x) for x in found])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).view(np.int64)))], ["doc_id", "keys"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int = PERCENT) -> DataFrame:
    """Those (a, b) of the pairs that link, judged on the full sets made anew from both texts."""
    # sorted by b, so that a task makes b's set once for all its partners
    both = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b").sortWithinPartitions("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, None
        for batch in batches:
            for step in steps([batch], "text_a"):
                names, keep = step.column("b"), []
                for k, a in enumerate(shingle_sets(*utf8(step.column("text_a")), n)):
                    if names[k] != last:
                        last, other = names[k], shingle_sets(*utf8(step.column("text_b").slice(k, 1)), n)[0]
                    common = len(np.intersect1d(a, other, assume_unique=True)) if abs(len(a) - len(other)) * 100 <= (100 - percent) * max(len(a), len(other)) else 0
                    keep.append(linked(common, len(a), len(other), percent))
                yield step.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}")


def stored(df: DataFrame, *name: str) -> DataFrame:
    """The same rows, from a table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, "set_join", *name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Documents of one group that a task compares with each other; larger groups are cut into blocks, compared block by block.
GROUP_BLOCK = 2000
#: Bits of a sketch for each shingle of its set, before rounding up to a power of two.
SKETCH_BITS = 4


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Parities of the set's shingles in 2 ** k places: two sketches differ in no more places than the sets in elements."""
    bits = max(64, 1 << (SKETCH_BITS * len(tokens) - 1).bit_length())
    odd = np.bincount((mix(tokens ^ _ODD[3]) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Sketches [i, word] brought down to fewer places; parities stay parities."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def sketches(texts: DataFrame, n: int) -> DataFrame:
    """(doc_id, size, sketch) of every text."""
    kind = texts.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = shingle_sets(*utf8(batch.column("text")), n)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                                              pa.array([sketch(s).tobytes() for s in sets], pa.binary())], ["doc_id", "size", "sketch"])

    return texts.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, size long, sketch binary")


def groups(docs: DataFrame, *, n: int = 4, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id): one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sets = stored(digests(rows, n), "sets")
    named = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    digest = ["n_shingles", "d1", "d2"]
    classes = named.groupBy(*digest).agg(F.min("doc_id").alias("rep"))
    reps = classes.where(F.col("n_shingles") >= band_starts(percent)[0]).select(F.col("rep").alias("doc_id"))
    indexed = index(rows, n, percent).join(reps, "doc_id", "left_semi").select("doc_id", F.explode("keys").alias("key"))
    # repeated rows alone share nothing
    shared = indexed.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("key")
    found = stored(indexed.join(shared, "key", "left_semi").distinct(), "found")
    # the smallest document of every key that several classes share
    pivots = found.groupBy("key").agg(F.min("doc_id").alias("pivot"))
    members = stored(found.join(pivots, "key"), "members")
    involved = members.select("doc_id").distinct()
    texts = stored(rows.join(involved, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")), "texts")
    star = stored(members.where("doc_id > pivot").select(F.col("doc_id").alias("a"), F.col("pivot").alias("b")).distinct(), "star")
    links = stored(verified(star, texts, n, percent), "links")
    first = components(links)
    more = _across(star, first, stored(sketches(texts, n), "sketches"), percent)
    links = links.unionByName(verified(stored(more.join(star, ["a", "b"], "left_anti"), "more"), texts, n, percent))
    whole = components(stored(links, "all_links"))
    of_class = classes.join(whole.withColumnsRenamed({"node": "rep", "component": "least"}), "rep", "left").select(
        *digest, F.coalesce("least", "rep").alias("component_id"))
    out = sets.select("doc_id", *digest).join(of_class, digest, "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, *, n: int = 4, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, the one with the least id (null is the greatest).

    A row is named by its id, and by a hash of id and text where the id is null, no whole number, or has different texts, which
    are judged apart; of repeated rows one stays.  (All rows are compared with the least name of a key first: with ids that is
    mostly the text that the others were copied from, and nearer to them than they are to each other.)
    """
    own = "_name"
    while any(c.lower().startswith(own) for c in docs.columns):
        own += "_"
    ident, hashed = F.col(id_col), F.xxhash64(F.col(id_col), F.col(text_col))
    if isinstance(docs.schema[id_col].dataType, T.IntegralType):
        texts = docs.select(ident.alias(f"{own}id"), hashed.alias("hash")).groupBy(f"{own}id").agg(F.min("hash").alias("low"), F.max("hash").alias("high"))
        several = stored(texts.where((F.col("low") < F.col("high")) & F.col(f"{own}id").isNotNull()).select(f"{own}id"), "several_texts")
        keyed = docs.join(several, ident == F.col(f"{own}id"), "left")
        keyed = keyed.withColumn(own, F.when(ident.isNull() | F.col(f"{own}id").isNotNull(), hashed).otherwise(ident.cast("long"))).drop(f"{own}id")
    else:
        keyed = docs.withColumn(own, hashed)
    rows = keyed.select(F.col(own).alias("name"), ident.alias("id"), F.col(text_col).alias("text"))
    found = groups(rows, n=n, percent=percent, id_col="name").select(F.col("doc_id").alias("name"), "component_id").distinct()
    least = (rows.select("name", "id").distinct().join(found, "name").groupBy("component_id")
             .agg(F.min(F.struct(F.col("id").isNull(), "id", "name"))["name"].alias(own)))
    return keyed.join(stored(least.select(own), "least"), own, "left_semi").dropDuplicates([own]).drop(own)


def _across(star: DataFrame, found: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a > b) of documents that share a key, are in different components so far and may link by their sketches.

    Documents that share a key share its smallest document, so the groups are those of one smallest document: a pair
    meets once however many keys it shares.
    """
    labelled = (star.select(F.col("b").alias("pivot"), F.col("a").alias("doc_id")).join(found.withColumnsRenamed({"node": "doc_id"}), "doc_id", "left")
                .select("pivot", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    mixed = (labelled.groupBy("pivot").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
             .where("low < high").select("pivot", F.ceil(F.col("n") / GROUP_BLOCK).cast("int").alias("blocks")))
    # block i meets block j >= i: a document goes to one task for each other block, and to no task all documents of a large group
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    dealt = (labelled.join(mixed, "pivot").join(sketched, "doc_id").withColumn("own", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("pivot", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "doc_id", "component", "size", "sketch"))
    kind = star.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != last and held:
                    yield from _close_pairs(held, percent)
                    held = []
                last = row[:3]
                held.append(row)
        if held:
            yield from _close_pairs(held, percent)

    place = ["pivot", "i", "j"]
    return dealt.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _close_pairs(rows: list[tuple], percent: int = PERCENT) -> Iterator[pa.RecordBatch]:
    """Pairs of a block of rows whose sketches differ in no more places than linked sets may."""
    rows = sorted(rows, key=lambda r: r[6])
    _, i, j = rows[0][:3]
    own, ids, component, size = (np.array([r[k] for r in rows]) for k in (3, 4, 5, 6))
    words = np.array([len(r[7]) // 8 for r in rows])
    at = {w: np.flatnonzero(words == w) for w in np.unique(words).tolist()}
    table = {w: np.stack([np.frombuffer(rows[k][7], np.uint64) for k in places.tolist()]) for w, places in at.items()}
    for w, places in at.items():
        for v in (w, 2 * w):  # sizes of linked sets, and so their sketches' sizes, differ by a factor of two at most
            if v not in at:
                continue
            others, narrow = at[v], folded(table[v], w)
            for k, mine in zip(places.tolist(), table[w]):
                reach = slice(np.searchsorted(size[others], size[k]), np.searchsorted(size[others], 100 * size[k] // percent, "right"))
                y = others[reach]
                possible = (component[y] != component[k]) & ((own[y] != own[k]) if i != j else (y > k))
                differ = np.bitwise_count(narrow[reach][possible] ^ mine).sum(1, dtype=np.int64)
                y = y[possible]
                y = y[(100 + percent) * differ <= (100 - percent) * (size[y] + size[k])]
                if len(y):
                    yield pa.RecordBatch.from_arrays([pa.array(np.maximum(ids[y], ids[k])), pa.array(np.minimum(ids[y], ids[k]))], ["a", "b"])
