"""Approximate nearest neighbours by inner product with several shifted Hilbert curves.

A vector gets one more coordinate that brings all vectors to one length, and a query gets zero there, so the largest
inner product is the smallest distance.  Every curve projects the vectors to ``DIMS`` random directions, evens each out
by quantiles of a bounded sample, shifts them and orders them along a Hilbert curve.  Spark range-partitions each
order and cuts it into windows of bounded size by position, so no window is large, whatever the data.  A query is
compared with the windows within a reach of its own on every curve used; all that is found is merged and ranked by
the inner product of the original vectors in double precision.

The number of curves and the reach are chosen for the table at hand: the true neighbours of ``PROBES`` queries are found by
brute force, and of all choices that meet a share of ``RECALL`` of them the one with the fewest windows is taken.  One curve
with all windows, which is exact, is among the choices; vectors without structure, or a few long ones, lead there.

Equal vectors are one class: they are indexed once, with their ``k + 1`` least ids, which is all that a result can need.

Defined results: vectors that are null, empty or zero, or that hold null or non-finite components, and rows without an id
take no part; shorter vectors are as if filled up with zeros; repeated rows are one; with fewer than ``k`` other
vectors all come back; equal scores are ranked by id; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdant.session import scratch_path

CURVES = 10
DIMS = 8
CURVE_BITS = 7
#: Candidates of one window, and of one in large tables, which have MANY windows or more.
WINDOW = 4096
WIDEST = 16384
MANY = 64
#: Share of the true neighbours of so many queries that the windows must hold.
RECALL = 0.98
PROBES = 200
#: Vectors that the directions' quantiles are taken from, the first by a hash of their id.
SAMPLE = 4000
#: Queries that are compared with a window of WINDOW candidates at a time; fewer with a wider one.
QUERY_STEP = 256


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of integer points [i, dim] below 2 ** bits (Skilling's transform)."""
    x, dims = cells.astype(np.uint64).copy(), cells.shape[1]
    bit = np.uint64(1 << (bits - 1))
    while bit > 1:
        low = bit - np.uint64(1)
        for d in range(dims):
            up = (x[:, d] & bit) != 0
            swap = np.where(up, 0, (x[:, 0] ^ x[:, d]) & low).astype(np.uint64)
            x[:, 0] = np.where(up, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, d] ^= swap
        bit >>= np.uint64(1)
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn, bit = np.zeros(len(x), np.uint64), np.uint64(1 << (bits - 1))
    while bit > 1:
        turn ^= np.where(x[:, -1] & bit, bit - np.uint64(1), np.uint64(0))
        bit >>= np.uint64(1)
    x ^= turn[:, None]
    key = np.zeros(len(x), np.uint64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << np.uint64(1)) | ((x[:, d] >> np.uint64(b)) & np.uint64(1))
    return key


class Curves:
    def __init__(self, sample: np.ndarray, length: float, curves: int = CURVES, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.length, dims = length, sample.shape[1] + 1
        points = self.lift(sample)
        self.directions, self.quantiles, self.shifts = [], [], []
        for _ in range(curves):
            random = rng.standard_normal((dims, min(DIMS, dims)))
            self.directions.append(np.linalg.qr(random)[0])
            self.quantiles.append(np.quantile(points @ self.directions[-1], np.linspace(0, 1, 129), axis=0))
            self.shifts.append(rng.random(min(DIMS, dims)))

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.length**2 - (vectors**2).sum(1), 0)
        return np.hstack([vectors, np.sqrt(rest)[:, None]])

    def keys(self, vectors: np.ndarray, query: bool) -> list[np.ndarray]:
        if query:
            points = np.hstack([vectors * (self.length / np.linalg.norm(vectors, axis=1))[:, None], np.zeros((len(vectors), 1))])
        else:
            points = self.lift(vectors)
        out = []
        for directions, quantiles, shift in zip(self.directions, self.quantiles, self.shifts):
            flat = points @ directions
            even = np.stack([np.interp(flat[:, d], quantiles[:, d], np.linspace(0, 1, len(quantiles))) for d in range(flat.shape[1])], 1)
            cells = np.minimum((even + shift) / 2 * (1 << CURVE_BITS), (1 << CURVE_BITS) - 1).astype(np.uint64)
            out.append(hilbert(cells, CURVE_BITS))
        return out


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of floats, filled up with zeros to ``dims``."""
    sizes = column.value_lengths().to_numpy(False)
    out = np.zeros((len(column), dims))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = column.flatten().to_numpy(False)
    return out


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, "vector_search", name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def search(vectors: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest found of every query row, itself excepted."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks"))
    usable = (F.col("vec_id").isNotNull() & (F.size("vector") > 0)
              & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0))
    rows = rows.where(usable)
    first = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    classes = _stored(rows.select("vec_id", "vector").distinct().withColumn("n", first).where(F.col("n") <= k + 1)
                      .groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("rep", F.col("ids")[0]), "classes")
    shape = classes.agg(F.max(F.size("vector")), F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)), F.count("*")).first()
    if not shape[2]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims, length, total = shape[0], float(np.sqrt(shape[1])), shape[2]
    sample = classes.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").toArrow().column("vector").combine_chunks()
    curves = spark.sparkContext.broadcast(Curves(_matrix(sample, dims), length))
    asking = _stored(rows.where("asks").select("vec_id", "vector").distinct().join(classes.select("vector", "rep"), "vector").select("vec_id", "rep"), "asking")
    queries = classes.join(asking.select("rep").distinct(), "rep", "left_semi")

    def keys(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    for c, key in enumerate(curves.value.keys(_matrix(batch.column("vector"), dims), query)):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c, np.int32)), pa.array(key.astype(np.int64)), batch.column("rep"),
                                                          pa.array(np.full(len(key), query))], ["curve", "key", "rep", "asks"])
        return run

    schema = "curve int, key long, rep long, asks boolean"
    points = classes.select("rep", "vector").mapInArrow(keys(False), schema).unionByName(queries.select("rep", "vector").mapInArrow(keys(True), schema))
    size = min(max(WINDOW, total // MANY), max(WINDOW, WIDEST))
    placed = _place(points, total, size)
    curves_used, reach = _choose(placed, _truth(queries, classes, dims, k), -(-total // size))
    met = _stored(_compare(placed.where(F.col("curve") < curves_used), classes, dims, k + 1, reach, (total - 1) // size), "met")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "found")
    near = (met.groupBy("query", "found").agg(F.max("score").alias("score")).withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n"))
    each = (near.join(classes.select(F.col("rep").alias("found"), "ids"), "found").select("query", "score", F.explode("ids").alias("id"))
            .withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))).where(F.col("n") <= k + 1))
    # the k + 1 nearest of a class serve all its queries; each leaves itself out
    lists = each.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("list"))
    own = (asking.join(lists, asking["rep"] == lists["query"])
           .select(F.col("vec_id").alias("query_id"), F.slice(F.filter("list", lambda x: x["id"] != F.col("vec_id")), 1, k).alias("list")))
    return (own.select("query_id", F.posexplode("list").alias("rank", "x"))
            .select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score")))


def _truth(queries: DataFrame, classes: DataFrame, dims: int, k: int) -> DataFrame:
    """(query, found): the ``k`` nearest other vectors of PROBES queries, the first by a hash of their id, by brute force."""
    probes = queries.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(PROBES).select("rep", "vector").toArrow().combine_chunks()
    if not probes.num_rows:
        return queries.sparkSession.createDataFrame([], "query long, found long")
    asking = probes.column("rep").to_numpy()
    asked = classes.sparkSession.sparkContext.broadcast(_matrix(probes.column("vector").combine_chunks(), dims))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, names = np.zeros((len(asking), 0)), np.zeros((len(asking), 0), np.int64)
        for batch in batches:
            found = np.broadcast_to(batch.column("rep").to_numpy(), (len(asking), batch.num_rows))
            near = np.where(found == asking[:, None], -np.inf, asked.value @ _matrix(batch.column("vector"), dims).T)
            scores, names = np.hstack([scores, near]), np.hstack([names, found])
            best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
            scores, names = np.take_along_axis(scores, best, 1), np.take_along_axis(names, best, 1)
        row, column = np.nonzero(scores > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(asking[row]), pa.array(names[row, column]), pa.array(scores[row, column])], ["query", "found", "score"])

    each = classes.select("rep", "vector").mapInArrow(run, "query long, found long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "found")
    return _stored(each.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).select("query", "found"), "truth")


def _choose(placed: DataFrame, truth: DataFrame, windows: int) -> tuple[int, int]:
    """(curves, reach): those that meet RECALL of the true neighbours with the fewest windows a query."""
    there = placed.where("not asks").join(F.broadcast(truth), F.col("rep") == F.col("found")).select("curve", "query", "found", "window")
    own = (placed.where("asks").join(F.broadcast(truth.select("query").distinct()), F.col("rep") == F.col("query"))
           .select("curve", "query", F.col("window").alias("own")))
    # at most PROBES * k * CURVES rows
    apart = (there.join(own, ["curve", "query"]).groupBy("query", "found")
             .agg(F.array_sort(F.collect_list(F.struct("curve", F.abs(F.col("window") - F.col("own")).alias("apart"))))["apart"].alias("apart")).select("apart").collect())
    if not apart:
        return 1, windows
    least = np.sort(np.minimum.accumulate(np.array([r.apart for r in apart]), axis=1), axis=0)
    reach = least[int(np.ceil(RECALL * len(least))) - 1]
    cost = np.arange(1, len(reach) + 1) * np.minimum(2 * reach + 1, windows)
    best = int(np.argmin(cost))
    if cost[best] >= windows:  # no dearer: all of them, once
        return 1, windows
    return best + 1, int(reach[best])


def _place(points: DataFrame, total: int, size: int) -> DataFrame:
    """(curve, window, rep, asks): where every point stands among the candidates of its curve."""
    spark = points.sparkSession
    parts = max(1, -(-total * CURVES // 500_000))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            asks = batch.column("asks").to_numpy(False)
            place = before + np.cumsum(~asks) - ~asks
            before += int((~asks).sum())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(asks), part, np.int32)), batch.column("curve"), pa.array(place.astype(np.int64)), batch.column("rep"),
                                              batch.column("asks")], ["part", "curve", "place", "rep", "asks"])

    order = ["curve", "key", "asks", "rep"]
    placed = _stored(points.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(
        number, "part int, curve int, place long, rep long, asks boolean"), "placed")
    # one row for each of the range partitions
    counts = placed.where("not asks").groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect()
    before, at = [], 0
    sizes = {r.part: r.n for r in counts}
    for part in range(max([*sizes, 0]) + 2):
        before.append((part, at))
        at += sizes.get(part, 0)
    offsets = spark.createDataFrame(before, "part int, before long")
    place = F.col("place") + F.coalesce("before", F.lit(at)) - F.col("curve") * F.lit(total)
    last = (total - 1) // size
    return placed.join(F.broadcast(offsets), "part", "left").select(
        "curve", F.least(F.floor(place / size), F.lit(last)).cast("long").alias("window"), "rep", "asks")


def _compare(placed: DataFrame, classes: DataFrame, dims: int, keep: int, reach: int, last: int) -> DataFrame:
    """(query, found, score): the ``keep`` best of every window that a query meets."""
    around = F.when(F.col("asks"), F.sequence(F.greatest(F.col("window") - reach, F.lit(0).cast("long")), F.least(F.col("window") + reach, F.lit(last).cast("long")))
                    ).otherwise(F.array("window"))
    dealt = (placed.join(classes.select("rep", "vector"), "rep").withColumn("window", F.explode(around))
             .repartition("curve", "window").sortWithinPartitions("curve", "window", "asks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, names, matrix, held, size = None, None, None, [], 0

        def compare(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            points, asking = _matrix(batch.column("vector"), dims), batch.column("rep").to_numpy()
            step = max(1, QUERY_STEP * WINDOW // max(WINDOW, len(matrix)))
            for a in range(0, len(asking), step):
                scores = points[a : a + step] @ matrix.T
                n = min(keep, scores.shape[1])
                best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
                limit = np.take_along_axis(scores, best, 1).min(1)
                row, column = np.nonzero(scores >= limit[:, None])  # with all that are as near as the last
                if len(row) > 4 * best.size:  # many alike: the least ids of them are enough
                    order = np.lexsort((names[column], -scores[row, column], row))
                    row, column = row[order], column[order]
                    at = np.arange(len(row)) - np.searchsorted(row, row)
                    row, column = row[at < keep], column[at < keep]
                yield pa.RecordBatch.from_arrays([pa.array(asking[a + row]), pa.array(names[column]), pa.array(scores[row, column])], ["query", "found", "score"])

        for batch in batches:
            pair = batch.column("curve").to_numpy().astype(np.int64) << 40 | (batch.column("window").to_numpy() + 1)
            asks = batch.column("asks").to_numpy(False)
            cut = np.flatnonzero((np.diff(pair) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(pair)]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if pair[a] != window:
                    window, held, matrix = pair[a], [], None
                if not asks[a]:
                    held.append((part.column("rep").to_numpy(), _matrix(part.column("vector"), dims)))
                elif held or matrix is not None:
                    if held:
                        names, matrix, held = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), []
                    yield from compare(part)

    return dealt.select("curve", "window", "rep", "asks", "vector").mapInArrow(run, "query long, found long, score double")
