"""Exact ranked lexical search with ball trees over sparse term vectors.

A document's vector has one integer for each term, ``(1000000000 * tf) div (1000 * tf + 8 * m)``, where m grows with its
length; a query's has the integer weight w of its terms, so a score is an exact 64-bit inner product.  Only terms of the
queries can count, so vectors are cut to these, and are stored once in the shared folder.

The space is a product of subspaces of ``GROUP`` terms each, of one query where a term is of one query only.  Every task
builds ball trees over its documents, one for each batch of bounded size: a node has the centroid of its documents and, in
every subspace, the distance of the farthest (the radius).  By Cauchy-Schwarz no document in it scores above
``q . centroid`` plus the sum of ``|q| * radius`` of the subspaces.  (With one radius in the whole space the bounds of texts
whose rare terms are independent prune next to nothing.)  Bounds are rounded up by more than all rounding errors together.
Each query descends best-first and stops where the next bound is below its floor; documents at the leaves are scored exactly.

A query's floor is its worst kept score.  It goes on from tree to tree in a task, and rounds over a share of the documents
(``ROUNDS``, by hash of the id) come first: the k-th best score of a part of the documents is a floor of that of all.  The
last round, over every document, alone gives the result.

Statistics (documents, terms, and documents that hold a query term) come from all documents.  The queries are gone through in
blocks of bounded size, which alone are broadcast; terms are known by 64-bit hashes.

Defined results: a null or empty text or item has no terms, is not counted and finds nothing; repeated rows are documents of
their own, ranked by id and then in no set order; rows without an id count and are not returned; repeated items with one id are
each answered; empty tables give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verdant.llm.arrays import Words, ragged, steps, utf8
from verdant.session import scratch_path

TOP = 10
#: Most bytes of query text that are collected and broadcast together; more go in several blocks.
BLOCK_BYTES = 4 << 20
#: A tree has at most so many documents and so many numbers in its vectors; a leaf at most LEAF documents.
TREE_ROWS, TREE_CELLS, LEAF = 4096, 1 << 21, 32
#: Terms of a subspace.
GROUP = 6
#: One document in so many takes part in each round of search; the last is over all.
ROUNDS = (64, 8, 1)
#: Most numbers of a block of centroids that meet the queries together.
BOUND_CELLS = 1 << 22
#: Groups in which a query's best documents are joined before the last step.
RANK_PARTS = 64
#: Bounds are raised by this share; sums of n terms in doubles err by less than n * 2**-52 of their absolute size.
SLACK = 1e-9

#: Bytes of terms: digits, letters (A-Z are lower-cased) and all of every character beyond ASCII.
WORD = np.zeros(256, bool)
WORD[ord("0") : ord("9") + 1] = WORD[ord("a") : ord("z") + 1] = WORD[ord("A") : ord("Z") + 1] = WORD[128:] = True


class Queries:
    """The distinct terms of a block of items: ``vocabulary`` is sorted; item i has terms term[first[i]:first[i + 1]]."""

    def __init__(self, texts: list[str]):
        words = Words(*utf8(pa.array(texts, pa.string())), WORD)
        item = np.repeat(np.arange(len(texts)), words.count)
        self.vocabulary, term = np.unique(words.hash, return_inverse=True)
        self.width = len(self.vocabulary)
        pairs = np.unique(item * max(1, self.width) + term)
        self.item, self.term = np.divmod(pairs, max(1, self.width))
        self.first = np.searchsorted(self.item, np.arange(len(texts) + 1))

    def weigh(self, df: np.ndarray, documents: int) -> None:
        """The weight of every term: the logarithm of its rarity, in thousandths, rounded down; and the subspaces.

        Columns of vectors are the vocabulary in the order ``column``, in which a subspace is a range.
        """
        weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1))).astype(np.int64)
        owner = np.zeros(self.width, np.int64)
        owner[self.term] = self.item + 1
        owner[np.bincount(self.term, minlength=self.width) > 1] = 0  # shared terms
        order = np.lexsort((weight, owner))
        self.column = np.empty(self.width, np.int64)
        self.column[order] = np.arange(self.width)
        owner = owner[order]
        place = np.arange(self.width) - np.searchsorted(owner, owner)
        starts = (place % GROUP == 0) | (owner != np.append(-1, owner[:-1]))
        self.space = np.cumsum(starts) - 1
        self.spaces = int(starts.sum())
        self.weight = weight[order]
        self.term = self.column[self.term]
        square = np.square(self.weight[self.term].astype(float))
        pairs, which = np.unique(self.item * max(1, self.spaces) + self.space[self.term], return_inverse=True)
        self.pair_item, self.pair_space = np.divmod(pairs, max(1, self.spaces))
        self.pair_norm = np.sqrt(np.bincount(which, square, len(pairs)))
        self.pair_first = np.searchsorted(self.pair_item, np.arange(len(self.first)))


class Rows:
    """Sparse rows: row i has columns column[first[i]:first[i + 1]], ascending, with these values."""

    def __init__(self, ids: np.ndarray, count: np.ndarray, column: np.ndarray, value: np.ndarray):
        self.ids, self.column, self.value = ids, column, value
        self.first = np.append(0, np.cumsum(count))

    def take(self, rows: np.ndarray) -> Rows:
        count = np.diff(self.first)[rows]
        row, at = ragged(count)
        cell = self.first[rows][row] + at
        return Rows(self.ids[rows], count, self.column[cell], self.value[cell])

    @staticmethod
    def joined(parts: list[Rows]) -> Rows:
        return Rows(*(np.concatenate([f(p) for p in parts]) for f in (
            lambda p: p.ids, lambda p: np.diff(p.first), lambda p: p.column, lambda p: p.value)))


class BallTree:
    """Nodes over rows that are sorted so that a node is a range low[i]:high[i]; the children of node i are ``child[i]``."""

    def __init__(self, rows: Rows, queries: Queries):
        self.queries, self.width = queries, queries.width
        order, self.low, self.high, self.child = self._split(rows)
        self.rows = rows.take(order)
        self._measure()

    def _split(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Halves every node by its rows' places between two rows far from each other."""
        order, low, high, child = np.arange(len(rows.ids)), [], [], []
        todo = [(0, len(order), -1)]
        while todo:
            a, b, parent = todo.pop()
            node = len(low)
            low.append(a)
            high.append(b)
            child.append([])
            if parent >= 0:
                child[parent].append(node)
            if b - a <= LEAF:
                continue
            part = rows.take(order[a:b])
            row = np.repeat(np.arange(b - a), np.diff(part.first))
            value = part.value * self.queries.weight[part.column].astype(float)  # as much as it can add to a score

            def dots(vector: np.ndarray) -> np.ndarray:
                return np.bincount(row, value * vector[part.column], b - a)

            def dense(k: int) -> np.ndarray:
                out = np.zeros(self.width)
                out[part.column[part.first[k] : part.first[k + 1]]] = value[part.first[k] : part.first[k + 1]]
                return out

            square = np.bincount(row, value * value, b - a)
            centre = np.bincount(part.column, value, self.width) / (b - a)
            one = int(np.argmax(square - 2 * dots(centre)))
            toward_one = dots(dense(one))
            two = int(np.argmax(square - 2 * toward_one))
            side = toward_one - dots(dense(two))
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(side, half)]
            todo += [(a + half, b, node), (a, a + half, node)]
        return order, np.array(low), np.array(high), child

    def _measure(self) -> None:
        """The radius of every node about its centroid in every subspace, raised by what rounding can take."""
        rows, space, spaces = self.rows, self.queries.space, self.queries.spaces
        row = np.repeat(np.arange(len(rows.ids)), np.diff(rows.first))
        value = rows.value.astype(float)
        runs = np.flatnonzero(np.diff(row * max(1, spaces) + space[rows.column], prepend=-1))  # a row's cells in one subspace
        square = np.add.reduceat(value * value, runs) if len(runs) else value
        self.radius = np.zeros((len(self.low), spaces))
        for node in range(len(self.low)):
            a, b = np.searchsorted(runs, rows.first[[self.low[node], self.high[node]]])
            centre = self.centroid(node)
            own = np.bincount(space, centre * centre, spaces)
            far = own * (1 + SLACK)  # of rows with nothing in a subspace
            if b > a:
                cells = slice(runs[a], rows.first[self.high[node]])
                dot = np.add.reduceat(value[cells] * centre[rows.column[cells]], runs[a:b] - runs[a])
                at = space[rows.column[runs[a:b]]]
                far[np.bincount(at, minlength=spaces) == self.high[node] - self.low[node]] = 0
                np.maximum.at(far, at, square[a:b] - 2 * dot + own[at] + SLACK * (square[a:b] + 2 * dot + own[at]))
            self.radius[node] = np.sqrt(np.maximum(far, 0))

    def centroid(self, node: int) -> np.ndarray:
        cells = slice(self.rows.first[self.low[node]], self.rows.first[self.high[node]])
        return np.bincount(self.rows.column[cells], self.rows.value[cells].astype(float), self.width) / max(1, self.high[node] - self.low[node])

    def bounds(self) -> np.ndarray:
        """[node, item]: no row of the node scores above it, whatever the rounding."""
        queries = self.queries
        out = np.empty((len(self.low), len(queries.first) - 1))
        step = max(1, BOUND_CELLS // max(1, len(queries.term)))
        weight = queries.weight[queries.term].astype(float)
        for a in range(0, len(self.low), step):
            nodes = range(a, min(a + step, len(self.low)))
            centres = np.stack([self.centroid(node) for node in nodes])
            out[a : a + step] = (_sums(centres[:, queries.term] * weight, queries.first)
                                 + _sums(self.radius[nodes.start : nodes.stop, queries.pair_space] * queries.pair_norm, queries.pair_first))
        return out * (1 + SLACK)


def _sums(products: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the columns first[i]:first[i + 1], raised by what the running sums can lose."""
    total = np.concatenate([np.zeros((len(products), 1)), np.cumsum(products, 1)], 1)
    return total[:, first[1:]] - total[:, first[:-1]] + SLACK * total[:, -1:]


class Best:
    """The best documents of every item that a task has met: (score, -id) in a heap of ``top``."""

    def __init__(self, floors: np.ndarray, top: int):
        self.heaps, self.top, self.floors = [[] for _ in floors], top, floors.tolist()

    def floor(self, item: int) -> int:
        """A score below this cannot be among the best; one that equals it still can, by its id."""
        heap = self.heaps[item]
        return max(heap[0][0], self.floors[item]) if len(heap) == self.top else self.floors[item]

    def add(self, item: int, score: int, doc: int) -> None:
        heap = self.heaps[item]
        if len(heap) < self.top:
            heappush(heap, (score, -doc))
        elif (score, -doc) > heap[0]:
            heapreplace(heap, (score, -doc))


def search_tree(tree: BallTree, best: Best) -> int:
    """Every item's search through one tree, best bound first; returns the number of documents scored, over all items."""
    queries, bounds, scored, leaves = tree.queries, tree.bounds(), 0, {}
    weight = np.zeros(tree.width, np.int64)
    for item in range(len(queries.first) - 1):
        terms = queries.term[queries.first[item] : queries.first[item + 1]]
        if not len(terms) or bounds[0, item] < best.floor(item):
            continue
        weight[terms] = queries.weight[terms]
        queue = [(-bounds[0, item], 0)]
        while queue:
            bound, node = heappop(queue)
            if -bound < best.floor(item):
                break
            if tree.child[node]:
                for child in tree.child[node]:
                    if bounds[child, item] >= best.floor(item):
                        heappush(queue, (-bounds[child, item], child))
                continue
            if node not in leaves:
                a, b = tree.low[node], tree.high[node]
                first = tree.rows.first[a : b + 1]
                cells = slice(first[0], first[-1])
                leaves[node] = (tree.rows.ids[a:b], first - first[0], tree.rows.column[cells], tree.rows.value[cells])
            ids, first, column, value = leaves[node]
            total = np.append(0, np.cumsum(weight[column] * value))  # exact: 64-bit integers
            score = total[first[1:]] - total[first[:-1]]
            scored += len(ids)
            for k in np.flatnonzero(score >= best.floor(item)).tolist():
                best.add(item, int(score[k]), int(ids[k]))
        weight[terms] = 0
    return scored


def term_counts(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n (terms), term (places in the vocabulary, ascending) and tf (occurrences) of the documents that have terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, width = shared.value, max(1, len(shared.value))
        for batch in steps(batches, "text"):
            words = Words(*utf8(batch.column("text")), WORD)
            place = np.searchsorted(known, words.hash)
            place[place == len(known)] = 0
            hit = np.flatnonzero(known[place] == words.hash) if len(known) else np.zeros(0, np.int64)
            text = np.searchsorted(words.first, hit, "right") - 1
            cell, tf = np.unique(text * width + place[hit], return_counts=True)
            cuts = pa.array(np.searchsorted(cell, np.arange(batch.num_rows + 1) * width), pa.int32())
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x, pa.int32())) for x in (cell % width, tf)]
            rows = pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words.count, pa.int64()), *lists], ["doc_id", "n", "term", "tf"])
            yield rows.filter(pa.array(words.count > 0))

    return docs.mapInArrow(run, "doc_id long, n long, term array<int>, tf array<int>")


def _vectors(batch: pa.RecordBatch, queries: Queries, documents: int, length: int) -> Rows:
    """The vectors of stored term counts."""
    count = np.diff(batch.column("term").offsets.to_numpy())
    column = queries.column[batch.column("term").flatten().to_numpy()]
    tf = batch.column("tf").flatten().to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(count)), count)
    m = 10 + 90 * batch.column("n").to_numpy() * documents // length
    value = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
    order = np.argsort(row * max(1, queries.width) + column)
    return Rows(batch.column("doc_id").to_numpy(), count, column[order], value[order])


def _blocks(items: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of the items in blocks of at most about BLOCK_BYTES, which the driver collects one by one."""
    rows = items.select(F.col(item_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, -(-size // (BLOCK_BYTES // 2)))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k) if n > 1 else rows
        found = part.toArrow()
        yield found.column("id").combine_chunks(), found.column("text").to_pylist()


def _round(counts: DataFrame, queries: Queries, floors: np.ndarray, documents: int, length: int, top: int) -> DataFrame:
    """The best rows of every item: number (of the item), doc_id, score, rank; at least those at or above the floors."""
    shared = counts.sparkSession.sparkContext.broadcast((queries, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, floors = shared.value
        best, held = Best(floors, top), []

        def flush() -> None:
            rows = Rows.joined(held)
            for a in range(0, len(rows.ids), TREE_ROWS):
                search_tree(BallTree(rows.take(np.arange(a, min(a + TREE_ROWS, len(rows.ids)))), queries), best)
            held.clear()

        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                held.append(_vectors(batch.slice(a, 512), queries, documents, length))
                if sum(len(h.ids) for h in held) >= TREE_ROWS or sum(len(h.value) for h in held) >= TREE_CELLS:
                    flush()
        if held:
            flush()
        item = np.repeat(np.arange(len(floors)), [len(h) for h in best.heaps])
        pairs = [p for h in best.heaps for p in h]
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array([-d for _, d in pairs], pa.int64()), pa.array([s for s, _ in pairs], pa.int64())], ["number", "doc_id", "score"])

    found = counts.where(F.col("doc_id").isNotNull()).mapInArrow(run, "number long, doc_id long, score long")
    order = [F.desc("score"), F.asc("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(RANK_PARTS))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("number", salt).orderBy(*order))).where(F.col("rank") <= top)
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("number").orderBy(*order))).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``top`` documents of every item with scores above 0: item_id, rank (from 1), doc_id, score.

    Document ids are whole numbers.
    """
    spark, root = docs.sparkSession, scratch_path(docs.sparkSession, "lexical_search")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    item_type = items.schema[item_col].dataType.simpleString()
    found = None
    for block, (ids, texts) in enumerate(_blocks(items, item_col, item_text_col)):
        queries = Queries(texts)
        term_counts(rows, queries.vocabulary).write.parquet(f"{root}/{block}")
        counts = spark.read.parquet(f"{root}/{block}")
        documents, length = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        held = counts.select(F.explode("term").alias("term")).groupBy("term").count().toArrow()
        df = np.zeros(queries.width, np.int64)
        df[held.column("term").to_numpy()] = held.column("count").to_numpy()
        queries.weigh(df, documents)
        floors = np.ones(len(ids), np.int64)
        for one_in in ROUNDS[:-1]:
            part = counts.where(F.pmod(F.xxhash64("doc_id"), F.lit(one_in)) == 0)
            low = _round(part, queries, floors, documents, length, top).where(F.col("rank") == top).toArrow()
            number = low.column("number").to_numpy()
            floors[number] = np.maximum(floors[number], low.column("score").to_numpy())
        shared = spark.sparkContext.broadcast(ids)

        def name(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [shared.value.take(batch.column("number")), *(batch.column(c) for c in ("rank", "doc_id", "score"))], ["item_id", "rank", "doc_id", "score"])

        part = _round(counts, queries, floors, documents, length, top).select("number", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        part = part.mapInArrow(name, f"item_id {item_type}, rank int, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    return found
