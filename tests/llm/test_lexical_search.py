"""Ranked lexical search against plain scoring of every pair; bounds that hold; subtrees that are pruned."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from verdant.llm import lexical_search as search_module
from verdant.llm.lexical_search import BallTree, Best, Queries, Rows, search, search_tree

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def brute(docs, items, top=10):
    counted = [(doc, Counter(terms(text))) for doc, text in docs if terms(text)]
    n, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 100 - 90 + 90 * sum(c.values()) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0 and doc is not None:
                scores.append((-score, doc))
        out += [(item, k + 1, doc, -score) for k, (score, doc) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def searched(spark, docs, items, parts=3, **options):
    left = spark.createDataFrame([(d, t, "x", d) for d, t in docs], "doc_id long, text string, item_id string, score long").repartition(parts)
    right = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")
    return sorted((tuple(r) for r in search(left, right, **options).collect()), key=str)


def sample(seed, n=400):
    rng = random.Random(seed)
    common, rare = ["the", "of", "And", "x2", "é", "日本"], [f"w{k}" for k in range(150)]
    def text(size):
        return "".join(rng.choice(common if rng.random() < 0.5 else rare) + rng.choice([" ", ", ", "-", "\n", "\x00"]) for _ in range(size))
    docs = [(k, text(rng.choice([0, 1, 5, 40, 200]))) for k in range(n)]
    docs += [(k + n, docs[k][1]) for k in range(40)] + [(9000, None), (9001, ""), (9002, "?!"), (None, "w1 w2 w3"), (-5, "w1 w2 " * 3000)]
    items = [(k, text(rng.choice([1, 8, 30]))) for k in range(20)] + [(50, None), (51, ""), (52, "the THE the"), (53, "unheard"), (None, "w7 w8"), (54, docs[7][1])]
    return docs, items


@pytest.mark.parametrize("seed", range(2))
def test_equal_to_plain_scoring(spark, seed):
    docs, items = sample(seed)
    assert searched(spark, docs, items) == brute(docs, items)


def test_blocks_of_queries_small_trees_and_top(spark, monkeypatch):
    docs, items = sample(5)
    monkeypatch.setattr(search_module, "BLOCK_BYTES", 1200)
    assert len(list(search_module._blocks(spark.createDataFrame(items, "id long, text string"), "id", "text"))) > 2
    assert searched(spark, docs, items, top=3) == brute(docs, items, 3)


def test_ties_go_to_the_smaller_id(spark):
    docs = [(k, "same words here") for k in range(60, 0, -1)] + [(100 + k, "other") for k in range(100)]
    assert [r[2] for r in searched(spark, docs, [(1, "words")], parts=5)] == [1, 10, 2, 3, 4, 5, 6, 7, 8, 9]


def test_common_terms_of_weight_nought_find_nothing(spark):
    assert searched(spark, [(k, "all") for k in range(2000)], [(1, "all")]) == []


def test_nothing(spark):
    assert searched(spark, [], [(1, "a")], parts=1) == [] and searched(spark, [(1, "a")], [], parts=1) == []
    assert searched(spark, [(1, None)], [(1, "a")], parts=1) == [] and searched(spark, [], [], parts=1) == []


def block(seed, docs, vocabulary, items):
    """Random rows over a vocabulary, and queries of it."""
    rng = np.random.default_rng(seed)
    queries = Queries([" ".join(f"t{t}" for t in rng.choice(vocabulary, 30, replace=False)) for _ in range(items)])
    rarity = rng.integers(1, 2000, queries.width)
    queries.weigh(rarity, 4000)
    parts = []
    for k in range(docs):
        column = np.flatnonzero(rng.random(queries.width) < 0.06)
        parts.append(Rows(np.array([k]), np.array([len(column)]), column, rng.integers(1, 10**6, len(column))))
    return Rows.joined(parts), queries


def scores(rows, queries):
    dense = np.zeros((len(rows.ids), queries.width), np.int64)
    dense[np.repeat(np.arange(len(rows.ids)), np.diff(rows.first)), rows.column] = rows.value
    return np.stack([dense[:, t] @ queries.weight[t] for t in (queries.term[a:b] for a, b in zip(queries.first, queries.first[1:]))], 1)


def test_no_document_scores_above_a_bound():
    rows, queries = block(1, 700, 500, 25)
    tree = BallTree(rows, queries)
    bounds, exact = tree.bounds(), scores(tree.rows, queries)
    assert len(tree.low) > 30 and sorted(tree.rows.ids.tolist()) == list(range(700))
    for node, (a, b) in enumerate(zip(tree.low, tree.high)):
        assert (exact[a:b].max(0) <= bounds[node]).all()


def test_one_document_has_its_own_score_as_bound():
    rows, queries = block(2, 1, 200, 10)
    bounds, exact = BallTree(rows, queries).bounds(), scores(rows, queries)
    assert np.allclose(bounds, exact, rtol=1e-3, atol=1e6)


def test_subtrees_are_pruned():
    """Passages held by a group of near documents: most of the tree is left out, and the ten best are right."""
    rows, queries = block(3, 4000, 600, 20)
    for k in range(15 * 20):  # fifteen documents hold each query
        item, at = k % 20, k * 13
        terms_ = np.sort(queries.term[queries.first[item] : queries.first[item + 1]])
        rows = Rows.joined([rows.take(np.delete(np.arange(len(rows.ids)), at)), Rows(np.array([10_000 + k]), np.array([len(terms_)]), terms_, np.full(len(terms_), 700_000 + k))])
    exact = scores(rows, queries)
    best = Best(np.ones(20, np.int64), 10)
    scored = search_tree(BallTree(rows, queries), best)
    for item in range(20):
        order = sorted(zip((-exact[:, item]).tolist(), rows.ids.tolist()))[:10]
        assert sorted((-s, -d) for s, d in best.heaps[item]) == order
    assert scored < 0.5 * 20 * len(rows.ids)


def test_floors_keep_equal_scores():
    rows, queries = block(4, 300, 300, 5)
    exact = scores(rows, queries)
    tenth = np.sort(exact, 0)[-10]
    best = Best(tenth, 10)
    search_tree(BallTree(rows, queries), best)
    for item in range(5):
        order = sorted(zip((-exact[:, item]).tolist(), rows.ids.tolist()))[:10]
        assert sorted((-s, -d) for s, d in best.heaps[item]) == order
