"""The n-gram Jaccard join and its components against all pairs."""

import re

import numpy as np
import pytest

from verdant.llm import queries, set_join
from verdant.llm.components import components

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def sets(rows, n=4):
    out = {}
    for i, text in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}
    return out


def brute(rows, n=4, percent=85):
    every, parent = sets(rows, n), {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    ids = [i for i in every if every[i]]
    for a in ids:
        for b in ids:
            if a < b:
                common = len(every[a] & every[b])
                if 100 * common >= percent * (len(every[a]) + len(every[b]) - common):
                    p, q = find(a), find(b)
                    parent[max(p, q)] = min(p, q)
    return {i: (len(every[i]), find(i)) for i in every}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def fixture():
    rng = np.random.default_rng(11)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for size in (5, 9, 10, 12, 16, 25, 40, 70, 130, 300, 800):
        for _ in range(2):
            base = list(rng.choice(vocabulary, size))
            texts.append(base)
            for edits in (0, 1, 1, 2, 3, 5, 9, 15):
                copy = list(base)
                for _ in range(min(edits, size // 5)):
                    copy[rng.integers(0, len(copy))] = str(rng.choice(vocabulary))
                texts.append(copy + list(rng.choice(vocabulary, int(rng.integers(0, 3)))))
            texts.append(base[: int(size * 0.9)])
            texts.append(base + base[: size // 6])
    return [" ".join(t) for t in texts] + [None, "", " \t\n", "one", "One", "one two three", "ONE two\tthree", "é è ê ë", "a " * 900, "a " * 950, "A " * 3]


@pytest.mark.parametrize("block", [set_join.GROUP_BLOCK, 3])
def test_equals_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(set_join, "GROUP_BLOCK", block)
    rows = list(enumerate(fixture()))
    np.random.default_rng(2).shuffle(rows)
    docs = spark.createDataFrame([(int(i), t, "x") for i, t in rows], "doc_id long, text string, key string")
    assert result(set_join.groups(docs)) == brute(rows)


def test_repeated_rows_null_ids_empty_table(spark):
    text = "a b c d e f g h i j k l"
    docs = spark.createDataFrame([(3, text), (3, text), (None, text), (2, text + " m"), (5, "z")], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in set_join.groups(docs).collect())
    assert got == [("2", 10, 2), ("3", 9, 2), ("3", 9, 2), ("5", 1, 5), ("None", 9, 2)]
    assert set_join.groups(docs.limit(0)).count() == 0


def test_bound_holds_for_all_sizes():
    """No two linked sets differ in more elements than keys are indexed for, and their bands meet."""
    starts = set_join.band_starts()
    for a in range(6, 400):
        for b in range(a, 20 * a // 17 + 1):
            if not set_join.linked(a, a, b):
                continue
            differ = a + b - 2 * next(c for c in range(a + 1) if set_join.linked(c, a, b))
            assert differ <= 3 * a // 17 and differ <= 3 * (a + b) // 37
            band = int(np.searchsorted(starts, a, "right")) - 1
            segments, near = set_join.plan(band)
            assert (2 * segments if near else segments) > differ
            assert b < starts[band + 1] or 100 * (starts[band + 1] - 1) >= 85 * b


def test_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(4)
    for n in (1, 6, 40, 700):
        a = np.unique(rng.integers(0, 1 << 60, n).astype(np.uint64))
        for d in (0, 1, n // 3):
            b = np.unique(np.append(a[d:], rng.integers(0, 1 << 60, d + n // 2).astype(np.uint64)))
            x, y = set_join.sketch(a)[None], set_join.sketch(b)[None]
            w = min(x.shape[1], y.shape[1])
            differ = int(np.bitwise_count(set_join.folded(x, w) ^ set_join.folded(y, w)).sum())
            assert differ <= len(np.setxor1d(a, b))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(100)] + [(300 + i, 300) for i in range(50)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{300 + i: 300 for i in range(50)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    expected = brute([(r.doc_id, r.text) for r in docs])
    assert result(queries.op10_set_join(spark, SF)) == expected
    assert len({c for _, c in expected.values()}) < len(expected)


def pairs_of(rows, n, percent):
    every = {i: s for i, s in sets(rows, n).items() if s}
    return [(a, b) for a in every for b in every if a < b and 100 * len(every[a] & every[b]) >= percent * len(every[a] | every[b])]


@pytest.mark.parametrize("n, percent", [(5, 80), (4, 85), (3, 70)])
def test_threshold_and_shingles_are_parameters(spark, n, percent):
    """The groups are those of all pairs that link, whatever the threshold."""
    rows = list(enumerate(fixture()))
    parent = list(range(len(rows)))
    links = pairs_of(rows, n, percent)
    for _ in rows:  # the least of a component reaches all of it in so many rounds
        before = list(parent)
        for a, b in links:
            parent[a] = parent[b] = min(parent[a], parent[b])
        if parent == before:
            break
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in set_join.groups(docs, n=n, percent=percent).collect()} == dict(enumerate(parent))


@pytest.mark.parametrize("percent", [70, 80])
def test_bound_follows_the_threshold(percent):
    starts = set_join.band_starts(percent)
    assert not any(set_join.linked(a, a, a + 1, percent) for a in range(1, starts[0]))
    for a in range(starts[0], 200):
        for b in range(a, 100 * a // percent + 1):
            differ = a + b - 2 * next(c for c in range(a + 1) if set_join.linked(c, a, b, percent))
            assert differ <= (100 - percent) * a // percent and differ <= (100 - percent) * (a + b) // (100 + percent)
            band = int(np.searchsorted(starts, a, "right")) - 1
            segments, near = set_join.plan(band, percent)
            assert (2 * segments if near else segments) > differ
            assert b < starts[band + 1] or (b < starts[band + 2] and 100 * (starts[band + 1] - 1) >= percent * b)


def test_keep_one_judges_rows_by_their_own_text(spark):
    """Texts that share an id are rows of their own; copies without an id are copies."""
    text = " ".join(f"a{i}" for i in range(40))
    clean, other = " ".join(f"z{i}" for i in range(40)), " ".join(f"c{i}" for i in range(40))
    rows = [(1, text), (7, text + " x"), (7, clean), (None, other), (None, other), (None, other + " y"), (None, text), (9, ""), (8, ""), (8, ""), (5, None)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_chars int")
    got = {(r.doc_id, r.text) for r in set_join.keep_one(docs).collect()}
    kept_other = got & {(None, other), (None, other + " y")}
    assert len(kept_other) == 1
    assert got - kept_other == {(1, text), (7, clean), (9, ""), (8, ""), (5, None)}
    assert set_join.keep_one(docs).count() == 6 and set_join.keep_one(docs).columns == docs.columns
