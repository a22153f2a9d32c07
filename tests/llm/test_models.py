"""Classifiers by held-out accuracy, vector search by recall, and their edges."""

import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from verdant.llm import quality, queries, url_filter, vector_search

SF = "/root/testdata/sf0.01"


def test_quality_on_the_held_out_fold(spark):
    rows = queries.op2_quality(spark, SF).collect()
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{SF}/labels.parquet").to_pylist()}
    assert len(rows) == pq.read_table(f"{SF}/documents.parquet").num_rows
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.95
    assert np.mean([(s >= 0.7) == y for s, y in held]) > 0.95


def test_quality_edges(spark):
    docs = spark.createDataFrame([(0, None, 1.0), (1, "", 1.0), (2, "a b", 1.0), (2, "a b", 1.0), (3, "x | y | " * 3000, 1.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(0, 1), (1, 1), (2, None), (9, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)  # label 1 only
    assert {round(r.score, 3) for r in quality.score(docs, model).collect()} == {0.999}
    model = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, model).collect()} == {0.5}
    model = quality.fit(docs, spark.createDataFrame([(0, 1), (2, 1), (3, 0)], "doc_id long, quality int"))
    assert quality.score(docs, model).count() == 5
    kept = quality.keep_good(docs, model, threshold=0.0)
    assert kept.columns == docs.columns and kept.count() == 5
    assert quality.score(docs.limit(0), model).count() == 0


def test_urls(spark):
    model = url_filter.fit(url_filter.labelled_urls(spark))
    urls = ["https://WWW.Example.ORG/en/15?x#y", "http://example.org/es/1", "ftp://a.com/de/", "a.com/de/", None, "x://", "x://org/", "x://com/fr", "x://nocom/de/1",
            "http://a?b/c://com/de/", "http://free-casino-bets.info/en/3", "http://riverlibrary.info/en/3", "http://É.example.org#/es/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x")], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, model, queries.URL_RULES).collect()}
    assert got[0] == ("www.example.org", "/en/15", "example.org/en/1", "block")
    assert got[1] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("a.com", "/de/", "com/de/", "block")
    assert got[3][:3] == ("", "", None) and got[4][:3] == ("", "", None) and got[5][:3] == ("", "", None)
    assert got[6] == ("org", "/", "org/", "allow") and got[7][:3] == ("com", "/fr", None) and got[8][:3] == ("nocom", "/de/1", None)
    assert got[9][:3] == ("a", "", None)
    assert got[10][2:] == (None, "block") and got[11][2:] == (None, "allow")
    assert got[12][:3] == ("É.example.org", "", None)
    assert url_filter.judge(pages, model, []).count() == len(urls) + 1
    assert url_filter.judge(pages.limit(0), model, queries.URL_RULES).count() == 0
    nothing = url_filter.fit(spark.createDataFrame([], "url string, unwanted int"))
    assert {r.verdict for r in url_filter.judge(pages, nothing, []).collect()} == {"allow"}


def plain_score(model, host, path):
    """A URL's score, one n-gram after the other."""
    total = count = 0
    for salt, text in ((1, host), (2, path)):
        raw = np.frombuffer(f"\x02{text}\x03".encode(), np.uint8)
        for n in url_filter.GRAMS:
            for i in range(len(raw) - n + 1):
                hashed = url_filter.mix(url_filter.range_hash(raw, np.array([i]), np.array([i + n])) + np.uint64(salt)) >> np.uint64(64 - url_filter.BITS)
                total, count = total + model.weights[int(hashed[0])], count + 1
    return 1 / (1 + np.exp(-(total / np.sqrt(count) + model.bias)))


def plain_rule(host, path):
    fits = [(len(rule), rule, verdict) for verdict, rule in queries.URL_RULES
            if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith(rule[rule.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


def test_url_query(spark):
    """Every row of the query against rules and scores worked out one by one."""
    model = url_filter.fit(url_filter.labelled_urls(spark))
    urls = {r["page_id"]: r["url"] for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    rows = queries.op1_url_filter(spark, SF).collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        after = (urls[r.page_id] or "").partition("://")[2]
        host = re.split("[/?#]", after)[0]
        path = re.split("[?#]", after[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        rule, verdict = plain_rule(host, path)
        score = plain_score(model, host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and abs(r.score - score) < 1e-9
        assert r.verdict == (verdict or ("block" if score >= 0.5 else "allow"))


def test_urls_of_pages_are_not_in_the_training_table(spark):
    trained = {r.host for r in url_filter.labelled_urls(spark).select(url_filter.host_and_path(F.col("url"))[0].alias("host")).distinct().collect()}
    pages = {r.host for sf in (SF, "/root/testdata/sf0.1") for r in queries.op1_url_filter(spark, sf).select("host").distinct().collect()}
    names = {h.split(".")[-3] for h in pages if h.count(".") >= 2}
    assert not trained & pages and not {n for n, _, _ in url_filter.site_names()} & names


def fitted_without(spark, held):
    """Share of held-out sites that a model gets right which never saw them: (unwanted, ordinary)."""
    rows = [(f"http://www.{name}.com/{i}", unwanted, held(i, name, word)) for i, (name, word, unwanted) in enumerate(url_filter.site_names())]
    table = spark.createDataFrame(rows, "url string, unwanted int, held boolean")
    model = url_filter.fit(table.where("not held"))
    got = url_filter.judge(table.where("held").select("url", F.col("unwanted").alias("page_id")), model, []).collect()
    return [np.mean([(r.verdict == "block") == bool(kind) for r in got if r.page_id == kind]) for kind in (1, 0)]


def test_sites_held_out_by_name(spark):
    unwanted, ordinary = fitted_without(spark, lambda i, name, word: i % 5 == 2)
    assert unwanted > 0.9 and ordinary > 0.95


def test_clean_sites_of_unseen_words_are_let_through(spark):
    """Unseen words say nothing of unwanted sites, but a model must not block the clean ones for being unknown."""
    _, ordinary = fitted_without(spark, lambda i, name, word: sum(word.encode()) % 4 == 1)
    assert ordinary > 0.8


def nearest(ids, vectors, query, k):
    scores = vectors @ vectors[query]
    order = sorted((i for i in range(len(ids)) if ids[i] != ids[query]), key=lambda i: (-scores[i], ids[i]))[:k]
    return [ids[i] for i in order]


def test_search_recall(spark, monkeypatch):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    ids, vectors = table.column("vec_id").to_pylist(), np.array(table.column("embedding").to_pylist(), np.float64)
    for window, least in ((vector_search.WINDOW, 1.0), (60, 0.9)):
        monkeypatch.setattr(vector_search, "WINDOW", window)
        got = {}
        for r in queries.op3_vector_search(spark, SF).orderBy("query_id", "rank").collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
            assert r["rank"] == len(got[r.query_id])
        queries_at = [i for i, v in enumerate(ids) if v % 20 == 0]
        assert set(got) == {ids[i] for i in queries_at}
        hits = [len(set(got[ids[i]]) & set(nearest(ids, vectors, i, 20))) / 20 for i in queries_at]
        assert np.mean(hits) >= least


def test_search_edges(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(60)] + [(100, [3.0, 2.0, 1.0]), (101, [9.0, 9.0]), (120, None), (140, []), (160, [0.0, 0.0, 0.0]),
                                                         (180, [1.0, float("nan"), 0.0]), (200, [1.0, None, 2.0]), (None, [1.0, 1.0, 1.0]), (0, [1.0, 2.0, 3.0]), (220, [-0.0, 0.0, 1.0])]
    vectors = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<double>, score double")
    got = {}
    for r in vector_search.search(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 100, 220}
    assert got[0] == [(101, 27.0), *((i, 14.0) for i in range(1, 20))]
    assert got[20] == [(101, 27.0), *((i, 14.0) for i in range(19))]
    assert got[220] == [(i, 3.0) for i in range(20)]
    assert got[100][0] == (101, 45.0) and [i for i, _ in got[100][1:]] == list(range(19))
    few = vector_search.search(vectors.where("vec_id in (0, 100, 101)"), F.lit(True)).where("query_id = 100").collect()
    assert [r.vec_id for r in few] == [101, 0]
    assert vector_search.search(vectors.limit(0), F.lit(True)).count() == 0


def test_hilbert_curve_steps_to_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = vector_search.hilbert(cells, 3)
    assert sorted(key.tolist()) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_features_are_distinct():
    found = quality.features(pa.array(["a b a b a b", None, "x"]))
    assert all(len(set(f.tolist())) == len(f) for f in found) and len(found[1]) == 0 and len(found[2]) == 2


@pytest.mark.parametrize("long", [1.0, 5.0])
def test_search_recall_where_windows_are_a_small_part(spark, monkeypatch, long):
    """Unit vectors without structure, 100 windows of them, with and without one long vector."""
    monkeypatch.setattr(vector_search, "WINDOW", 40)
    monkeypatch.setattr(vector_search, "WIDEST", 40)
    vectors = np.random.default_rng(9).standard_normal((4000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[17] *= long
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in vector_search.search(table, F.col("vec_id") % 40 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = [len(got[i] & set(nearest(range(4000), vectors, i, 20))) / 20 for i in range(0, 4000, 40)]
    assert np.mean(hits) >= 0.9


def test_search_keeps_to_few_windows_of_clustered_vectors(spark, monkeypatch):
    chosen = []
    choose = vector_search._choose
    monkeypatch.setattr(vector_search, "_choose", lambda placed, truth, windows: chosen.append((*choose(placed, truth, windows), windows)) or chosen[-1][:2])
    monkeypatch.setattr(vector_search, "WINDOW", 40)
    monkeypatch.setattr(vector_search, "WIDEST", 40)
    rng = np.random.default_rng(5)
    vectors = np.repeat(rng.standard_normal((100, 16)), 30, axis=0) + 0.01 * rng.standard_normal((3000, 16))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in vector_search.search(table, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[i] & set(nearest(range(3000), vectors, i, 20))) / 20 for i in range(0, 3000, 50)]) >= 0.9
    curves, reach, windows = chosen[0]
    assert curves * (2 * reach + 1) < windows // 2
