"""Suffix-array decontamination against brute force."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from verdant.llm import decontamination, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=10):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            windows[tuple(w[i : i + window])].add(str(item))
    out = {}
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    names |= found
        out[doc] = (len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit))
    return out


def rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def test_query_equals_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    items = pq.read_table(f"{SF}/benchmark.parquet").to_pylist()
    expected = brute([(d["doc_id"], d["text"]) for d in docs], [(i["item_id"], i["text"]) for i in items])
    got = rows(queries.op4_decontamination(spark, SF))
    assert got == expected
    assert any(x[4] for x in got.values())


def test_random_words_and_edges(spark, monkeypatch):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(rng.choice(list("abcdé"), rng.integers(0, 60)))) for i in range(120)]
    docs += [(120, None), (121, ""), (122, "  ,. "), (123, "a " * 3000), (124, docs[3][1]), (125, "A-B/c:D")]
    items = [(i, " ".join(rng.choice(list("abcdé"), rng.integers(1, 14)))) for i in range(15)]
    items += [(15, None), (16, ""), (17, items[0][1]), (18, "a b c d"), (19, "a " * 12)]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    expected = {k: (v[0], v[1], v[2]) for k, v in brute(docs, items).items()}

    def got():
        found = decontamination.find(d, b)
        return {r.doc_id: (r.n_words, sum(h.length for h in r.hits), len(r["items"])) for r in found.collect()}

    assert got() == expected
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)  # several blocks of items
    assert got() == expected
    kept = decontamination.remove(d, b)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, v in expected.items() if not v[1]}
    assert decontamination.remove(d, b.limit(0)).count() == len(docs)
    assert decontamination.find(d.limit(0), b).count() == 0
    longest = {(r["item"], r.start): r.length for r in decontamination.matches(d, b).collect()}
    every = [f" {' '.join(words(t))} " for _, t in docs]
    for item, text in items:
        w = words(text)
        for i in range(len(w)):
            n = max(n for n in range(len(w) - i + 1) if any(f" {' '.join(w[i:i + n])} " in t or not n for t in every))
            assert longest[str(item), i] == n
    assert d.where(F.col("doc_id") < 0).count() == 0
