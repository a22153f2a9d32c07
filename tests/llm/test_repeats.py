"""Suffix-bucket removal of repeated bytes against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from verdant.llm import queries, repeats

SF = "/root/testdata/sf0.001"
L = repeats.LENGTH


def brute(texts):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(hash(b[i : i + L]) for b in raw for i in range(len(b) - L + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - L + 1):
            if seen[hash(b[i : i + L])] > 1:
                gone[i : i + L] = True
        spans = int(np.sum(gone[:-1] & ~np.append(False, gone[:-2]))) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fixture():
    rng = np.random.default_rng(3)
    word = lambda n: " ".join("".join(rng.choice(list("abcdeé"), rng.integers(2, 7))) for _ in range(n))
    passage, other = word(150), word(400)
    texts = [word(int(n)) for n in rng.integers(1, 400, 25)]
    texts += [texts[3][:300] + passage + texts[4][:50], "x" + passage, passage[100:] + other, other[:700] + "!" + other[701:]]
    texts += [other[:i] + "#" + other[i + 1 :] for i in rng.integers(0, 2000, 12).tolist()]  # near copies
    texts += [other, other, None, "", "a" * 399, "a" * 400, "a" * 401, "ab" * 900, "aab" * 500, ("xyz" * 7 + "q") * 60]
    texts += [passage[:401] + "1", "2" + passage[:400], passage[1:400] + "3", "\x00" * 900 + "z", "z" + "\x00" * 850]
    return texts


def result(df):
    return {r.doc_id: (r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()}


@pytest.mark.parametrize("hot", [repeats.HOT_BUCKET, 1])
@pytest.mark.parametrize("block", [repeats.BLOCK_BYTES, 1])
def test_equals_brute_force(spark, monkeypatch, hot, block):
    monkeypatch.setattr(repeats, "HOT_BUCKET", hot)
    texts = fixture()
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, start int").repartition(3)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    assert result(repeats.remove_repeats(docs)) == dict(enumerate(brute(texts)))


def test_null_ids_repeated_rows_empty_table(spark):
    text = fixture()[25]
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (2, "short")], "doc_id long, text string")
    got = sorted(repeats.remove_repeats(docs).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [len(r.kept) for r in got] == [0, 0, 0, 5]
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_cover():
    inside, step = repeats.cover()
    assert inside.sum() == 6 and step.max() < repeats.PERIOD


def test_query_on_the_table(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").select(["doc_id", "text"]).to_pylist()
    expected = dict(zip([d["doc_id"] for d in docs], brute([d["text"] for d in docs])))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op6_repeats(spark, SF).collect()}
    assert got == expected
    assert any(v[1] for v in got.values())


def test_no_bucket_stays_hot(spark, monkeypatch):
    """One group of near copies: no task gets more of it than a bucket may hold, and the result is that of brute force."""
    rng = np.random.default_rng(8)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(150)]
    texts = []
    for _ in range(200):
        copy = list(words)
        for at in rng.integers(0, len(words), 3):
            copy[at] = "".join(rng.choice(list("abcdefgh"), 5))
        texts.append(" ".join(copy))
    largest, sort = [], repeats._sort_buckets

    def counted(contexts, id_type):
        largest.append(max([r["count"] for r in contexts.groupBy("bucket").count().collect()], default=0))
        return sort(contexts, id_type)

    monkeypatch.setattr(repeats, "_sort_buckets", counted)
    monkeypatch.setattr(repeats, "HOT_BUCKET", 20)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert result(repeats.remove_repeats(docs)) == dict(enumerate(brute(texts)))
    assert len(largest) == 2 and max(largest) <= 20


def test_planted_passages_of_over_50_words(spark):
    """Planted in three documents each: those of 400 bytes go whole, shorter ones stay, whatever their words; clean documents lose nothing."""
    rng = np.random.default_rng(14)
    prose = lambda n, long: " ".join("".join(rng.choice(list("abcdefghijklm"), rng.integers(2, long))) for _ in range(n))
    passages = [prose(n, long) for n in range(51, 63) for long in (7, 15)]
    planted = [f"{prose(90, 9)} <{p}> {prose(60, 9)}" for p in passages for _ in range(3)]
    texts = planted + [prose(150, 9) for _ in range(40)]
    got = result(repeats.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)))
    assert got == dict(enumerate(brute(texts)))
    size = [len(p) for p in passages for _ in range(3)]
    assert min(size) < L < max(size)
    assert [got[i][1] >= n if n >= L else got[i][1] == 0 for i, n in enumerate(size)] == [True] * len(planted)
    assert all(got[i][1] == 0 for i in range(len(planted), len(texts)))
