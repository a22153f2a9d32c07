"""Token ids, packing and token files against the tokenizer itself and exact round trips."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from verdant.llm import packing, queries, token_files, token_ids
from verdant.llm.arrays import utf8

SF = "/root/testdata/sf0.001"
PATH = queries.tokenizer()
REFERENCE = Tokenizer.from_file(PATH)
ODD = ["", "Hello, World. it's O'Neil's ...", "<|startoftext|> a <|STARTOFTEXT|>b<|", "Σίσυφος ΣΑΣ, İstanbul. ａｂ", "á b.́ é́ ÀÉ", "x ,y , z. . $$$. a.b,c  \t d\x1ce f ½² « a». 12.5, 3",
       "\n", ". ,", "日本語。テスト, ok.", "A×B÷C. µ ª º ß", "don't 'S 'll I'M", "\x00\x01a", "😀 a😀b", " lead and trail ", "Ü" * 3000, "word " * 2000]


def ids(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids


def encode(texts):
    return [x.tolist() for x in token_ids.WordEncoder(PATH).encode(*utf8(pa.array(texts, pa.string())))]


def test_ids_equal_the_tokenizers():
    texts = ODD + [None] + [t["text"] for t in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    assert encode(texts) == [ids(t) for t in texts]
    assert encode([]) == [] and encode([None]) == [[]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30) | st.text("aÉé'.,<| \n\t9s", max_size=30), min_size=1, max_size=4))
def test_ids_of_any_text(texts):
    assert encode(texts) == [ids(t) for t in texts]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(token_ids, "MEMORY_UNITS", 3)
    encoder = token_ids.WordEncoder(PATH)
    for text in ("a b c d e", "f g h", "a b c", "z"):
        assert encoder.encode(*utf8(pa.array([text])))[0].tolist() == ids(text)
    assert encoder.count < 8


def check_packing(rows, docs, window=2048):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in docs:
        whole, at = [*ids(text), packing.END_ID], 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(whole)
            assert r.ids_crc32 == zlib.crc32(np.array(whole[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(whole)
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= window
    return sequences


def test_packing_query(spark):
    docs = [(d["doc_id"], d["text"]) for d in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    sequences = check_packing(queries.op5_packing(spark, SF).collect(), docs)
    used = sum(n for s in sequences.values() for _, n in s)
    assert used > 0.97 * 2048 * (len(sequences) - 1)


def test_packing_edges(spark, monkeypatch):
    texts = [*ODD, None, "a " * 5000, "b " * 2047, "b " * 2048]
    docs = spark.createDataFrame([(i, t, 3) for i, t in enumerate(texts)], "doc_id long, text string, length int")
    check_packing(packing.pack(docs, PATH, content=packing.CRC32).collect(), list(enumerate(texts)))
    with_ids = packing.pack(docs, PATH).where("doc_id = 1").collect()
    assert with_ids[0].ids == [*ids(texts[1]), packing.END_ID]
    twice = packing.pack(docs.where("doc_id = 1").unionByName(docs.where("doc_id = 1")), PATH).collect()
    assert len(twice) == 2
    assert packing.pack(docs.limit(0), PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_is_the_tightest(lengths):
    placed, n = packing.best_fit(lengths, 64, 0)
    room = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[i]]
        tightest = min(fits, default=64)
        assert 64 - placed[i][1] == tightest
        if fits:
            room.remove(tightest)
        room.append(tightest - lengths[i])
    assert n == len(room)


@pytest.mark.parametrize("block, part", [(token_files.BLOCK_IDS, token_files.PART_IDS), (700, 5000)])
def test_files_round_trip(spark, tmp_path, monkeypatch, block, part):
    monkeypatch.setattr(token_files, "BLOCK_IDS", block)
    monkeypatch.setattr(token_files, "PART_IDS", part)
    texts = [*ODD, None, "a b c " * 900]
    order = np.random.default_rng(0).permutation(len(texts)).tolist()
    docs = spark.createDataFrame([(i, texts[i], "x") for i in order], "doc_id long, text string, ids string").repartition(3)
    token_files.write(docs, str(tmp_path / "files"), PATH)
    at, rows = 0, {r.doc_id: r for r in token_files.read(spark, str(tmp_path / "files")).collect()}
    for i, text in enumerate(texts):
        whole = [*ids(text), token_files.END_ID]
        assert (rows[i].start, rows[i].n_tokens, np.frombuffer(rows[i].ids, "<u4").tolist()) == (at, len(whole), whole)
        at += len(whole)


def test_files_of_nothing_and_of_repeated_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    token_files.write(docs, str(tmp_path / "some"), PATH)
    assert sorted((r.start, r.n_tokens) for r in token_files.read(spark, str(tmp_path / "some")).collect()) == [(0, 2), (2, 3), (5, 3)]
    token_files.write(docs.limit(0), str(tmp_path / "none"), PATH)
    assert token_files.read(spark, str(tmp_path / "none")).count() == 0


def test_a_damaged_block_is_noticed():
    rng = np.random.default_rng(1)
    text = (rng.zipf(1.3, 30_000) % 5000).astype(np.uint16)
    values, counts = np.unique(text, return_counts=True)
    table = token_files.Table.scaled(values, counts)
    assert int(table.frequency.sum()) == 1 << token_files.SCALE
    payload = table.encode(text)
    assert (table.decode(payload, len(text)) == text).all()
    share = counts / counts.sum()
    entropy = -(share * np.log2(share)).sum()
    assert 8 * (len(payload) - 8 * token_files.LANES) / len(text) < 1.01 * entropy + 0.05
    broken = bytearray(payload)
    broken[len(broken) // 2] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        table.decode(bytes(broken), len(text))


def test_token_file_query(spark):
    at, rows = 0, {r.doc_id: r for r in queries.op8_token_files(spark, SF).collect()}
    for d in sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda d: d["doc_id"]):
        whole = [*ids(d["text"]), 2]
        r = rows[d["doc_id"]]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(whole), zlib.crc32(np.array(whole, "<u4").tobytes()))
        at += len(whole)
