"""Streaming byte-level BPE against the library, at any cut, and the way back."""

import json
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from verdant.llm import bpe, queries
from verdant.llm.arrays import utf8

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
ODD = ["", " ", "  ", " a", "a ", "a  b", "a \n b", "a\n\nb", "\t\n", "it's we'll I'VE they're'd 's 'll'll !'s \n's", "'", "'s", "x'", "'l", "'re'", "can''t",
       "<|endoftext|>", "a <|endoftext|>  <|endoftext|><|endoftext", "<<|endoftext|>>", "x  <|endoftext|>", "日本語。テスト", "é́ ÀÉ ½² Ⅷ ٣", "😀a😀 b",
       "   x　\u0085y \x1c\x1d z", "\x00\x01", "a" * 700, " " * 900, "!" * 800 + "'s", "the" * 400, " 　" * 300, "9" * 500, "ab\n" * 50,
       "word " * 300, "\n" * 333 + "x"]


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def encode(texts):
    flat, cuts = bpe.encoder(PATH).encode(*utf8(pa.array(texts, pa.string())))
    return [flat[a:b].tolist() for a, b in zip(cuts, cuts[1:])]


def stream(text, sizes):
    raw, at, machine, out = text.encode(), 0, bpe.TextTransducer(bpe.encoder(PATH)), []
    while at < len(raw):
        size = next(sizes)
        out += machine.feed(raw[at : at + size]).tolist()
        at += size
    return out + machine.finish().tolist()


def test_ids_equal_the_librarys():
    texts = ODD + [None] + [t["text"] for t in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    assert encode(texts) == [ids(t) for t in texts]
    assert encode([]) == [] and encode([None]) == [[]] and encode(["", None]) == [[], []]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30) | st.text("aÉ'stlre.<| \n\t9", max_size=40), min_size=1, max_size=4))
def test_ids_of_any_text(texts):
    assert encode(texts) == [ids(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "'s", "'", "!", "<|endoftext|>", "<|endof", "é", "日", "　", "7", "x" * 90, " " * 40]), max_size=60),
       st.integers(1, 70), st.integers(0, 9))
def test_streams_cut_anywhere(parts, most, seed):
    text, random_ = "".join(parts), random.Random(seed)
    assert stream(text, iter(lambda: random_.randint(1, most), None)) == ids(text)


def test_long_words_are_streamed_in_bounded_memory(monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 50)
    rng = random.Random(3)
    for alphabet in ("ab", "theran ", "a", " ", " \n", "!'", "é日a", "　 ", "0123", "-=", "'s"):
        text = "".join(rng.choice(alphabet) for _ in range(6000))
        machine, out = bpe.TextTransducer(bpe.encoder(PATH)), []
        for a in range(0, len(raw := text.encode()), 97):
            out += machine.feed(raw[a : a + 97]).tolist()
            held = len(machine.held) + (len(machine.open.held) if machine.open else 0)
            assert held <= 97 + 2 * (50 + bpe.merges(PATH).lookahead + machine.encoder.margin)
        assert out + machine.finish().tolist() == ids(text), alphabet


def test_tokens_before_the_lookahead_never_change():
    rules, rng = bpe.merges(PATH), random.Random(7)
    tokens = [w for w in json.load(open(PATH))["model"]["vocab"] if w.isascii() and w.isalpha()]
    assert 0 < rules.lookahead < 1000
    for _ in range(300):
        word = "".join(rng.choice(tokens) for _ in range(60)).encode()
        whole = rules.merge(word)
        cut = rng.randrange(rules.lookahead, len(word)) if len(word) > rules.lookahead else len(word)
        part = rules.merge(word[:cut])
        ends = np.cumsum(rules.size[part])
        stable = int(np.searchsorted(ends, cut - rules.lookahead, "right"))
        assert part[:stable] == whole[:stable]


def test_lookahead_of_a_chain(tmp_path):
    """Each rule's right side is the next one's left: what follows decides the pairing all the way back."""
    letters = bpe._byte_letters()
    spec = json.load(open(PATH))
    spec["model"]["vocab"] = {letters[b]: b for b in range(256)}
    chain = "abcdefgh"
    spec["model"]["merges"] = [[chain[i], chain[i + 1]] for i in range(6, -1, -1)]
    spec["model"]["vocab"] |= {a + b: 256 + i for i, (a, b) in enumerate(spec["model"]["merges"])}
    (file := tmp_path / "chain.json").write_text(json.dumps(spec))
    rules = bpe.Merges(str(file))
    assert rules.lookahead == 7
    library = Tokenizer.from_file(str(file))
    for text in ("abcdefgh", "abcdefg", "abcdef", "abcdefghabcdefg"):
        assert rules.merge(text.encode()) == library.encode(text).ids
    spec["model"]["merges"].reverse()
    spec["model"]["merges"].insert(0, ["ab", "c"])
    spec["model"]["vocab"]["abc"] = 999
    file.write_text(json.dumps(spec))
    with pytest.raises(ValueError, match="not yet made"):
        bpe.Merges(str(file))


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 3)
    small = bpe.Encoder(PATH)
    for text in ("a b c d e", "f g h", "a b c", "z"):
        assert small.encode(*utf8(pa.array([text])))[0].tolist() == ids(text)
    assert small.count < 8


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-2, 50260), max_size=40), st.integers(1, 7))
def test_decoding_in_parts(numbers, size):
    machine = bpe.Decoder(bpe.merges(PATH))
    parts = [machine.feed(np.array(numbers[a : a + size], np.int64)) for a in range(0, len(numbers), size)]
    assert "".join(parts) + machine.finish() == LIBRARY.decode([n for n in numbers if 0 <= n <= 50256], skip_special_tokens=False)


def test_frames(spark):
    rows = [(k, t, "kept", [k]) for k, t in enumerate([*ODD, None, "repeat", "repeat"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra string, ids array<int>")
    coded = bpe.encode(docs, PATH, chunk=300)  # longer texts are streamed
    assert coded.columns == ["doc_id", "text", "extra", "ids"]
    back = bpe.decode(coded.drop("text"), PATH)
    got = {r.doc_id: r for r in back.collect()}
    for k, text, *_ in rows:
        assert (got[k]["ids"], got[k].text, got[k].extra) == (ids(text), LIBRARY.decode(ids(text), skip_special_tokens=False), "kept")
    assert bpe.encode(docs.where("false"), PATH).count() == 0
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 64, 99999, -1])], "k int, ids array<int>")
    assert [r.text for r in bpe.decode(odd, PATH).orderBy("k").collect()] == ["", "", LIBRARY.decode([64])]


def test_query(spark):
    import hashlib

    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = queries.op12_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = ids(docs[r.doc_id])
        assert r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(want, skip_special_tokens=False).encode()).hexdigest()
