"""Collocations against a plain count of every phrase, over texts that cut, repeat and overlap in odd ways."""

import random
import re
from collections import Counter

import pytest

from verdant.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, longest=5, top=2000, cover=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    frequent = {p: a for p, a in f.items() if a >= min_count and len(p[1]) > 1}
    found = {}
    for (lang, words), a in frequent.items():
        inside = [b for (other, longer), b in frequent.items() if other == lang and len(longer) > len(words)
                  and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))]
        if not any(100 * b >= cover * a for b in inside):
            cuts = []
            for k in range(1, len(words)):
                left, right = f[lang, words[:k]], f[lang, words[k:]]
                cuts.append((1000 * a * n[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            found[lang, " ".join(words)] = (a, left, right, n[lang], score)
    out = []
    for lang in n:
        mine = sorted((-v[4], -v[0], p.encode(), p, v) for (other, p), v in found.items() if other == lang)
        out += [(lang, i + 1, p, *v) for i, (*_, p, v) in enumerate(mine[:top])]
    return sorted(out)


def mined(spark, rows, min_count, parts=3, **options):
    docs = spark.createDataFrame([(i, lang, text, "x", 7) for i, (lang, text) in enumerate(rows)], "doc_id long, lang string, text string, chunk string, n long")
    return sorted(tuple(r) for r in collocations.mine(docs.repartition(parts), min_count=min_count, **options).collect())


def sample(seed):
    rng = random.Random(seed)
    words = ["a", "the", "New", "YORK", "city", "of", "é", "x.y", "日本", "it's", "a\x00b", "es", "en"]
    phrases = ["New York city", "the City of New York", "a b", "of the", "one two three four five six"]
    rows = []
    for _ in range(60):
        text = ""
        for _ in range(rng.choice([0, 1, 3, 60, 200])):
            text += rng.choice(phrases) if rng.random() < 0.3 else rng.choice(words)
            text += rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; "])
        rows.append((rng.choice(["en", "es", None, "und"]), text))
    return rows + [("en", None), ("en", ""), ("es", "..."), (None, "word"), *rows[:20], ("fr", "hot " * 5000), ("fr", "p q r " * 2500)]


@pytest.mark.parametrize("seed", range(3))
def test_equal_to_a_plain_count(spark, seed):
    rows = sample(seed)
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_parameters(spark):
    rows = sample(9)
    assert mined(spark, rows, 5, longest=3, top=4, cover=60) == brute(rows, 5, longest=3, top=4, cover=60)


def test_long_chunks_are_closed_and_short_texts_counted(spark, monkeypatch):
    monkeypatch.setattr(collocations, "LONGEST_CHUNK", 7)
    monkeypatch.setattr(collocations, "PARSE", 3)
    words = collocations.Words(*collocations.utf8(collocations.pa.array(["a b c d e " * 300, "", "x", "y z", "q " * 50])), collocations.WORD)
    start, own, last = collocations._chunks(words, 4)
    assert own.max() <= 7 and own.min() >= 1
    assert sorted(i for s, o in zip(start, own) for i in range(s, s + o)) == list(range(len(words.hash)))  # every word is own once
    text = [sum(s >= e for e in words.first[1:]) for s in range(len(words.hash))]
    for s, o, e in zip(start.tolist(), own.tolist(), last.tolist()):
        assert e == min(s + o + 3, words.first[text[s] + 1] - 1)


def test_copies_share_their_chunks(spark):
    rng = random.Random(1)
    body = " ".join(rng.choice("abcdefghijklmnop") * rng.randint(1, 3) for _ in range(4000))
    docs = spark.createDataFrame([("en", f"{' '.join(rng.choice('xyz') for _ in range(rng.randint(5, 30)))} {body} {k}") for k in range(30)], "lang string, text string")
    dictionary = collocations.parse(docs).collect()
    assert sum(r.own * r.n for r in dictionary) > 30 * 4000
    assert sum(r.own for r in dictionary) < 3 * 4000  # thirty copies are stored about once


def test_longer_phrases_are_counted_from_runs_of_frequent_pairs(spark):
    """Three words and more: words beside no frequent pair are gone, and the counts are those of the chunks."""
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice(["a", "b", "c", "d", f"rare{k}", "e. f"]) for _ in range(rng.choice([1, 2, 4, 40]))), rng.randint(1, 9)) for k in range(300)]
    rows = [(lang, text, rng.randint(1, len(re.findall("[^ .]+", text))), n) for lang, text, n in rows]
    dictionary = spark.createDataFrame(rows + [("es", "a b c", 2, 5)], "lang string, chunk string, own int, n long").repartition(2)
    pairs, expected = Counter(), Counter()
    for lang, text, own, n in [*rows, ("es", "a b c", 2, 5)]:
        words = [(w, k) for k, piece in enumerate(text.split(".")) for w in piece.split()]
        for size, into in ((2, pairs), (3, expected), (4, expected), (5, expected)):
            for i in range(min(own, len(words) - size + 1)):
                if words[i][1] == words[i + size - 1][1]:
                    into[(lang, *(w for w, _ in words[i : i + size]))] += n
    frequent = spark.createDataFrame([(lang, f"{x} {y}") for (lang, x, y), a in pairs.items() if a >= 20], "lang string, phrase string")

    def hashed(batches):
        for batch in batches:
            grams = collocations.Grams(batch, "phrase")
            yield batch.append_column("gram", collocations._signed(grams.of(2)[grams.words.first[:-1]]))

    bits = spark.sparkContext.broadcast(collocations.Filter.of(frequent.repartition(1).mapInArrow(hashed, "lang string, phrase string, gram long")))
    found = collocations.runs(dictionary, bits)
    assert 0 < sum(len(r.chunk.split()) for r in found.collect()) < sum(len(text.split()) for _, text, _, _ in rows)
    everything = spark.sparkContext.broadcast(collocations.np.full(1 << (collocations.FILTER_BITS - 6), (1 << 64) - 1, collocations.np.uint64))
    for size in (3, 4, 5):
        good = sorted(a for p, a in expected.items() if len(p) == size + 1 and a >= 20)
        assert good == sorted(r.a for r in collocations.longer_counts(found, size, everything, 20).collect())


def test_arithmetic_beyond_64_bits(spark):
    totals = spark.createDataFrame([("en", 9 * 10**15)], "lang string, n long")
    phrases = spark.createDataFrame([("en", "a", 1, 7 * 10**14), ("en", "b", 1, 6 * 10**14), ("en", "a b", 2, 5 * 10**14)], "lang string, phrase string, words int, a long")
    original, collocations.frequent = collocations.frequent, lambda *_, **__: (totals, phrases)
    try:
        row = collocations.mine(totals).collect()[0]
    finally:
        collocations.frequent = original
    assert row.score == 1000 * 5 * 10**14 * 9 * 10**15 // (7 * 10**14 * 6 * 10**14)


def test_nothing(spark):
    assert mined(spark, [], 1, parts=1) == [] and mined(spark, [("en", "a b")], 2) == [] and mined(spark, [(None, None)], 1) == []
    assert mined(spark, [(None, "a b")], 1) == [("und", 1, "a b", 1, 1, 1, 2, 2000)]
