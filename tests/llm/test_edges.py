"""Every operator and stage over partitions of one odd row each, rows and columns as promised."""

import pytest
import public_tokenizers

import corpus_pipeline
from tests.llm.test_set_join import brute as components_of
from verdant.llm import (bpe, collocations, decontamination, lexical_search, packing, pii, quality, queries, repeats, secrets, set_join, token_files)
from verdant.session import scratch_path

SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "\n", "?!", "\x00", "<|", "<|endoftext|>", *(" ".join("abcdefg"[:n]) for n in range(1, 8)), "a a", "a b", "a  b\t", "é 日", "😀",
         "word " * 4000, "x" * 5000, "a b", "ip 1.2.3.4 a@b.cd +49 30 1234567 89", "password = abcdef123456"]


@pytest.fixture(scope="module")
def odd(spark):
    """One row to a partition; extra columns carry names that the operators use inside."""
    rows = [(k, t, "en" if k % 2 else None, "src", len(t or ""), "x", k, [1]) for k, t in enumerate(TEXTS)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, _name string, score long, ids array<int>"
    path = scratch_path(spark, "odd")
    spark.createDataFrame(rows, schema).repartition(len(rows), "doc_id").write.parquet(path)
    one = spark.read.parquet(path)
    spread = spark.createDataFrame(spark.sparkContext.parallelize(rows, len(rows)), schema)
    assert spread.rdd.getNumPartitions() == len(rows) and one.count() == len(rows)
    return spread


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80), (1, 90)])
def test_jaccard_join_of_few_words(odd, n, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in set_join.groups(odd, n=n, percent=percent).collect()}
    assert got == components_of([(k, t) for k, t in enumerate(TEXTS)], n, percent) | {k: (0, k) for k, t in enumerate(TEXTS) if not (t or "").split()}


def test_keep_one_keeps_every_column(odd):
    kept = set_join.keep_one(odd, n=5, percent=80)
    assert kept.columns == odd.columns
    found = components_of([(k, t) for k, t in enumerate(TEXTS)], 5, 80)
    assert {(r.doc_id, r._name) for r in kept.collect()} == {(k, "x") for k in range(len(TEXTS)) if found.get(k, (0, k))[1] == k}


def test_one_row_out_for_one_row_in(spark, odd):
    model = queries.quality_model(spark, SF)
    benchmark = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None), (3, ""), (4, "a b")], "item_id long, text string")
    byte_path = public_tokenizers.path(queries.BYTE_TOKENIZER)
    for found in (quality.score(odd, model), decontamination.find(odd, benchmark), repeats.remove_repeats(odd), secrets.scan(odd), pii.scan(odd),
                  bpe.decode(bpe.encode(odd, byte_path), byte_path)):
        assert sorted(r.doc_id for r in found.collect()) == list(range(len(TEXTS)))
    for kept in (pii.redact(odd), quality.keep_good(odd, model, threshold=0.0), bpe.encode(odd, byte_path, ids_col="coded").drop("coded")):
        assert kept.columns == odd.columns and kept.count() == len(TEXTS)
    assert decontamination.remove(odd, benchmark).columns == odd.columns
    assert {r.doc_id for r in packing.pack(odd, queries.tokenizer()).collect()} == set(range(len(TEXTS)))
    path = scratch_path(spark, "odd_tokens")
    token_files.write(odd, path, queries.tokenizer())
    assert [r.doc_id for r in token_files.read(spark, path).orderBy("start", "doc_id").collect()] == list(range(len(TEXTS)))
    assert collocations.mine(odd, min_count=2).count() > 0
    assert lexical_search.search(odd, benchmark).count() > 0


@pytest.mark.parametrize("rows", ["none", "odd"])
def test_stages(spark, odd, rows):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = odd.select(*columns) if rows == "odd" else odd.select(*columns).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "odd_stages", name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        assert name == "packing" or (after.columns == columns and after.count() <= docs.count())
        docs = after if name != "quality" else docs  # judged on its own above; the others shall meet every row
