"""Registered queries of the training-data operators: whole given tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm import bpe, collocations, decontamination, lexical_search, packing, pii, quality, repeats, secrets, set_join, spans, token_files, url_filter, vector_search
from verdant.session import scratch_path

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> str:
    return public_tokenizers.path(TOKENIZER)


#: Fixed rules of the URL query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = url_filter.fit(url_filter.labelled_urls(spark))
    return url_filter.judge(table(spark, sf_dir, "pages"), model, URL_RULES)


def fold(column: str = "doc_id"):
    """The fold of a document, from its id alone; fold 2 is held out."""
    return F.crc32(F.col(column).cast("string")) % 4


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    return quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where(fold() != 2))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select("doc_id", (fold() == 2).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, run: n + run["length"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(), content=packing.CRC32)


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def _digest(found: DataFrame, base: list[str], added: list[str]) -> DataFrame:
    every = {k: F.col(k) for k in base}
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(spans.listed(every), 256).alias("base_sha256"),
                        spans.listed(every | {k: F.col(k) for k in added}).alias("spans"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secrets.scan(table(spark, sf_dir, "documents")), list(secrets.STRONG), list(secrets.WEAK))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_files")
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer())
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.scan(table(spark, sf_dir, "documents")), list(pii.BASE), list(pii.FOUND.values()))


def op10_set_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.groups(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
places AS (SELECT lang, w, k, unnest(range(1, CAST(len(w) AS BIGINT) - k + 2)) AS i FROM pieces CROSS JOIN range(1, 6) AS t(k)),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a FROM places GROUP BY ALL),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 100),
held AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT lang, w, a, size, unnest(range(1, k - size + 2)) AS i FROM candidates CROSS JOIN range(2, 5) AS t(size) WHERE size < k) GROUP BY ALL),
kept AS (SELECT c.* FROM candidates c LEFT JOIN held h ON c.lang = h.lang AND c.phrase = h.phrase WHERE h.longer IS NULL OR 100 * h.longer < 100 * c.a),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, x.a AS l, y.a AS r, n.n, (CAST(1000 AS HUGEINT) * c.a * n.n) // (CAST(x.a AS HUGEINT) * y.a) AS score
  FROM kept c CROSS JOIN range(1, 5) AS t(cut) JOIN n ON n.lang = c.lang
  JOIN f x ON x.lang = c.lang AND x.k = cut AND x.phrase = array_to_string(c.w[1:cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.k = c.k - cut AND y.phrase = array_to_string(c.w[cut + 1:c.k], ' ')
  WHERE cut < c.k),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM weakest QUALIFY rank <= 2000
"""


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BYTE_TOKENIZER)
    coded = bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    back = bpe.decode(coded.select("doc_id", "ids"), path)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
                       F.sha2("text", 256).alias("decoded_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
s AS (SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf CROSS JOIN s GROUP BY term, docs),
scores AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weights USING (term) CROSS JOIN s GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_quality": op2_quality,
        "op3_vector_search": op3_vector_search,
        "op4_decontamination": op4_decontamination,
        "op5_packing": op5_packing,
        "op6_repeats": op6_repeats,
        "op7_secrets": op7_secrets,
        "op8_token_files": op8_token_files,
        "op9_pii": op9_pii,
        "op10_set_join": op10_set_join,
        "op11_collocations": op11_collocations,
        "op12_bpe": op12_bpe,
        "op13_lexical_search": op13_lexical_search,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op11_collocations": OP11_SQL, "op13_lexical_search": OP13_SQL}
