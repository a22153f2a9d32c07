"""URL filter: allow and block rules, and logistic regression on hashed character n-grams for all other URLs.

The model is trained on a small labelled URL table (at most ``MAX_TRAIN`` rows, the first by hash); URLs are judged in
the task that reads them, and only the URL column is read.  Rules are configuration: a short list that is part of
the plan.

Defined results: a null URL or one without ``://`` has an empty host and path, no rule and the model's verdict on no
n-grams (the bias); repeated rows are judged alike; labels other than 0 and 1 are left out, and without both kinds
every URL is allowed; of rules of one length the first in the list wins; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from verdant.llm.arrays import mix, ragged, range_hash, utf8
from verdant.llm.hashed_features import logistic

MAX_TRAIN = 20_000
BITS = 16
GRAMS = (3, 4, 5)
RIDGE = 1e-5

#: The default labelled table is made of site names, each a word beside a neutral one.  Words of unwanted sites by subject,
#: and of ordinary ones; the neutral words stand beside both kinds alike.
UNWANTED = {
    "gambling": ("casino", "poker", "roulette", "jackpot", "bets", "betting", "slots", "lottery", "blackjack", "bingo", "wager"),
    "pharmacy": ("pills", "viagra", "pharma", "steroids", "dieting", "painkiller", "meds"),
    "adult": ("adult", "porn", "xxx", "cams", "escort", "naked", "sexy"),
    "spam": ("spam", "backlinks", "linkswap", "spinner", "doorway", "clickbait"),
    "tracking": ("ads", "adserver", "banners", "popunder", "tracker", "clicks", "pixel"),
    "money": ("payday", "loans", "cash", "bitcoins", "getrich", "prizes"),
}
ORDINARY = ("library", "museum", "university", "recipes", "garden", "news", "weather", "travel", "science", "sports", "music", "football",
            "history", "theatre", "physics", "cooking", "school", "hospital", "council", "railway", "poetry", "gazette", "chronicle", "observer",
            "institute", "foundation", "archive", "village", "mountain", "river", "harbour", "kitchen", "painting", "photo", "letters", "reading",
            "writing", "nature", "birds", "weekly", "times", "review", "journal", "society", "church", "market", "cinema", "tennis", "cycling",
            "sailing", "planet", "energy", "climate", "health", "family", "children", "teacher", "student", "research", "software", "network",
            "northern", "southern", "central", "national", "federation", "association", "statistics", "thistle", "heather", "other", "another",
            "station", "nation", "motion", "tion", "the", "there", "therein", "three", "that", "able", "stable", "reading", "meeting", "ethics")
BESIDE = ("best", "top", "mega", "royal", "lucky", "online", "hub", "zone", "world", "club", "city", "house")
PLACES = (("", "com"), ("www.", "net"), ("blog.", "org"), ("m.", "info"), ("", "co.uk"), ("www.", "eu"))
PATHS = ("", "/", "/index.html", "/a/12", "/about/", "/2/734/", "/news/5.html", "/item?id=98")


def site_names() -> list[tuple[str, str, int]]:
    """(name, word, unwanted) of the sites in the default table: a word before, after and joined to neutral words in turn."""
    words = [(w, 1) for subject in UNWANTED.values() for w in subject] + [(w, 0) for w in dict.fromkeys(ORDINARY)]
    out = []
    for i, (word, unwanted) in enumerate(words):
        for k in range(4):
            beside = BESIDE[(5 * i + k) % len(BESIDE)]
            out.append(((f"{beside}-{word}", f"{word}-{beside}", f"{word}{beside}", f"{beside}{word}")[k], word, unwanted))
        out.append((word, word, unwanted))
    return out


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The default training table (url, unwanted): every name at some places, with the paths in turn."""
    rows = [(f"https://{sub}{name}.{end}{PATHS[(i + k) % len(PATHS)]}", unwanted)
            for i, (name, _, unwanted) in enumerate(site_names()) for k, (sub, end) in enumerate(PLACES[i % 2 :: 2])]
    return spark.createDataFrame(rows, "url string, unwanted int")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty for null or without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    host = F.translate(F.regexp_extract(after, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of the (verdict, rule) list that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules[::-1], key=lambda r: len(r[1])):  # later ones override
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def char_ngrams(hosts: pa.Array, paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed feature) of every character n-gram of the hosts, with their ends marked, and of the paths."""
    rows, found = [], []
    for salt, column in ((1, hosts), (2, paths)):
        texts = [f"\x02{x or ''}\x03" for x in column.to_pylist()]
        data, offsets = utf8(pa.array(texts, pa.string()))
        for n in GRAMS:
            row, k = ragged(np.maximum(np.diff(offsets) - n + 1, 0))
            start = offsets[row] + k
            rows.append(row)
            found.append((mix(range_hash(data, start, start + n) + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found)


class Model:
    """Weights of the hashed n-grams, each divided by the root of the URL's n-grams, and a bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def scores(self, hosts: pa.Array, paths: pa.Array) -> np.ndarray:
        row, feature = char_ngrams(hosts, paths)
        total = np.bincount(row, self.weights[feature], len(hosts))
        return logistic(total / np.sqrt(np.maximum(np.bincount(row, minlength=len(hosts)), 1)) + self.bias)


def fit(labelled: DataFrame, *, url_col: str = "url", label_col: str = "unwanted", max_train: int = MAX_TRAIN, steps: int = 400) -> Model:
    host, path = host_and_path(F.col(url_col))
    rows = (labelled.where(F.col(label_col).isin(0, 1)).select(host.alias("host"), path.alias("path"), F.col(label_col).cast("int").alias("label"))
            .orderBy(F.xxhash64("host", "path"), "host", "path", "label").limit(max_train).toArrow().combine_chunks())
    label = rows.column("label").to_numpy().astype(float)
    if not len(label) or label.min() == label.max():
        return Model(np.zeros(1 << BITS), -1.0)
    row, feature = char_ngrams(rows.column("host").combine_chunks(), rows.column("path").combine_chunks())
    scale = 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(label)), 1))[row]
    weights, bias, moved = np.zeros(1 << BITS), 0.0, np.zeros((1 << BITS) + 1)
    for _ in range(steps):  # full gradients, steps scaled by the gradients so far
        error = logistic(np.bincount(row, weights[feature] * scale, len(label)) + bias) - label
        gradient = np.append(np.bincount(feature, error[row] * scale, 1 << BITS) / len(label) + RIDGE * weights, error.mean())
        moved += gradient**2
        step = 0.5 * gradient / np.sqrt(moved + 1e-12)
        weights, bias = weights - step[:-1], bias - step[-1]
    return Model(weights, bias)


def judge(pages: DataFrame, model: Model, rules: list[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, score): the longest rule's verdict, else block from a score of one half."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = shared.value.scores(batch.column("host"), batch.column("path"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], ["page_id", "host", "path", "score"])

    kind = urls.schema["page_id"].dataType.simpleString()
    scored = urls.mapInArrow(run, f"page_id {kind}, host string, path string, score double")
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"), "score")
