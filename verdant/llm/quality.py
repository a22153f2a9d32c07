"""Quality classifier: Naive Bayes support vectors over hashed n-grams of words and of their shapes.

Indicators are scaled by the log ratio of their smoothed counts in the two classes, and a linear hinge-loss model is
fitted on them by dual coordinate descent; a logistic curve over held-back margins turns them into scores.  The model
is fitted on at most ``MAX_TRAIN`` labelled rows, the first by a hash of their id, so the fit is the same at any size
and for any order; every document is scored in the task that reads it.

Defined results: a null, empty or wordless text has no feature and gets the score of the bias alone; repeated rows
score alike; labels that are null or whose document is missing are left out; documents with several labels count once
for each; without rows of both classes every score is the share of label 1 (0.5 if there are none); an empty table
gives no rows; other columns are not read by ``score`` and pass through ``keep_good`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.arrays import steps, utf8
from verdant.llm.hashed_features import dual_coordinate_descent, logistic, platt, text_ngrams

#: Labelled rows that the model is fitted on, at most.
MAX_TRAIN = 6000
BITS = 18
#: Smoothing of the class counts, and the upper bound of a row's dual variable.
SMOOTH = 1.0
COST = 0.1
THRESHOLD = 0.7

#: Words are runs of anything but blanks: marks and case-folded spellings tell about quality.
WORD = np.ones(256, bool)
WORD[[0x20, *range(0x09, 0x0E)]] = False


@dataclass
class Model:
    weights: np.ndarray  # float32, one per hashed feature, ratio included; the bias is last
    a: float
    b: float

    def scores(self, features: list[np.ndarray]) -> np.ndarray:
        margin = np.array([float(self.weights[f].sum(dtype=np.float64)) / np.sqrt(max(1, len(f))) for f in features]) + self.weights[-1]
        return logistic(self.a * margin + self.b)


def features(column: pa.Array) -> list[np.ndarray]:
    return text_ngrams(*utf8(column), WORD, BITS)


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        max_train: int = MAX_TRAIN) -> Model:
    """Fit on the first ``max_train`` labelled rows by hash of id (all, if fewer); the caller picks the rows for learning."""
    chosen = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(max_train))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")  # max_train rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.string()), batch.column("label"), pa.array(features(batch.column("text")), pa.list_(pa.int32()))],
                ["doc_id", "label", "found"])

    # at most max_train rows of distinct features: bounded by 2 ** BITS each, some hundreds on average
    found = texts.select("doc_id", "text", "label").mapInArrow(run, "doc_id string, label int, found array<int>").toArrow()
    order = np.lexsort((found.column("label").to_numpy(), found.column("doc_id").to_numpy()))
    rows = [found.column("found")[i].values.to_numpy() for i in order.tolist()]
    return _fit(rows, found.column("label").to_numpy()[order] == 1)


def _fit(rows: list[np.ndarray], good: np.ndarray) -> Model:
    n = 1 << BITS
    if good.all() or not good.any():
        share = float(good.mean()) if len(good) else 0.5
        return Model(np.zeros(n + 1, np.float32), 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    held = np.arange(len(rows)) % 5 == 4 if min(good.sum(), (~good).sum()) >= 10 else np.zeros(len(rows), bool)

    def weights(pick: np.ndarray) -> np.ndarray:
        counts = np.full((2, n), SMOOTH)
        for i in np.flatnonzero(pick).tolist():
            counts[int(good[i]), rows[i]] += 1
        ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
        chosen = np.flatnonzero(pick).tolist()
        y = np.where(good[pick], 1.0, -1.0)
        cost = np.full(len(y), COST)
        w = dual_coordinate_descent([rows[i] for i in chosen], ratio, y, cost)
        return np.append(w[:-1] * ratio, w[-1]).astype(np.float32)

    tried = Model(weights(~held), 1.0, 0.0)
    judged = held if held.any() else ~held
    margin = np.log((p := tried.scores([rows[i] for i in np.flatnonzero(judged).tolist()])) / (1 - p))
    a, b = platt(margin, good[judged])
    return Model(tried.weights if not held.any() else weights(np.ones(len(rows), bool)), a, b)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS weights
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.scores(features(batch.column("text"))))], ["doc_id", "score"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Model, *, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text_col):
            yield batch.filter(pa.array(shared.value.scores(features(batch.column(text_col))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
