"""Ordinal quality classifier: graded ratings, one set of hashed-text weights, ordered thresholds.

The cumulative-link model says P(grade <= k) = sigmoid(threshold_k - w.x), with the same weights for every k.
Features x are present or absent: every word (letters and digits, ASCII lower-cased)
and its beginnings, and how large a share of
the words has each shape (first two and last two characters), on a log scale. From the model come the expected
grade and the tail probability P(grade >= k), by which documents are selected.

Grades are 0 (toxic), 1 (not toxic, poor) and 2 (good). The fit uses ``fit_rows`` labelled documents at most,
those whose ids hash lowest; their whole texts are turned to features by the executors. Scoring reads every
whole text.

Labels with a null are left out; a document with several labels counts with its lowest grade. Null and empty
texts have no features and are scored by the thresholds alone. Every row is scored on its own: repeated rows give
repeated scores, an empty table gives none. With fewer than two grades among the labels there is nothing to
learn: all weights are zero, and every document is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skyledger.llm.common import lower_ascii, map_texts, mixed, prefix_hash, range_hash, small_batches, table, text_bytes, words

#: Labelled documents used for the fit, at most.
FIT_ROWS = 10_000
BITS = 20
GRADES = 3
#: A feature gets a weight if so many fitted documents have it, and shift the mean grade by so many standard errors.
LEAST_SEEN, LEAST_SHIFT = 8, 4.0
#: Beginnings of words, in bytes, that are features of their own.
PREFIXES = (4, 5, 6)
#: A document is kept if it is at least this likely to be of the highest grade. Low, so that good documents with
#: little text to judge stay; toxic ones are far below.
KEEP_FROM = 0.2

_IN_WORD = np.zeros(256, dtype=bool)
_IN_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(column: pa.Array, only: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, feature) of a batch of texts, each once, by row; with ``only``, of the features marked there."""
    raw, offsets = text_bytes(column)
    if not len(raw):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    low = lower_ascii(raw)
    clean = np.where(_IN_WORD[low], low, np.uint8(32))
    start, end, before = words(clean, offsets)
    row = np.repeat(np.arange(len(column)), np.diff(before))
    sums = prefix_hash(clean.astype(np.uint64) + np.uint64(1))
    found = []
    for ends in (end, *(start + n for n in PREFIXES)):
        fits = ends <= end
        hashed = range_hash(sums, start[fits], ends[fits]) >> np.uint64(64 - BITS)
        found.append(row[fits] << BITS | hashed.astype(np.int64))
    # Shapes, of the words as they are written.
    start, end, before = words(raw, offsets)
    if len(start):
        count = np.diff(before)
        row = np.repeat(np.arange(len(column)), count)
        second, last_but_one = np.minimum(start + 1, end - 1), np.maximum(end - 2, start)
        case = np.searchsorted(np.array([48, 58, 65, 91, 97, 123, 128]), np.stack([raw[start], raw[second]]), side="right")
        shape = (case[0] * 8 + case[1]) << 16 | raw[last_but_one].astype(np.int64) << 8 | raw[end - 1]
        kind, times = np.unique(row << 22 | shape, return_counts=True)
        row, shape = kind >> 22, kind & (1 << 22) - 1
        share = np.maximum(np.log2(times / count[row]).astype(np.int64), -7)
        found.append(row << BITS | (mixed((shape * 16 - share + 1).astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64))
    if only is not None:
        found = [x[only[x & (1 << BITS) - 1]] for x in found]
    both = np.unique(np.concatenate(found))
    return both >> BITS, both & (1 << BITS) - 1


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, row: np.ndarray, feature: np.ndarray, rows: int) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... of each row."""
        pull = np.bincount(row, weights=self.weights[feature], minlength=rows)
        return _sigmoid(pull[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(row: np.ndarray, feature: np.ndarray, grade: np.ndarray, grades: int = GRADES, rounds: int = 500, decay: float = 1e-4) -> OrdinalModel:
    """Weights and thresholds that make the grades likely, by AdaGrad over all given rows."""
    weights = np.zeros(1 << BITS)
    if len(np.unique(grade)) < 2:
        return OrdinalModel(weights, np.full(grades - 1, -40.0))
    n = len(grade)
    share = np.clip([(grade <= k).mean() for k in range(grades - 1)], 1e-6, 1 - 1e-6)
    first, gaps = np.log(share[0] / (1 - share[0])), np.diff(np.log(share / (1 - share)))
    # Thresholds ascend: the first one is free, the gaps between them are exponentials.
    free = np.concatenate([[first], np.log(np.maximum(gaps, 1e-3))])
    squares, free_squares = np.full(len(weights), 1e-8), np.full(len(free), 1e-8)
    # Only features that shift the mean grade clearly get a weight; the many rare words would add noise.
    seen = np.bincount(feature, minlength=len(weights))
    shift = np.bincount(feature, weights=(grade - grade.mean())[row], minlength=len(weights))
    used = (seen >= LEAST_SEEN) & (np.abs(shift) >= LEAST_SHIFT * grade.std() * np.sqrt(seen))
    row, feature = row[used[feature]], feature[used[feature]]
    for _ in range(rounds):
        thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        pull = np.bincount(row, weights=weights[feature], minlength=n)
        upto = np.concatenate([np.zeros((n, 1)), _sigmoid(thresholds[None, :] - pull[:, None]), np.ones((n, 1))], axis=1)
        slope = upto * (1 - upto)
        at = np.arange(n)
        likely = np.maximum(upto[at, grade + 1] - upto[at, grade], 1e-12)
        # Derivatives of -log(likely) in the pull and in each threshold.
        by_pull = (slope[at, grade + 1] - slope[at, grade]) / likely
        by_threshold = np.array([(np.where(grade == k + 1, slope[:, k + 1], 0) - np.where(grade == k, slope[:, k + 1], 0)) @ (1 / likely) for k in range(grades - 1)]) / n
        step = np.bincount(feature, weights=by_pull[row], minlength=len(weights)) / n + decay * weights
        squares += step * step
        weights -= used * 0.2 * step / np.sqrt(squares)
        later = np.cumsum(by_threshold[::-1])[::-1]
        step = np.concatenate([later[:1], later[1:] * np.exp(free[1:])])
        free_squares += step * step
        free -= 0.1 * step / np.sqrt(free_squares)
    return OrdinalModel(weights, np.cumsum(np.concatenate([free[:1], np.exp(free[1:])])))


def graded(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) of the labels: 0 toxic, 1 poor, 2 good."""
    whole = labels.where("doc_id is not null and quality is not null and toxic is not null")
    grade = F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2)
    return whole.groupBy("doc_id").agg(F.min(grade).alias("grade"))


def train(docs: DataFrame, grades: DataFrame, fit_rows: int = FIT_ROWS) -> OrdinalModel:
    """Fit on the ``fit_rows`` graded documents whose ids hash lowest."""
    small_batches(docs.sparkSession)
    # Bounded by fit_rows rows of two numbers, so it may be broadcast.
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("grade", "text")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, feature = features(batch.column(1))
        cuts = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(feature.astype(np.int32)))
        return pa.RecordBatch.from_arrays([batch.column(0), lists], ["grade", "features"])

    got = map_texts(rows, 1, work, "grade int, features array<int>").toArrow()
    lists = got.column("features").combine_chunks()
    counts = np.asarray(pc.list_value_length(lists), dtype=np.int64)
    feature = np.asarray(lists.flatten(), dtype=np.int64)
    grade = np.asarray(got.column("grade"), dtype=np.int64)
    # Rows arrive in any order; sums are taken in one fixed order, so that reruns agree.
    starts = np.concatenate([[0], np.cumsum(counts)])
    keys = [(int(g), feature[a:b].tobytes()) for g, a, b in zip(grade, starts, starts[1:], strict=False)]
    order = sorted(range(len(keys)), key=keys.__getitem__)
    feature = np.concatenate([feature[starts[i] : starts[i + 1]] for i in order]) if order else feature
    return fit(np.repeat(np.arange(len(order)), counts[order]), feature, grade[order])


def score(docs: DataFrame, model: OrdinalModel, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """All columns of ``docs`` but those of the same names, with ``expected_grade``, ``tail_probability`` and ``keep``."""
    small_batches(docs.sparkSession)
    made = ["expected_grade", "tail_probability", "keep"]
    rows = docs.select(*[c for c in docs.columns if c == text or c not in made])
    at = rows.columns.index(text)

    used = np.flatnonzero(model.weights)
    used_weights, thresholds = model.weights[used], model.thresholds

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        weights = np.zeros(1 << BITS)
        weights[used] = used_weights
        tails = OrdinalModel(weights, thresholds).tails(*features(batch.column(at), weights != 0), batch.num_rows)
        last = tails[:, -1]
        columns = [pa.array(tails.sum(axis=1)), pa.array(last), pa.array(last >= keep_from)]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *made])

    schema = StructType(list(rows.schema.fields)).add(made[0], "double").add(made[1], "double").add(made[2], "boolean")
    return map_texts(rows, at, work, schema)


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> OrdinalModel:
    return train(docs, graded(table(spark, sf_dir, "labels")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs.select("doc_id", "text"), trained(spark, docs, sf_dir)).drop("text")
