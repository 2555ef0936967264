"""Toxicity severity by cumulative-link ordinal regression.

A severity grade 0 (clean) to G is predicted from sparse text features with
one weight vector and ordered thresholds: P(grade > k) = sigmoid(x.w - t_k).
The expected severity, the sum of these over k, is the score.

Features are words and word beginnings, valued by the logarithm of their
frequency in the text (per thousand words).  Which
features count is chosen by a likelihood-ratio statistic on the labelled rows;
their counts are summed in the tasks and merged by Spark.  Labels are binary,
so toxic documents are graded 1, 2 or 3 by thirds of their evidence: the sum of
the values of their toxic-associated words.

The model is fitted on a bounded sample: the ``max_rows`` labelled documents
whose ids hash lowest (broadcast, at most 16 bytes a row).  An id that is
repeated counts once, with the least of its texts.  The sample's rows, with at
most ``max_features`` features, go to the driver; everything else covers all
documents, by rows and without a shuffle.

Null and empty texts have no features and get the score of a text without
evidence.  Rows without a label (null) are not fitted on; contradictory labels
of one id count as toxic.  With no labelled documents, or clean ones only,
every severity is 0.  Repeated rows are scored each.  Only the named columns
are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.common import bounded_batches, ddl
from quarry.session import cut_lineage

MAX_ROWS, MAX_FEATURES = 20_000, 1_024
#: Lengths of the word beginnings used beside whole words.
PREFIXES = (4, 5, 6)
#: A feature is in at least this many labelled documents, and its likelihood ratio is significant at about 0.1 %.
MIN_DOCS, MIN_G2 = 3, 10.0
#: Expected severity from which a document is rejected.
REJECT = 0.5
WORD = re.compile(r"\w+")


def word_features(word: str) -> list[str]:
    """A word, and its beginnings (marked by a star) where it is longer than them."""
    return [word, *(word[:n] + "*" for n in PREFIXES if len(word) > n)]


def _text_counts(text: str | None) -> Counter:
    return Counter(WORD.findall((text or "").lower()))


def _value(count: int, words: int) -> float:
    return math.log1p(1000.0 * count / words)


@dataclass
class OrdinalModel:
    """Weights by feature, thresholds, and the grade above each threshold."""

    features: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    grades: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def above(self, eta: np.ndarray) -> np.ndarray:
        """P(grade above each threshold), a column per threshold."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - eta[:, None], -700, 700)))

    def severity(self, eta: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.above(eta) @ np.diff(self.grades)

    def grade(self, eta: np.ndarray) -> np.ndarray:
        """Most probable grade."""
        p = np.hstack([np.ones((len(eta), 1)), self.above(eta), np.zeros((len(eta), 1))])
        return self.grades[np.argmax(p[:, :-1] - p[:, 1:], axis=1)].astype(np.int32)


class Vectorizer:
    """Sparse feature values of texts."""

    def __init__(self, features: dict[str, int]):
        self.features = features

    def of_word(self, word: str) -> list[int]:
        return [self.features[f] for f in word_features(word) if f in self.features]

    def __call__(self, text: str | None) -> tuple[list[int], list[float], int]:
        words = _text_counts(text)
        total = sum(words.values())
        found: dict[int, int] = {}
        for w, n in words.items():
            for i in self.of_word(w):
                found[i] = found.get(i, 0) + n
        keys = sorted(found)
        return keys, [_value(found[i], total) for i in keys], total


def _minimise(f, x: np.ndarray, rounds: int = 400, keep: int = 12, tol: float = 1e-5) -> np.ndarray:
    """L-BFGS with backtracking; f gives value and gradient."""
    val, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, coef = grad.copy(), []
        for s, y in reversed(past):
            a = (s @ q) / (s @ y)
            coef.append(a)
            q -= a * y
        if past:
            s, y = past[-1]
            q *= (s @ y) / (y @ y)
        for (s, y), a in zip(past, reversed(coef)):
            q += (a - (y @ q) / (s @ y)) * s
        step, slope = 1.0 if past else 1.0 / max(1.0, np.linalg.norm(grad)), grad @ q
        while True:
            new = x - step * q
            v, g = f(new)
            if v <= val - 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        if (s := new - x) @ (y := g - grad) > 1e-12:
            past = [*past[1 - keep:], (s, y)]
        done = abs(val - v) < tol * 1e-3 * max(1.0, abs(v))
        x, val, grad = new, v, g
        if done or np.abs(grad).max() < tol:
            break
    return x


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, grade: np.ndarray, n_features: int,
                l2: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weights, thresholds, grades) of the cumulative-link model of sparse
    rows (row number, feature, value); grades are those that occur."""
    grades, y = np.unique(grade, return_inverse=True)
    k, n = len(grades) - 1, len(grade)
    if k < 1:
        return np.zeros(n_features), np.zeros(0), grades.astype(float)
    share = np.cumsum(np.bincount(y))[:-1] / n
    start = np.log(share / (1 - share))
    x0 = np.concatenate([np.zeros(n_features), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])

    def sigmoid(z):
        return 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))

    def loss(x):
        w, t = x[:n_features], np.cumsum(np.concatenate([x[n_features:n_features + 1], np.exp(np.clip(x[n_features + 1:], -30, 30))]))
        eta = np.bincount(rows, vals * w[cols], minlength=n)
        upper = np.where(y < k, t[np.minimum(y, k - 1)] - eta, np.inf)
        lower = np.where(y > 0, t[np.maximum(y - 1, 0)] - eta, -np.inf)
        su, sl = np.where(y < k, sigmoid(upper), 1.0), np.where(y > 0, sigmoid(lower), 0.0)
        gap = np.where((y < k) & (y > 0), np.exp(np.minimum(np.where((y < k) & (y > 0), lower - upper, 0.0), -1e-9)), 0.0)
        nll = -(np.log(np.maximum(su, 1e-300)) + np.log(np.maximum(1 - sl, 1e-300)) + np.log1p(-gap)).sum()
        ratio = gap / (1 - gap)
        du, dl = np.where(y < k, 1 - su + ratio, 0.0), np.where(y > 0, -sl - ratio, 0.0)
        g_w = np.bincount(cols, vals * (du + dl)[rows], minlength=n_features) + l2 * w
        g_t = -np.bincount(np.minimum(y, k - 1), du, minlength=k) - np.bincount(np.maximum(y - 1, 0), dl, minlength=k)
        tail = np.cumsum(g_t[::-1])[::-1]
        g = np.concatenate([g_w, tail[:1], tail[1:] * np.diff(t)])
        return nll + l2 / 2 * (w @ w), g

    x = _minimise(loss, x0)
    return x[:n_features], np.cumsum(np.concatenate([x[n_features:n_features + 1], np.exp(x[n_features + 1:])])), grades.astype(float)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, toxic_col: str, max_rows: int) -> DataFrame:
    """(toxic, text) of the ``max_rows`` labelled ids that hash lowest: one row an id, with its least text."""
    some = labels.where(F.col(toxic_col).isNotNull() & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).alias("_lid")).agg(F.max(F.col(toxic_col).cast("int")).alias("toxic")) \
        .orderBy(F.xxhash64("_lid"), "_lid").limit(max_rows)
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return text.join(F.broadcast(some), F.col("_id") == F.col("_lid")).groupBy("_lid", "toxic").agg(F.min("text").alias("text")) \
        .select("toxic", "text")


def _feature_counts(sample: DataFrame) -> DataFrame:
    """(feature, docs, toxic_docs), summed over each batch before Spark merges them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            every, bad = Counter(), Counter()
            for toxic, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = {f for w in set(WORD.findall((text or "").lower())) for f in word_features(w)}
                every.update(found)
                if toxic:
                    bad.update(found)
            yield pa.RecordBatch.from_arrays([pa.array(list(every), pa.string()), pa.array(list(every.values()), pa.int64()),
                                              pa.array([bad[f] for f in every], pa.int64())], names=["feature", "docs", "toxic_docs"])

    parts = bounded_batches(sample.select("toxic", "text"), 128).mapInArrow(run, "feature string, docs long, toxic_docs long")
    return parts.groupBy("feature").agg(F.sum("docs").alias("docs"), F.sum("toxic_docs").alias("toxic_docs"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
        max_rows: int = MAX_ROWS, max_features: int = MAX_FEATURES) -> OrdinalModel:
    """Fit the model on the labelled sample."""
    sample = cut_lineage(labelled_sample(docs, labels, id_col, text_col, toxic_col, max_rows))
    n, bad = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not bad or bad == n:
        return OrdinalModel(grades=np.array([1.0 if bad else 0.0]))
    a, d = F.col("toxic_docs"), F.col("docs")
    term = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    rest_bad, rest = F.lit(bad) - a, F.lit(n) - d
    g2 = 2 * (term(a, d * bad / n) + term(d - a, d * (n - bad) / n) + term(rest_bad, rest * bad / n)
              + term(rest - rest_bad, rest * (n - bad) / n))
    chosen = _feature_counts(sample).where(F.col("docs") >= MIN_DOCS).withColumn("g2", g2).where(F.col("g2") >= MIN_G2) \
        .orderBy(F.desc("g2"), "feature").limit(max_features).collect()  # at most max_features rows
    features = {r.feature: i for i, r in enumerate(chosen)}
    marked = {i for i, r in enumerate(chosen) if r.toxic_docs * n > 2 * r.docs * bad}  # more than twice as often toxic

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vec = Vectorizer(features)
        for b in batches:
            keys, vals, evidence = [], [], []
            for text in b.column(1).to_pylist():
                k, v, total = vec(text)
                keys.append(k)
                vals.append(v)
                evidence.append(sum(_value(n, total) for w, n in _text_counts(text).items() if not marked.isdisjoint(vec.of_word(w))))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.list_(pa.int32())), pa.array(vals, pa.list_(pa.float64())),
                                              pa.array(evidence, pa.float64())], names=["toxic", "keys", "vals", "evidence"])

    got = bounded_batches(sample.select("toxic", "text")) \
        .mapInArrow(run, "toxic int, keys array<int>, vals array<double>, evidence double").toArrow()  # max_rows rows
    toxic, evidence = got["toxic"].to_numpy(), got["evidence"].to_numpy()
    thirds = np.quantile(evidence[toxic > 0], [1 / 3, 2 / 3])
    grade = np.where(toxic > 0, 1 + (evidence[:, None] > thirds).sum(axis=1), 0)
    lists = got["keys"].combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    w, t, grades = fit_ordinal(np.repeat(np.arange(len(grade)), sizes), lists.flatten().to_numpy().astype(np.int64),
                               got["vals"].combine_chunks().flatten().to_numpy(), grade, len(features))
    return OrdinalModel(features, w, t, grades)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text",
          keep: Sequence[str] = ()) -> DataFrame:
    """(id, severity, grade) of every document, and the columns in ``keep`` as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # max_features weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        vec = Vectorizer(m.features)
        for b in batches:
            eta = np.zeros(b.num_rows)
            for i, text in enumerate(b.column(1).to_pylist()):
                k, v, _ = vec(text)
                if k:
                    eta[i] = m.weights[k] @ np.array(v)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.severity(eta)), pa.array(m.grade(eta)), *b.columns[2:]],
                                             names=[id_col, "severity", "grade", *keep])

    src = bounded_batches(docs.select(id_col, F.col(text_col).cast("string").alias("_text"), *keep))
    return src.mapInArrow(run, ddl(src, [id_col], "severity double, grade int", keep))


def rejected(cut: float = REJECT):
    """The rule on a severity column."""
    return F.col("severity") >= cut
