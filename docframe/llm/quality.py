"""Quality classifier by positive-unlabelled learning.

A small network is fitted on text statistics by minimising the non-negative unbiased risk (Kiryo et al., 2017) with
trusted positives, unlabelled web text and an estimated class prior. Labels of other values than positive are never used.
The prior is the least ratio of unlabelled to positive mass over regions in which a first classifier puts many positives
(after Scott, 2015). Both samples hold ``max_sample`` rows at most, those with the smallest hashes of all rows; scoring
covers every row and whole texts, row by row, without a shuffle.

Defined results: a null text counts as empty; empty texts get the score that the network gives to their statistics; with
no trusted positives or no other text each score is 0.5; repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import fold, read_table, sampled

MAX_SAMPLE = 8000
FOLDS = 5
THRESHOLD = 0.3
#: Names of the statistics of a text.
FEATURES = (
    "log_words", "word_length", "word_length_spread", "upper", "digits", "punctuation", "symbols", "bars", "exclamations", "spaces", "newlines",
    "distinct_words", "repeats", "distinct_trigrams", "top_word", "sentence_ends", "sentence_words", "short_words", "long_words", "capital_starts",
)


def _classes() -> np.ndarray:
    """(640, 9): which of the first code points belong to which class of characters; the last row stands for all others."""
    table = np.zeros((640, 9))
    for c in range(639):
        ch = chr(c)
        table[c] = (ch.isupper(), ch.isdigit(), ch in ".,;:'\"()-?", ch in "#$%&*+/<=>@[\\]^_`{}~", ch == "|", ch == "!", ch == " ", ch == "\n", ch in ".!?")
    return table


CLASSES = _classes()


def text_features(text: str | None) -> list[float]:
    text = text or ""
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 639)
    n = max(1, len(codes))
    upper, digits, punct, symbols, bars, excl, spaces, lines, ends = (np.bincount(codes, minlength=640) @ CLASSES).tolist()
    words = text.split()
    k = len(words)
    lengths = np.fromiter(map(len, words), np.int64, k)
    m = max(1, k)
    distinct = len(set(words))
    repeats = sum(a == b for a, b in zip(words, words[1:], strict=False))
    trigrams = len(set(zip(words, words[1:], words[2:], strict=False)))
    top = 0
    if k:
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        top = max(counts.values())
    return [
        np.log1p(k), lengths.mean() if k else 0.0, lengths.std() if k else 0.0, upper / n, digits / n, punct / n, symbols / n, bars / n, excl / n, spaces / n, lines / n,
        distinct / m, repeats / m, trigrams / max(1, k - 2), top / m, ends / m, np.log1p(k / max(1.0, ends)), float((lengths <= 2).sum()) / m, float((lengths >= 12).sum()) / m,
        sum(w[0].isupper() for w in words) / m,
    ]


def feature_column(text: Column) -> Column:
    @F.pandas_udf("array<float>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.asarray(text_features(t), np.float32) for t in texts])

    return of(text)


@dataclass
class PUModel:
    """Standardisation and a network with one hidden layer; ``weights`` is None for the model without training data."""

    mean: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray] | None
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(x))
        return forward(self.weights, np.clip((x - self.mean) / self.spread, -6, 6))[1]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ w[0] + w[1])
    return hidden, hidden @ w[2] + w[3][0]


def _backward(w: list[np.ndarray], x: np.ndarray, hidden: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
    inner = np.outer(slope, w[2]) * (1 - hidden**2)
    return [x.T @ inner, inner.sum(0), hidden.T @ slope, np.array([slope.sum()])]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pu_gradient(w: list[np.ndarray], pos: np.ndarray, unl: np.ndarray, prior: float) -> tuple[float, list[np.ndarray]]:
    """The estimated risk of the negatives, prior * E+[l(f, +)] left out, and the gradient to descend along.

    While that risk is not negative this is the gradient of the non-negative PU risk of the logistic loss; below zero the
    network is overfitted and goes up the negative part alone.
    """
    hp, fp = forward(w, pos)
    hu, fu = forward(w, unl)
    negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
    grads = [a - b for a, b in zip(_backward(w, unl, hu, _sigmoid(fu) / len(unl)), _backward(w, pos, hp, prior * _sigmoid(fp) / len(pos)), strict=True)]
    if negative < 0:
        return negative, [-g for g in grads]
    return negative, [a + b for a, b in zip(grads, _backward(w, pos, hp, prior * (_sigmoid(fp) - 1) / len(pos)), strict=True)]


def fit_network(pos: np.ndarray, unl: np.ndarray, prior: float | None, hidden: int = 12, steps: int = 600, rate: float = 0.02, decay: float = 1e-3) -> list[np.ndarray]:
    """Adam on the whole samples. With a prior: the non-negative PU risk of the logistic loss; without: positives against unlabelled."""
    rng = np.random.default_rng(7)
    w = [rng.normal(0, 0.3, (pos.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 0.3, hidden), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for t in range(1, steps + 1):
        if prior is None:
            hp, fp = forward(w, pos)
            hu, fu = forward(w, unl)
            grads = [a + b for a, b in zip(_backward(w, pos, hp, (_sigmoid(fp) - 1) / len(pos)), _backward(w, unl, hu, _sigmoid(fu) / len(unl)), strict=True)]
        else:
            _, grads = pu_gradient(w, pos, unl, prior)
        for i, g in enumerate(grads):
            g = g + decay * w[i] * (w[i].ndim == 2)
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] = w[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return w


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Class prior of the unlabelled rows from positives and unlabelled rows alone, on halves the classifier did not see."""
    w = fit_network(pos[::2], unl[::2], None, steps=200)
    p, u = np.sort(forward(w, pos[1::2])[1]), np.sort(forward(w, unl[1::2])[1])
    if not len(p) or not len(u):
        return 0.5
    cuts = np.quantile(p, np.linspace(0.02, 0.5, 13))
    ratios = [np.mean(u >= c) / max(1e-9, np.mean(p >= c)) for c in cuts]
    return float(np.clip(np.min(ratios), 0.05, 0.99))


def fit(docs: DataFrame, labels: DataFrame, max_sample: int = MAX_SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> PUModel:
    """Learns from rows outside fold 0. At most ``max_sample`` positives and as many unlabelled rows reach the driver."""
    train = fold(F.col("k"), FOLDS) != 0
    known = labels.select(F.col(id_col).alias("k"), F.col(label_col).alias("label")).where("label = 1 and k is not null").where(train).select("k").distinct()
    trusted = sampled(known, F.col("k"), max_sample)
    texts = docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).where(train)
    whole = F.struct("k", "t")
    pos = sampled(texts.join(F.broadcast(trusted), "k", "left_semi"), whole, max_sample).select(feature_column(F.col("t")).alias("x"), F.lit(1).alias("y"))  # at most max_sample ids
    unl = sampled(texts, whole, max_sample).select(feature_column(F.col("t")).alias("x"), F.lit(0).alias("y"))
    got = pos.union(unl).toPandas()
    width = len(FEATURES)
    x = np.asarray(got["x"].tolist(), float).reshape(-1, width)
    y = got["y"].to_numpy()
    x = x[np.lexsort((*x.T, y))] if len(x) else x  # an order that does not depend on partitions
    y = np.sort(y)
    rng = np.random.default_rng(11)
    p, u = x[y == 1], x[y == 0]
    if not len(p) or not len(u):
        return PUModel(np.zeros(width), np.ones(width), None, 0.5)
    p, u = p[rng.permutation(len(p))], u[rng.permutation(len(u))]
    mean, spread = u.mean(0), u.std(0) + 1e-6
    p, u = (np.clip((a - mean) / spread, -6, 6) for a in (p, u))
    prior = estimate_prior(p, u)
    return PUModel(mean, spread, fit_network(p, u, prior), prior)


def score_column(text: Column, model: PUModel) -> Column:
    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.asarray([text_features(t) for t in texts], float).reshape(-1, len(FEATURES))
            yield pd.Series(model.scores(x))

    return of(text)


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return docs.where(score_column(F.col(text_col), model) >= threshold)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", F.coalesce(fold(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), score_column(F.col("text"), model).alias("score"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op3_quality": op3_quality}
ORACLE_SQL: dict[str, str] = {}
