"""Quality classifier: Bradley-Terry ranking of documents from preference pairs.

A document's strength is a linear function of features of its whole text. Every pair (better, worse) of labelled
documents says that the first is stronger; the weights minimise the logistic loss on the features' difference. The
decision threshold is a quantile of the strengths of the labelled documents.

Edge cases: a null text counts as empty; an empty text has zero for every feature; labels that are null or whose id has
no document are ignored; where one of the two labels is absent, every document scores 0.5 and is accepted. Repeated rows
are scored alike. An empty table gives an empty result. Other columns, whatever their names, are kept and not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import append_columns

# The model is fitted on about this many labelled rows, chosen by a hash of their id, and on this many pairs of them.
FIT_ROWS = 20_000
FIT_PAIRS = 60_000

# Byte classes whose share of the text is a feature: each printable ASCII mark, then groups.
_MARKS = [byte for byte in range(33, 127) if not chr(byte).isalnum()]
_GROUPS = [range(48, 58), range(65, 91), range(97, 123), range(128, 256), (32,), (9, 10, 11, 12, 13)]
FEATURES = len(_MARKS) + len(_GROUPS) + 9


def features(text: str | None) -> np.ndarray:
    """Shares of byte classes, and word and line statistics, of the whole text."""
    out = np.zeros(FEATURES, dtype=np.float64)
    words = (text or "").split()
    if not words:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) / len(raw)
    shares = np.array([*(counts[byte] for byte in _MARKS), *(counts[list(group)].sum() for group in _GROUPS)])
    out[:len(shares)] = np.log1p(200 * shares)
    lines = [line for line in text.split("\n") if line.strip()]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    distinct = len(set(words))
    out[len(shares):] = (
        np.log1p(len(words)),
        np.log1p(len(words) / len(lines)),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        (lengths <= 3).mean(),
        distinct / len(words),
        np.log(distinct) / np.log(len(words) + 1),
        len(set(lines)) / len(lines),
        sum(line[-1] in ".!?" for line in (line.rstrip() for line in lines)) / len(lines),
    )
    return out


@dataclass(frozen=True)
class QualityModel:
    centre: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        strength = (rows - self.centre) @ self.weights
        return 1 / (1 + np.exp(-np.clip(strength - self.threshold, -50, 50)))


def fit_bradley_terry(rows: np.ndarray, labels: np.ndarray, pairs: int = FIT_PAIRS, ridge: float = 1e-3,
                      seed: int = 7) -> QualityModel:
    """Newton steps on the mean logistic loss of feature differences, then the quantile that separates best."""
    better, worse = np.flatnonzero(labels == 1), np.flatnonzero(labels == 0)
    if not len(better) or not len(worse):
        return QualityModel(np.zeros(FEATURES), np.zeros(FEATURES), 0.0)
    spread = rows.std(axis=0)
    spread[spread < 1e-9] = 1
    centre = rows.mean(axis=0)
    random = np.random.default_rng(seed)
    difference = (rows[random.choice(better, pairs)] - rows[random.choice(worse, pairs)]) / spread
    weights = np.zeros(rows.shape[1])
    for _ in range(25):
        wrong = 1 / (1 + np.exp(np.clip(difference @ weights, -50, 50)))
        gradient = difference.T @ wrong / pairs - ridge * weights
        curvature = (difference * (wrong * (1 - wrong))[:, None]).T @ difference / pairs
        step = np.linalg.solve(curvature + ridge * np.eye(len(weights)), gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    weights = weights / spread
    strength = (rows - centre) @ weights
    # Accuracy of each score quantile as the threshold; the middle of the best ones.
    levels = np.linspace(0, 1, 401)
    cuts = np.quantile(strength, levels)
    order = np.sort(strength[better]), np.sort(strength[worse])
    right = (len(better) - np.searchsorted(order[0], cuts)) + np.searchsorted(order[1], cuts)
    best = np.flatnonzero(right == right.max())
    return QualityModel(centre, weights, float(np.median(cuts[best])))


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> QualityModel:
    """Fit on about ``rows`` labelled documents; the labelled ids, not the corpus, are what is broadcast."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"))
    count = usable.count()
    share = min(1.0, rows / max(count, 1))
    # A hash of the id decides: about `rows` ids, never a prefix of the table.
    sample = usable.where(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000)) < int(share * 1_000_000))
    known = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    fields = [T.StructField("values", T.ArrayType(T.DoubleType()))]
    measured = append_columns(known, "text", fields, lambda texts: [
        pa.array([features(text) for text in texts], type=pa.list_(pa.float64()))]).drop("text")
    found = sorted((row["doc_id"], row["quality"], tuple(row["values"])) for row in measured.collect())
    if not found:
        return QualityModel(np.zeros(FEATURES), np.zeros(FEATURES), 0.0)
    return fit_bradley_terry(np.array([row[2] for row in found]), np.array([row[1] for row in found]))


def score_quality(docs: DataFrame, model: QualityModel, column: str = "score") -> DataFrame:
    """Append the score (0 to 1); at 0.5 or more the document reaches the model's score quantile."""
    def run(texts):
        if not texts:
            return [pa.array([], type=pa.float64())]
        return [pa.array(model.score(np.stack([features(text) for text in texts])), type=pa.float64())]
    return append_columns(docs, "text", [T.StructField(column, T.DoubleType())], run)
