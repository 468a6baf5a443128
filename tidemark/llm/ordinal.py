"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features gives every document a place on a line;
ordered thresholds cut the line into grades: P(grade <= k) = sigmoid(threshold_k -
place).  From these come the expected grade and the tail probability that selection
goes by.  The grades of the given labels are 0 (toxic), 1 (poor), 2 (good).

The model is fitted on a bounded sample: at most PER_GRADE rows of each grade, chosen by
hash and weighted back to the grades' shares.  Scoring is one pass over whole texts.

Defined cases: labels that are null or of unknown documents teach nothing; a document
labelled twice takes its lowest grade; a null or empty text has no features and is
placed at 0; without a usable label no grade is better than another (all
probabilities alike); repeated rows get a row each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map
from tidemark.llm.hashed import BITS, descend, feature_sums, features, row_sums, sample_rows

GRADES = 3
#: Rows of each grade that the model is fitted on.
PER_GRADE = 4000
#: Standard scores below which a feature tells nothing.
LEAST_EVIDENCE = 3.0
#: Selection: probability of the best grade at least this.
TAIL = 0.5


def grades(labels: DataFrame) -> DataFrame:
    """(doc_id, y): 0 toxic, 1 of low quality, 2 neither; the lowest of a document's labels."""
    y = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("toxic") == 0) & (F.col("quality") == 1), 2)
    return labels.select("doc_id", y.alias("y")).where(F.col("y").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.min("y").alias("y"))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def grade_probabilities(place: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    below = _sigmoid(thresholds[None, :] - place[:, None])
    return np.diff(np.concatenate([np.zeros((len(place), 1)), below, np.ones((len(place), 1))], axis=1), axis=1)


def evidence(y: np.ndarray, starts: np.ndarray, flat: np.ndarray, size: int, least: float = LEAST_EVIDENCE) -> np.ndarray:
    """How surely each feature goes with one side of a threshold: the largest standard
    score, over the thresholds, of the share of its rows above, less ``least``, as a
    factor from 0 to 1.  Words that chance alone explains are left out, so long texts
    don't add them up."""
    n = np.maximum(1, np.bincount(flat, minlength=size))
    score = np.zeros(size)
    for k in range(1, int(y.max()) + 1):
        above = (y >= k).astype(float)
        spread = max(1e-9, float(above.std()))
        score = np.maximum(score, np.abs(feature_sums(above, starts, flat, size) / n - above.mean()) * np.sqrt(n) / spread)
    return np.clip((score - least) / least, 0, 1)


def fit(docs: DataFrame, graded: DataFrame, k: int = GRADES, per_grade: int = PER_GRADE, bits: int = BITS,
        ridge: float = 1e-4, rounds: int = 150) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds); thresholds stay ordered, as steps above the first are exponentials."""
    y, starts, flat, have = sample_rows(docs, graded, per_grade, list(range(k)))
    size = 1 << bits
    if len(np.unique(y)) < 2:
        return np.zeros(size), np.log(np.arange(1, k) / np.arange(k - 1, 0, -1))
    used, flat = np.unique(flat, return_inverse=True)
    strength = evidence(y, starts, flat, len(used))
    n = np.bincount(y, minlength=k)
    weight = np.array([have.get(i, 0) / max(1, n[i]) for i in range(k)])[y]
    weight /= weight.sum()

    def thresholds(x: np.ndarray) -> np.ndarray:
        return x[0] + np.concatenate([[0.0], np.cumsum(np.exp(x[1:k - 1]))])

    def slope(x: np.ndarray) -> tuple[float, np.ndarray]:
        cuts, w = thresholds(x), x[k - 1:]
        place = row_sums(w * strength, starts, flat)
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        hi, lo = _sigmoid(edges[y + 1] - place), _sigmoid(edges[y] - place)
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = weight * hi * (1 - hi) / p, weight * lo * (1 - lo) / p
        g = np.empty_like(x)
        g[k - 1:] = strength * feature_sums(dhi - dlo, starts, flat, len(used)) + ridge * w
        at = np.bincount(y, weights=-dhi, minlength=k)[:k - 1] + np.bincount(y, weights=dlo, minlength=k)[1:]
        g[0] = at.sum()
        g[1:k - 1] = [np.exp(x[j]) * at[j:].sum() for j in range(1, k - 1)]
        return float(-(weight * np.log(p)).sum() + ridge / 2 * (w * w).sum()), g

    x = descend(slope, np.concatenate([[-1.0], np.zeros(k - 2), np.zeros(len(used))]), rounds, 0.15)
    weights = np.zeros(size)
    weights[used] = x[k - 1:] * strength
    return weights, thresholds(x)


def score(docs: DataFrame, weights: np.ndarray, thresholds: np.ndarray, tail: float = TAIL) -> DataFrame:
    """doc_id, place, expected_grade, p_best (of the best grade), p_worst, selected, for every row."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = sent.value
        for batch in batches:
            place = np.array([float(w[features(t)[0]].sum()) for t in batch.column("text").to_pylist()])
            p = grade_probabilities(place, thresholds)
            cols = [place, p @ np.arange(p.shape[1]), p[:, -1], p[:, 0], p[:, -1] >= tail]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, cols)],
                                             names=["doc_id", "place", "expected_grade", "p_best", "p_worst", "selected"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                     "doc_id long, place double, expected_grade double, p_best double, p_worst double, selected boolean")
