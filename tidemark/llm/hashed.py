"""Hashed text features and a small optimiser, shared by the fitted models."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, release

BITS = 18
_TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")


def features(text: str | None, bits: int = BITS) -> tuple[np.ndarray, int]:
    """Distinct hashed features of a whole text and its number of tokens: which words and
    runs of signs occur, and in steps how long it is, how much repeats and how much is no word."""
    tokens = _TOKEN.findall((text or "").lower())
    n, kinds = len(tokens), set(tokens)
    if n:
        signs = sum(1 for t in tokens if not t[0].isalnum())
        kinds |= {f" length {int(np.log2(n))}", f" repeats {int(10 * (1 - len(kinds) / n))}", f" signs {int(10 * signs / n)}"}
    mask = (1 << bits) - 1
    return np.unique(np.fromiter((xxhash.xxh32_intdigest(t) & mask for t in kinds), np.int32, len(kinds))), n


def _rows(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            idx = [features(t, bits)[0].astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(idx, pa.binary())], names=["y", "idx"])

    return run


def sample_rows(docs: DataFrame, graded: DataFrame, per_class: int, classes: list, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict]:
    """(class numbers, row starts, features, rows a class has in all) of at most ``per_class`` rows of each class.

    ``graded`` is (doc_id, y); ids are chosen by hash, an id that rows share
    gives one row, and only the rows' features reach the driver.  A first cut at a hash that
    leaves about twice the rows asked for keeps a large class out of the sort.
    """
    counts = graded.where("y IS NOT NULL").groupBy("y").agg(F.count("*").alias("_n"))
    have = {r["y"]: r["_n"] for r in counts.collect()}
    share = F.least(F.lit(1.0), F.lit(2.0 * per_class + 50) / F.col("_n"))
    few = graded.select("doc_id", "y", F.xxhash64("doc_id").alias("_h")).join(F.broadcast(counts), "y") \
        .where(F.col("_h") / F.lit(2.0**63) <= 2 * share - 1)
    rank = F.row_number().over(Window.partitionBy("y").orderBy("_h"))
    chosen = few.select("doc_id", "y", rank.alias("_r")).where(F.col("_r") <= per_class).drop("_r")
    kind = dict(graded.dtypes)["y"]
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id") \
        .groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("row")).select("y", "row.text")
    # as bytes: four for a feature, where a list of numbers would take ten times that on the driver
    got = arrow_map(texts, _rows(bits), f"y {kind}, idx binary").collect()
    number = {y: i for i, y in enumerate(classes)}
    got = [r for r in got if r["y"] in number]
    sizes = np.array([len(r["idx"]) // 4 for r in got], dtype=np.int64)
    flat = np.frombuffer(b"".join(r["idx"] for r in got), "<i4").astype(np.int32)
    labels = np.array([number[r["y"]] for r in got], dtype=np.int64)
    del got
    release()
    return labels, np.concatenate([[0], np.cumsum(sizes)]), flat, have


def row_sums(weights: np.ndarray, starts: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Sum of the weights of each row's features; weights may have several columns."""
    total = np.concatenate([np.zeros((1, *weights.shape[1:])), np.cumsum(weights[flat], axis=0)])
    return total[starts[1:]] - total[starts[:-1]]


def feature_sums(values: np.ndarray, starts: np.ndarray, flat: np.ndarray, size: int) -> np.ndarray:
    """The transpose: for each feature, the sum of its rows' values."""
    return np.bincount(flat, weights=np.repeat(values, np.diff(starts)), minlength=size)


def descend(loss_and_slope: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int, rate: float) -> np.ndarray:
    """Adam with a falling rate; returns the best point seen."""
    m, v, best, least = np.zeros_like(x), np.zeros_like(x), x, np.inf
    for i in range(1, rounds + 1):
        loss, g = loss_and_slope(x)
        if loss < least:
            best, least = x.copy(), loss
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (1 - i / (rounds + 1)) * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return best
