"""Mixing to target weights with soft membership.

A classifier fitted on the labelled rows predicts each document's domain posteriors, so
a document may belong to several domains in part.  Nonnegative document rates are then
fitted by projected gradient: the expected tokens of domain k are the sum over
documents of rate x tokens x posterior_k, and their squared distances to the targets,
each relative to the domain's present share, are made least, with a slight pull of
every rate towards 1.

One round is one pass over the stored posteriors that sums as many numbers as there are
domains; rates are not stored, since the rate of a document follows from its own
posteriors and the rounds' residuals so far, which are a few numbers each.  In the
metric used the largest curvature is 1, so a step of 1 / (1 + pull) always descends.

Defined cases: a null or empty text has no tokens, and its rate moves no total; labelled
rows without a domain teach nothing; with no labelled domain, or no tokens, every rate
is 1; a target for a domain that is not labelled is an error; a domain without tokens
takes no part; with more than 16 domains the texts' features are hashed to fewer places
and fewer rows of each domain are fitted, so that neither the classifier nor its rows grow; repeated rows get equal rates; a column
called like one that is added (n_tokens, domain, p_domain, rate, copies) is replaced;
names that begin with _mix_ are the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, cut, release
from tidemark.llm.hashed import BITS, descend, feature_sums, features, row_sums, sample_rows

#: Labelled rows that the classifier is fitted on: of each domain, and in all (but one of each domain at least).
PER_DOMAIN, FIT_ROWS = 1500, 12_000
#: Weights of the classifier, features x domains, and of any working array of its fit.
CELLS = 1 << 22
#: Without given targets a domain's target share is its share to this power (0: all alike, 1: as they are).
TEMPERATURE = 0.5
PULL = 1e-3
ROUNDS = 40


class DomainModel:
    """Softmax regression on hashed features."""

    def __init__(self, domains: list[str], weights: np.ndarray, bias: np.ndarray):
        self.domains, self.weights, self.bias = domains, weights, bias

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        rows = [features(t, len(self.weights).bit_length() - 1) for t in texts]
        z = np.array([self.weights[i].sum(axis=0) / np.sqrt(max(1, len(i))) for i, _ in rows]).reshape(len(rows), -1) + self.bias
        e = np.exp(z - z.max(axis=1, keepdims=True, initial=-np.inf)) if len(rows) else z
        return e / e.sum(axis=1, keepdims=True) if len(rows) else e, np.array([n for _, n in rows], dtype=np.int64)


def fit_domains(docs: DataFrame, labelled: DataFrame, per_domain: int = PER_DOMAIN, bits: int = BITS,
                ridge: float = 1e-5, rounds: int = 60) -> DomainModel:
    """Fit on documents of ``labelled`` (doc_id, y), at most ``per_domain`` rows of each domain y
    and FIT_ROWS in all, with at most CELLS weights; rows are taken in blocks of CELLS values."""
    known = labelled.where(F.col("y").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("y").alias("y"))
    domains = sorted(r["y"] for r in known.select("y").distinct().collect())
    k = len(domains)
    if not k:
        return DomainModel([], np.zeros((1 << bits, 0), np.float32), np.zeros(0))
    bits = max(1, min(bits, (CELLS // k).bit_length() - 1))
    y, starts, flat, have = sample_rows(docs, known, min(per_domain, max(1, FIT_ROWS // k)), domains, bits)
    used, flat = np.unique(flat, return_inverse=True)
    scale = 1 / np.sqrt(np.maximum(1, np.diff(starts)))
    n = np.bincount(y, minlength=k)
    weight = np.array([have.get(d, 0) / max(1, n[i]) for i, d in enumerate(domains)])[y]
    weight /= max(1e-12, weight.sum())

    block = max(1, CELLS // k)

    def slope(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[k:].reshape(len(used), k), x[:k]
        loss, slopes, g = ridge / 2 * (w * w).sum(), np.zeros(k), ridge * w
        for at in range(0, len(y), block):
            end = min(len(y), at + block)
            own, ends, rows = flat[starts[at]:starts[end]], starts[at:end + 1] - starts[at], np.arange(end - at)
            d = np.stack([row_sums(w[:, j], ends, own) for j in range(k)], axis=1) * scale[at:end, None] + b
            np.exp(d - d.max(axis=1, keepdims=True), out=d)
            d /= d.sum(axis=1, keepdims=True)
            loss -= (weight[at:end] * np.log(np.maximum(d[rows, y[at:end]], 1e-12))).sum()
            d[rows, y[at:end]] -= 1
            d *= weight[at:end, None]
            slopes += d.sum(axis=0)
            for j in range(k):
                g[:, j] += feature_sums(d[:, j] * scale[at:end], ends, own, len(used))
        return float(loss), np.concatenate([slopes, g.ravel()])

    x = descend(slope, np.zeros(k + len(used) * k), rounds, 0.2)
    weights = np.zeros((1 << bits, k), np.float32)
    weights[used] = x[k:].reshape(len(used), k)
    release()
    return DomainModel(domains, weights, x[:k])


def rates(p: np.ndarray, history: list[np.ndarray], least: float, pull: float = PULL) -> np.ndarray:
    """The rates after the rounds whose weighted residuals are ``history``."""
    r = np.full(len(p), max(1.0, least))
    for g in history:
        r = np.maximum(least, r - (p @ g + pull * (r - 1)) / (1 + pull))
    return r


def _sums(history: list[np.ndarray], least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | float = 0.0
        for batch in batches:
            p, t = np.array(batch.column("p").to_pylist(), dtype=float), batch.column("n_tokens").to_numpy().astype(float)
            if len(p):
                total = total + (rates(p, history, least) * t) @ p
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.float64())], names=["k", "x"])

    return run


def fit_rates(stored: DataFrame, k: int, targets: np.ndarray | None = None, least: float = 0.0, temperature: float = TEMPERATURE,
              rounds: int = ROUNDS) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(residuals of the rounds, target token totals, reached totals) for ``stored`` posteriors (p, n_tokens).

    ``targets`` are shares by domain.  With ``least`` of 0 the total of tokens stays as it
    is; with a floor of 1 no document may shrink, so the total is the smallest that lets
    every domain reach its share.
    """
    def totals(history: list[np.ndarray]) -> np.ndarray:
        out = np.zeros(k)
        for r in arrow_map(stored, _sums(history, least), "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect():
            out[r["k"]] = r["x"]
        return out

    now = totals([])
    whole = now.sum()
    if not whole:
        return [], now, now
    share = now / whole
    goal = np.asarray(targets, float) if targets is not None else np.where(share > 0, share**temperature, 0.0)
    goal = np.where(share > 0, goal, 0.0)
    goal = goal / goal.sum()
    size = max(1.0, least * float(np.max(np.where(goal > 0, share / np.maximum(goal, 1e-300), 0)))) * whole
    weight = np.where(share > 0, 1 / np.maximum(share, 1e-300), 0.0) / whole
    history: list[np.ndarray] = []
    for _ in range(rounds):
        history.append((now - goal * size) * weight)
        after = totals(history)
        moved, now = np.abs(after - now).max() / whole, after
        if moved < 1e-9:
            break
    return history, goal * size, now


def _posteriors(model, kept: list[str]):
    """model: the broadcast classifier."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, t = model.value.posteriors(batch.column("_mix_text").to_pylist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(p.tolist(), pa.list_(pa.float64())), pa.array(t)],
                                             names=[*kept, "_mix_p", "n_tokens"])

    return run


def rate_of(p: Column, history: list[np.ndarray], least: float, pull: float = PULL) -> Column:
    """:func:`rates` as an expression over the posteriors."""
    start = F.lit(max(1.0, least))
    if not history:
        return start
    rounds = F.array(*[F.lit(np.asarray(g, float)) for g in history])

    def step(r: Column, g: Column) -> Column:
        along = F.aggregate(F.zip_with(p, g, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
        return F.greatest(F.lit(float(least)), r - (along + F.lit(pull) * (r - 1)) / F.lit(1 + pull))

    return F.aggregate(rounds, start, step)


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, least: float = 0.0,
        text: str = "text", doc_id: str = "doc_id", keep_text: bool = True) -> DataFrame:
    """``docs`` with n_tokens, domain (the likeliest), p_domain, rate and copies: rate rounded
    up or down by a hash of the row, so that it is right in expectation and the same on
    every run.  ``labelled`` is (doc_id, y), y being the domain; ``least`` a floor of rates.
    Texts are read once: the rows are stored with their posteriors, and with their text
    unless ``keep_text`` is False."""
    added = ["n_tokens", "domain", "p_domain", "rate", "copies"]
    kept = [c for c in docs.columns if c not in added and (keep_text or c != text)]
    model = fit_domains(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), labelled)
    unknown = sorted(d for d, share in (targets or {}).items() if share and d not in model.domains)
    if model.domains and unknown:
        raise ValueError(f"targets for domains without labelled rows: {unknown}")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    chance = F.pmod(F.xxhash64(F.col(doc_id), F.col(text), F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    plain = [c for c in kept if c != text]
    source = docs.select(*plain, F.col(text).alias("_mix_text"), chance.alias("_mix_chance"))
    passed = [*plain, "_mix_chance", *(["_mix_text"] if text in kept else [])]
    schema = T.StructType([docs.schema[c] for c in plain] + [T.StructField("_mix_chance", T.DoubleType())]
                          + ([T.StructField("_mix_text", T.StringType())] if text in kept else [])
                          + [T.StructField("_mix_p", T.ArrayType(T.DoubleType())), T.StructField("n_tokens", T.LongType())])
    stored = cut(arrow_map(source, _posteriors(sent, passed), schema), "posteriors")
    sent.unpersist()
    history: list[np.ndarray] = []
    if model.domains:
        goal = None if targets is None else np.array([targets.get(d, 0.0) for d in model.domains])
        history, _, _ = fit_rates(stored.select(F.col("_mix_p").alias("p"), "n_tokens"), len(model.domains), goal, least)
    top = F.array_max("_mix_p")
    names = F.array(*[F.lit(d) for d in model.domains]) if model.domains else F.lit(None).cast("array<string>")
    rated = stored.withColumn("rate", rate_of(F.col("_mix_p"), history, least)).withColumn("_mix_whole", F.floor("rate"))
    columns = {c: F.col("_mix_text").alias(text) if c == text else F.col(f"`{c}`") for c in kept}
    return rated.select(
        *columns.values(), "n_tokens", F.element_at(names, F.array_position("_mix_p", top).cast("int")).alias("domain"),
        F.coalesce(top, F.lit(1.0)).alias("p_domain"), "rate",
        (F.col("_mix_whole") + F.when(F.col("_mix_chance") < F.col("rate") - F.col("_mix_whole"), 1).otherwise(0)).cast("int").alias("copies"))


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of the rows of :func:`mix`, each as often as its copies say."""
    return mixed.where("copies > 0").withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*columns)
