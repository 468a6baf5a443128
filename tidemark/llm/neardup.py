"""Embedding near-duplicates with an inverted multi-index.

Vectors are cut in halves and each half has a codebook of its own; a cell of the
product grid is a pair of codewords, and every vector is filed in the cell of its two
nearest ones.  A query walks the grid by multi-sequence traversal: cells in order of
the sum of two lower bounds, read off two sorted lists with a heap, until the sum passes the
squared distance of the least cosine.  The bounds hold for every member: a codeword's members
lie within its radius, measured over all vectors, and on its side of the plane halfway to the
query's own codeword.  So no neighbour lies beyond the end of a walk, and the sample that the
codebooks are fitted on bears on the time only.  Cells travel by regions, codewords near each
other in each half being one group, and what a visited region holds is verified by cosine in
double precision.

Equal vectors are one class from the start.  Of two regions one asks the other, so a pair
is met once.  A region's members and the queries that visit it are dealt in blocks over
tasks, so a region with a third of all vectors is many blocks; a block sends back, for each
vector, a count and one link to the smallest vector it is joined with, never the pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing; shorter vectors count as padded with zeros; equal vectors link;
repeated rows link like any equal vectors; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, cut
from tidemark.llm.graph import components

MIN_COSINE = 0.9
#: Vectors the codebooks are fitted on, chosen by hash.
FIT_ROWS = 20_000
#: Vectors a cell should hold, members of a region or of a block of a larger one, queries compared at a time.
PER_CELL, REGION, BLOCK = 16, 8192, 1024
#: Taken off each lower bound for rounding; codewords nearer than the gap have no plane between them.
SLACK, LEAST_GAP = 1e-6, 1e-3


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1) if raw else np.zeros((0, 2))
    if not len(x):
        return x
    # by the largest component first: squares of very large or small ones leave the range of doubles
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _clean(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch.column("v").to_pylist():
                x = np.zeros(dim)
                good = bool(v) and None not in v
                if good:
                    x[:len(v)] = v
                    good = bool(np.isfinite(x).all() and x.any())
                out.append((x + 0.0).astype("<f8").tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("vec_id"), pa.array(out, pa.binary())],
                                             names=["rid", "vec_id", "raw"])

    return run


def fit_codebook(x: np.ndarray, k: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """k-means of the rows of ``x``."""
    rng = np.random.default_rng(seed)
    book = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, book)
        size = np.bincount(near, minlength=len(book))
        total = np.zeros_like(book)
        np.add.at(total, near, x)
        book[size > 0] = total[size > 0] / size[size > 0, None]
    return book


def distances(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ book.T + (book * book).sum(1)[None, :], 0)


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i:i + 4096], book).argmin(1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def walk(left: np.ndarray, right: np.ndarray, steps: int | None, limit: float = math.inf) -> list[int]:
    """Multi-sequence traversal: the first ``steps`` cells (None: all) by left[i] + right[j] whose
    sum is within ``limit``, as i * len(right) + j."""
    a, b = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    la, lb, width = left[a].tolist(), right[b].tolist(), len(right)
    heap, out, reached = [(la[0] + lb[0], 0, 0)], [], {}
    while heap and (steps is None or len(out) < steps):
        total, i, j = heapq.heappop(heap)
        if total > limit:
            break
        out.append(int(a[i]) * width + int(b[j]))
        reached[i] = j
        # a cell is ready once both cells before it have been visited
        if i + 1 < len(la) and (j == 0 or reached.get(i + 1, -1) >= j - 1):
            heapq.heappush(heap, (la[i + 1] + lb[j], i + 1, j))
        if j + 1 < len(lb) and (i == 0 or reached.get(i - 1, -1) >= j + 1):
            heapq.heappush(heap, (la[i] + lb[j + 1], i, j + 1))
    return out


class Half:
    """The codebook of a half: each codeword's group, and the radius around it that holds all its members."""

    def __init__(self, book: np.ndarray, groups: int):
        self.book, self.radius = book, np.full(len(book), math.inf)
        _, self.group = np.unique(nearest(book, fit_codebook(book, groups)), return_inverse=True)
        self.groups = int(self.group.max()) + 1
        self.gaps = np.sqrt(distances(book, book))

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row its own group, and for each group a bound below the squared distance to any member."""
        d = distances(x, self.book)
        own = d.argmin(1)
        gap = self.gaps[own]
        plane = np.where(gap > LEAST_GAP, (d - d[np.arange(len(x)), own][:, None]) / np.maximum(2 * gap, LEAST_GAP), 0)
        low = np.maximum(np.maximum(plane, np.sqrt(d) - self.radius) - SLACK, 0) ** 2
        return self.group[own], np.stack([low[:, self.group == g].min(axis=1) for g in range(self.groups)], axis=1)


class MultiIndex:
    """Two codebooks; a region is a pair of groups of codewords."""

    def __init__(self, first: Half, second: Half, width: int, limit: float):
        self.first, self.second, self.width, self.limit = first, second, width, limit

    def halves(self, u: np.ndarray) -> tuple[tuple[Half, np.ndarray], tuple[Half, np.ndarray]]:
        return (self.first, u[:, :self.width]), (self.second, u[:, self.width:])

    def walks(self, u: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """For each vector its region, and the regions that it asks."""
        (a, left), (b, right) = (half.bounds(x) for half, x in self.halves(u))
        home = a * self.second.groups + b
        return home, [[r for r in walk(left[i], right[i], None, self.limit) if _asks(h, r)] for i, h in enumerate(home.tolist())]


def _asks(region: int, other: int) -> bool:
    """Of two regions one asks the other; which one is alternated, to spread the work."""
    return region == other or (region < other) == ((region + other) % 2 == 0)


def _reach(index: MultiIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = [np.full(len(half.book), -1.0) for half in (index.first, index.second)]
        for batch in batches:
            u = _unit(batch.column("raw").to_pylist())
            if len(u):
                for (half, x), most in zip(index.halves(u), far, strict=True):
                    d = np.sqrt(distances(x, half.book))
                    # of codewords as good as equally near, rounding may choose any: each counts the row
                    np.maximum(most, np.where(d <= d.min(1)[:, None] + SLACK, d, -1).max(axis=0), out=most)
        for side, most in enumerate(far):
            met = np.flatnonzero(most >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(met), side), pa.int64()), pa.array(met, pa.int64()), pa.array(most[met], pa.float64())],
                                             names=["side", "word", "far"])

    return run


def build_index(classes: DataFrame, min_cosine: float = MIN_COSINE) -> MultiIndex | None:
    """Codebooks from at most FIT_ROWS classes (c, raw), and the radii of their codewords over all classes."""
    sample = classes.orderBy(F.xxhash64("c")).limit(FIT_ROWS).select("raw").collect()
    if not sample:
        return None
    u = _unit([r["raw"] for r in sample])
    n = classes.count()
    k = max(1, min(len(u), round(math.sqrt(n / PER_CELL))))
    groups = min(k, math.ceil(math.sqrt(n / REGION)))
    half = (u.shape[1] + 1) // 2
    index = MultiIndex(Half(fit_codebook(u[:, :half], k), groups), Half(fit_codebook(u[:, half:], k), groups), half, 2 - 2 * min_cosine + SLACK)
    reach = arrow_map(classes.select("raw"), _reach(index), "side long, word long, far double") \
        .groupBy("side", "word").agg(F.max("far").alias("far")).collect()
    for side in (index.first, index.second):
        side.radius[:] = -math.inf  # a codeword that no row is nearest to has no members
    for r in reach:
        (index.first, index.second)[r["side"]].radius[r["word"]] = r["far"]
    return index


def _file(index: MultiIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home, walks = index.walks(_unit(batch.column("raw").to_pylist())) if batch.num_rows else ([], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("c"), batch.column("n"), batch.column("raw"), pa.array(home, pa.int64()),
                 pa.array(walks, pa.list_(pa.int64()))], names=["c", "n", "raw", "home", "visits"])

    return run


def _join_labels(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of the two sides of a block: a label for each row and each column."""
    rows, cols = np.arange(hit.shape[0]), np.full(hit.shape[1], hit.shape[0])
    while True:
        cols = np.minimum(cols, np.where(hit, rows[:, None], hit.shape[0]).min(axis=0))
        new = np.minimum(rows, np.where(hit, cols[None, :], hit.shape[0]).min(axis=1))
        if (new == rows).all():
            return rows, cols
        rows = new


def _compare(min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, member = None, None
        held: list[tuple] = []

        def members(rows: list[tuple]) -> dict:
            return {"c": np.array([r[0] for r in rows]), "n": np.array([r[1] for r in rows]), "u": _unit([r[2] for r in rows])}

        def block(asking: list[tuple]) -> Iterator[tuple[int, int, int]]:
            if not len(member["c"]):
                return
            c, n = np.array([r[0] for r in asking]), np.array([r[1] for r in asking])
            hit = (_unit([r[2] for r in asking]) @ member["u"].T >= min_cosine) & (c[:, None] != member["c"][None, :])
            p, h = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
            if not len(p):
                return
            hit = hit[np.ix_(p, h)]
            own = hit @ member["n"][h]
            # members of the queries' own region ask for themselves, others are counted here
            away = n[p] * np.array([asking[i][3] != key[0] for i in p])
            back = away @ hit
            rows, cols = _join_labels(hit)
            for i in range(len(p)):
                yield int(c[p[i]]), int(own[i]), int(c[p[rows[i]]])
            for i in range(len(h)):
                yield int(member["c"][h[i]]), int(back[i]), int(c[p[cols[i]]])

        def told(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [[], [], []]
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in cols], names=["c", "links", "other"])

        asking: list[tuple] = []
        out: list[tuple] = []
        for batch in batches:
            for region, chunk, role, *row in zip(*(batch.column(x).to_pylist() for x in ("region", "chunk", "role", "c", "n", "raw", "home")), strict=True):
                if (region, chunk) != key or len(asking) >= BLOCK:
                    if asking:
                        out += block(asking)
                        asking = []
                    if (region, chunk) != key:
                        key, member, held = (region, chunk), None, []
                if role == 0:
                    held.append(tuple(row))
                    continue
                if member is None:
                    member = members(held)
                asking.append(tuple(row))
            if len(out) >= 4096:
                yield told(out)
                out = []
        if asking:
            out += block(asking)
        yield told(out)

    return run


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE,
                    vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id (smallest vec_id reachable), kept."""
    own = F.col(embedding).cast("array<double>")
    dim = max(2, vectors.agg(F.max(F.size(own))).first()[0] or 0)
    rows = cut(arrow_map(vectors.select(F.monotonically_increasing_id().alias("rid"), F.col(vec_id).cast("long").alias("vec_id"), own.alias("v")),
                         _clean(dim), "rid long, vec_id long, raw binary"), "vectors")
    classes = cut(rows.where("raw IS NOT NULL").groupBy("raw").agg(F.min("rid").alias("c"), F.count("*").alias("n")), "vector-classes")
    index = build_index(classes, min_cosine)
    if index is None:
        return rows.select(F.col("vec_id").alias(vec_id), F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    filed = cut(arrow_map(classes, _file(index), "c long, n long, raw binary, home long, visits array<long>"), "filed")
    regions = filed.groupBy(F.col("home").alias("region")).agg(F.ceil(F.count("*") / REGION).cast("int").alias("chunks"))
    whole = ["c", "n", "raw", "home"]
    members = filed.withColumn("region", F.col("home")).join(regions, "region") \
        .select("region", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("role"), *whole)
    asking = filed.withColumn("region", F.explode("visits")).join(regions, "region") \
        .select("region", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("role"), *whole)
    met = cut(arrow_map(members.unionByName(asking).repartition("region", "chunk").sortWithinPartitions("region", "chunk", "role"),
                        _compare(min_cosine), "c long, links long, other long"), "links-met")
    links = met.groupBy("c").agg(F.sum("links").alias("links"))
    joined = components(met.select(F.col("c").alias("a"), F.col("other").alias("b")))
    placed = rows.join(classes.select("raw", "c", "n"), "raw", "left").join(links, "c", "left") \
        .join(joined.withColumnRenamed("node", "c"), "c", "left") \
        .select("rid", "vec_id", F.coalesce("component", "c").alias("component"),
                (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).cast("long").alias("n_links"))
    lowest = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("low"))
    low = F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("low"))
    return placed.join(lowest, "component", "left").select(
        F.col("vec_id").alias(vec_id), "n_links", low.alias("component_id"), F.col("vec_id").eqNullSafe(low).alias("kept"))
