"""Exact Jaccard join on word shingles by a grouped prefix join.

Shingles have one global order, rare ones first.  Two sets alike enough must share a
shingle among the first n - ceil(t n) + 1 of each, so only these prefixes are
indexed.  Documents with one set are one class; classes with the same prefix and
size are one *group*, and groups stand for their members while candidates are
sought: an index of group prefixes, cut by size and by position.  Candidate groups
are expanded into their classes and every pair of classes is verified on whole sets.

What is asked for are classes and the links that join them, so links inside what is
already joined need not be shown.  In each of a few rounds, every part of a group that
is joined so far is held against one other: the hub, the one whose shingles are most
common, of the prefix shingles it shares.  Then all candidates across what is still
apart are verified.  A crowd of near copies thus costs a pair or two each, and no link
between components is lost.

Before texts are sent for, a pair must pass its bit maps: shingles are dealt over about
four bits each, an odd number in a bit sets it, and sets differ in at least as many
shingles as their maps do in bits.

The order needs the frequent shingles only, and any order gives the same result: each
task counts its own shingles, and the most frequent go last.

Shingles are 64-bit hashes of their words; sets are compared as such hashes.

Defined cases: a null, empty or blank text has the empty set, is linked with nothing and
is its own component; a text of fewer words than a shingle is one shingle of all of
them; repeated rows are one class; rows that share a doc_id are kept apart by their
texts; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, cut, may_match
from tidemark.llm.graph import components

WORDS = 5
PERCENT = 80
#: Frequent shingles that the order knows, and how many a task puts forward.
FREQUENT = 400_000
#: Rounds of pairing with hubs before all candidates are taken.
ROUNDS = 2
#: Partners of one class that are verified in one task.
PARTNERS = 500

_rng = np.random.default_rng(5)
_ODD = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, k: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; A-Z lower-cased, words end at ASCII space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = min(k, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64) * _ODD[63]
    for j in range(n):
        out += h[j:len(h) - n + 1 + j] * _ODD[j % 63]
    out ^= out >> np.uint64(31)
    out *= _ODD[62]
    out ^= out >> np.uint64(29)
    return np.unique(out)


def bit_map(own: np.ndarray) -> bytes:
    """Parities of the shingles that fall on each of 4 to 8 bits a shingle."""
    bits = 8 << max(0, int(len(own) - 1).bit_length() - 1)
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """Shingles that two sets differ in at least, by their maps; the larger is folded."""
    x, y = (np.frombuffer(m, np.uint8) for m in (a, b))
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(a, b) for a, b, n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "n_a", "n_b", "sig_a", "sig_b")), strict=True)
                    if (100 + percent) * least_difference(x, y) <= (100 - percent) * (n + m)]
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _frequent(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting = 0

        def counted() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            top = np.argsort(-n, kind="stable")[:FREQUENT]
            top = top[n[top] > 2]
            return pa.RecordBatch.from_arrays([pa.array(keys[top].view(np.int64)), pa.array(n[top].astype(np.int64))], names=["token", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(shingles(text, k))
                waiting += len(held[-1])
                if waiting > 1 << 23:
                    yield counted()
                    held, waiting = [], 0
        if held:
            yield counted()

    return run


def frequent_shingles(docs: DataFrame, k: int = WORDS) -> np.ndarray:
    """At most FREQUENT shingles, sorted, that go last in the order, the most frequent at
    the very end; second row: their place.  Those from a count upwards are taken, the
    count being set by how many shingles have each."""
    counts = cut(arrow_map(docs.select("text"), _frequent(k), "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "frequent")
    least, some = 0, 0
    for r in counts.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.desc("n")).collect():
        some += r["c"]
        if some > FREQUENT:
            break
        least = r["n"]
    if not least:
        return np.zeros((2, 0), np.uint64)
    top = counts.where(F.col("n") >= least).toArrow()
    tokens, n = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()
    place = np.empty(len(tokens), np.uint64)
    place[np.lexsort([tokens, n])] = np.arange(1, len(tokens) + 1, dtype=np.uint64)
    by = np.argsort(tokens)
    return np.stack([tokens[by], place[by]])


def _prefixes(frequent, k: int, percent: int):
    """frequent: the broadcast result of :func:`frequent_shingles`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, places = frequent.value
        for batch in batches:
            ids, ths, cks, sizes, gids, prefixes, ends, sigs = [], [], [], [], [], [], [0], []
            for doc, th, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text")), strict=True):
                own = shingles(text, k)
                n = len(own)
                ids.append(doc)
                ths.append(th)
                sizes.append(n)
                if not n:
                    cks.append(None)
                    gids.append(None)
                    sigs.append(None)
                    ends.append(ends[-1])
                    continue
                last = np.zeros(n, np.uint64)
                if len(tokens):
                    at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
                    last = np.where(tokens[at] == own, places[at], np.uint64(0))
                prefix = own[np.lexsort([own, last])[:prefix_size(n, percent)]]
                sigs.append(bit_map(own))
                cks.append(xxhash.xxh3_128_digest(own.tobytes()))
                gids.append(xxhash.xxh3_64_intdigest(prefix.tobytes(), seed=n) - (1 << 63))
                prefixes.append(prefix)
                ends.append(ends[-1] + len(prefix))
            flat = np.concatenate(prefixes).view(np.int64) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ths, pa.int64()), pa.array(cks, pa.binary()), pa.array(sizes, pa.int32()),
                 pa.array(gids, pa.int64()), pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=["doc_id", "th", "ck", "n", "gid", "sig", "prefix"])

    return run


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whose, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            a_, b_ = [], []
            for a, salt, role, b, text in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "role", "b", "text")), strict=True):
                own = shingles(text, k)
                if role == 0:
                    whose, left = (a, salt), own
                    continue
                assert whose == (a, salt)
                common = len(np.intersect1d(left, own, assume_unique=True))
                if 100 * common >= percent * (len(left) + len(own) - common):
                    a_.append(a)
                    b_.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(a_, pa.int64()), pa.array(b_, pa.int64())], names=["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes whose sets are alike enough, by their texts (class_id, text).

    The partners of one class are dealt over tasks, some hundreds to each, with a copy
    of the class's own text in front.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    left = parts.join(texts, parts["a"] == texts["class_id"]).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("a").alias("b"), "text")
    right = pairs.join(parts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")) \
        .join(texts, F.col("b") == texts["class_id"]).select("a", "salt", F.lit(1).alias("role"), "b", "text")
    return arrow_map(left.unionByName(right).repartition("a", "salt").sortWithinPartitions("a", "salt", "role"),
                     _verify(k, percent), "a long, b long")


def _near(na: str, nb: str, percent: int) -> F.Column:
    """The size filter."""
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb))


def _texts_of(rows: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """One text for each class of the pairs: (class_id, text)."""
    asked = pairs.select(F.col("a").alias("class_id")).unionByName(pairs.select(F.col("b").alias("class_id"))).distinct()
    reps = classes.join(asked, "class_id").select("class_id", "one.doc_id", "one.th")
    return cut(may_match(rows, F.col("th"), reps, F.col("th")).alias("t").join(
        reps.alias("r"), F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.th") == F.col("r.th")))
        .select("r.class_id", "t.text").dropDuplicates(["class_id"]), "texts")


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bit maps do not rule out."""
    side = {x: classes.select(F.col("class_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}")) for x in "ab"}
    full = pairs.join(side["a"], "a").join(side["b"], "b").where(_near("n_a", "n_b", percent))
    return arrow_map(full, _likely(percent), "a long, b long")


def similar_classes(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, links, components) of ``docs`` (doc_id, text):

    documents: doc_id, th (hash of the text), n (set size) and class_id (null for the
    empty set); links: pairs (a, b) of classes, verified, that join every
    class to all it is linked with; components: (node, component) of the linked classes.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, k))
    sets = cut(arrow_map(rows, _prefixes(frequent, k, percent),
                         "doc_id long, th long, ck binary, n int, gid long, sig binary, prefix array<long>"), "prefixes")
    frequent.unpersist()
    known = sets.where(F.col("ck").isNotNull())
    classes = cut(known.groupBy("ck").agg(F.min(F.struct("doc_id", "th")).alias("one"), F.min("n").alias("n"),
                                          F.min("gid").alias("gid"), F.min("sig").alias("sig"))
                  .withColumn("class_id", F.monotonically_increasing_id()), "classes")
    groups = known.groupBy("gid").agg(F.min(F.struct("n", "prefix")).alias("x")) \
        .join(classes.groupBy("gid").agg(F.count("*").alias("members")), "gid").select("gid", "members", "x.n", "x.prefix")
    groups = cut(groups, "groups")

    postings = groups.select("gid", "n", "members", F.posexplode("prefix").alias("pos", "token"))
    shared = cut(postings.groupBy("token").agg(F.sum("members").alias("df")).where("df > 1"), "shared-shingles")
    index = cut(may_match(postings.drop("members"), F.col("token"), shared, F.col("token")).join(shared, "token"), "index")
    common = cut(index.groupBy("gid").agg((F.sum("df") / F.first("n")).alias("common")), "commonness")

    def judged(pairs: DataFrame, name: str) -> DataFrame:
        some = cut(likely(pairs, classes, percent), f"{name}-pairs")
        return cut(verified(some, _texts_of(rows, classes, some), k, percent), f"{name}-links")

    def parts() -> DataFrame:
        """Parts of groups by component: (gid, comp, rep, common)."""
        comps = classes.select("class_id", "gid") if joined is None else \
            classes.select("class_id", "gid").join(joined.withColumnRenamed("node", "class_id"), "class_id", "left")
        comp = F.col("class_id") if joined is None else F.coalesce("component", "class_id")
        return cut(comps.select("gid", "class_id", comp.alias("comp")).groupBy("gid", "comp").agg(F.min("class_id").alias("rep"))
                   .join(common, "gid"), "parts")

    links, joined = None, None
    for _ in range(ROUNDS):
        members = index.select("token", "gid").join(parts(), "gid")
        told = F.struct("common", "comp", "rep")
        best = members.groupBy("token").agg(F.max(told).alias("hub"), (F.min("comp") != F.max("comp")).alias("apart")).where("apart").drop("apart")
        open_ = cut(members.join(best.select("token", F.col("hub.comp").alias("hub_comp"), F.col("hub.rep").alias("hub")), "token"), "open-shingles")
        next_best = open_.where("comp != hub_comp").groupBy("token").agg(F.max(told).alias("x")).select("token", F.col("x.rep").alias("next"))
        other = F.when(F.col("comp") == F.col("hub_comp"), F.col("next")).otherwise(F.col("hub"))
        chosen = open_.join(next_best, "token").groupBy("gid", "comp", "rep", other.alias("other")).agg(F.count("*").alias("c")) \
            .groupBy("gid", "comp", "rep").agg(F.max(F.struct("c", "other")).alias("x"))
        found = judged(chosen.select(F.least("rep", "x.other").alias("a"), F.greatest("rep", "x.other").alias("b")).distinct(), "hub")
        links = found if links is None else links.unionByName(found)
        joined = cut(components(links), "components-so-far")

    # every candidate across components: pairs of parts of groups, expanded into their classes
    where = parts()
    per = index.select("token", "gid", "n", "pos").join(where.select("gid", "comp"), "gid")
    main = per.groupBy("token", "comp").agg(F.count("*").alias("c")).groupBy("token") \
        .agg(F.max(F.struct("c", "comp")).alias("x"), F.count("*").alias("comps")).where("comps > 1").select("token", F.col("x.comp").alias("main"))
    split = cut(per.join(main, "token"), "split-shingles")
    stray = split.where("comp != main").select("token", *(F.col(c).alias(f"{c}_a") for c in ("gid", "comp", "n", "pos")))
    other = split.select("token", "main", *(F.col(c).alias(f"{c}_b") for c in ("gid", "comp", "n", "pos")))
    rest = 1 + F.least(F.col("n_a") - F.col("pos_a") - 1, F.col("n_b") - F.col("pos_b") - 1)
    across = stray.join(other, "token").where(
        (F.col("comp_a") != F.col("comp_b")) & ((F.col("comp_b") == F.col("main")) | (F.col("comp_a") < F.col("comp_b")))
        & _near("n_a", "n_b", percent) & ((100 + percent) * rest >= percent * (F.col("n_a") + F.col("n_b")))) \
        .select("gid_a", "comp_a", "gid_b", "comp_b").distinct()
    placed = classes.select("class_id", "gid").join(joined.withColumnRenamed("node", "class_id"), "class_id", "left") \
        .select("class_id", "gid", F.coalesce("component", "class_id").alias("comp"))
    for x, name in (("a", "x"), ("b", "y")):
        across = across.join(placed.select(F.col("gid").alias(f"gid_{x}"), F.col("comp").alias(f"comp_{x}"), F.col("class_id").alias(name)), [f"gid_{x}", f"comp_{x}"])
    more = judged(across.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "last")
    links = links.unionByName(more)
    placed = sets.select("doc_id", "th", "n", "ck").join(classes.select("ck", "class_id"), "ck", "left").drop("ck")
    return placed, links, cut(components(links), "components")


def similarity_report(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    sets, _, joined = similar_classes(docs, k, percent)
    placed = sets.join(joined.withColumnRenamed("node", "class_id"), "class_id", "left") \
        .withColumn("component", F.coalesce("component", "class_id"))
    lowest = placed.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return placed.join(lowest, "component", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("component").isNull(), F.col("doc_id"))
        .otherwise(F.col("component_id")).alias("component_id"))
