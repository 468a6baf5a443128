"""Piece tables, M-tree search and presence masks: brute force, round trips and odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import fim, ranked, topk
from tidemark.llm.common import slices

# --- fill in the middle -----------------------------------------------------------------------------------------------


def brute_fim(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    a, b, c = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return (doc_id, len(units), "plain", None, None, sha(text), sha(text))
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{c}<P>{a}<M>{b}" if form == "spm" else f"<P>{a}<S>{c}<M>{b}"
    return (doc_id, len(units), form, len(a), len(b), sha(out), sha(text))


def odd_texts():
    rng = random.Random(4)
    lines = ["zażółć", "", "x" * 50, "日本語 text", "𝔘𝔫𝔦", "<P", "P>", "a\rb", "tab\t", "\x00nul"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 12))) + rng.choice(["", "\n"]) for _ in range(120)]
    return [*texts, None, "", "\n", "\n\n\n", "no break", "has <P> in it", "<M>\n", "<S", "long line\n" * 20_000, "one" * 50_000]


def test_fim_against_brute_force_and_round_trip(spark):
    rows = list(enumerate(odd_texts())) + [(None, "a\nb\nc\n"), (None, None), (3, "other\ntext"), (3, "other\ntext"), (-5, "minus\nid\n")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("output", F.lit("x")).withColumn("form", F.lit(1)).withColumn("n", F.lit("n"))
    moved = fim.transform(docs)
    got = fim.restore(moved)
    assert Counter((r.doc_id, r.restored) for r in got.collect()) == Counter((i, t or "") for i, t in rows)
    short = fim.restore(moved, texts=False).collect()
    assert sorted((tuple(r) for r in short), key=str) == sorted((brute_fim(*r) for r in rows), key=str)
    assert {r.form for r in short} == {"plain", "psm", "spm"}
    assert fim.restore(fim.transform(docs.limit(0))).collect() == []


def test_fim_descriptors_cover_the_output():
    text = memoryview(b"first\nsecond\nthird")
    pieces = fim.cut_at(fim.cut_at([(fim.TEXT, 0, 18)], 6), 13)
    assert pieces == [(0, 0, 6), (0, 6, 7), (0, 13, 5)]
    parts = fim.split([(fim.TEXT, 0, 18)], 6, 13)
    out = b"".join(fim.stream(fim.arrange(parts, "spm"), text))
    assert out == b"<S>third<P>first\n<M>second\n"
    assert b"".join(fim.stream(fim.undo(memoryview(out), "spm"), memoryview(out))) == bytes(text)
    assert fim.split([(fim.TEXT, 0, 18)], 0, 18) == [[], [(0, 0, 18)], []]


def test_fim_rates(spark):
    docs = spark.createDataFrame([(i, f"{i}\nb\n") for i in range(400)], "doc_id BIGINT, text STRING")
    forms = Counter(r.form for r in fim.transform(docs, seed=1, rate=30, spm_rate=0).collect())
    assert forms["spm"] == 0 and 60 < forms["psm"] < 180


# --- top k ------------------------------------------------------------------------------------------------------------


def brute_topk(rows, asks, top=5):
    def scaled(v):
        if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in v):
            return None
        return [math.floor(256 * x) for x in v]

    known = [(i, s, scaled(v)) for i, (s, v) in enumerate(rows)]
    known = [r for r in known if r[2] is not None]
    out = []
    for i, q, a in known:
        if asks(q):
            found = sorted((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), s is None, s or 0) for j, s, b in known if j != i)[:top]
            out += [(q, k + 1, None if none else s, -score) for k, (score, none, s) in enumerate(found)]
    return sorted(out, key=str)


def searched(spark, rows, every=7):
    got = topk.search(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("page", F.lit("x")).withColumn("raw", F.lit(1)),
                      F.col("vec_id") % every == 0)
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_topk_against_brute_force(spark, monkeypatch):
    for name, value in {"PAGE": 64, "NODE": 8, "BLOCK": 5, "VISITS": 2, "RINGS": 4}.items():
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 6))
    x = centres[rng.integers(0, 12, 600)] + rng.normal(size=(600, 6)) / 8
    rows = [(i, (v * rng.choice([0.2, 1, 3])).tolist()) for i, v in enumerate(x)]
    rows += [(i, rows[0][1]) for i in range(600, 900)]  # a third is one vector: a ring beyond its page, and ties
    assert searched(spark, rows) == brute_topk(rows, lambda q: q % 7 == 0)


def test_topk_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (7, None), (14, []), (21, [0.0, 0.0]), (28, [float("nan"), 1.0]), (35, [None, 1.0]), (42, [float("inf"), 1.0]),
            (1, [1.0]), (2, [-1.0, -2.0]), (None, [1.0, 2.0]), (0, [1.0, 2.0]), (0, [1.0, 2.0]), (49, [1e-3, -1e-3]), (56, [1e308, 0.0])]
    asks = lambda q: q is not None and q % 7 == 0
    assert searched(spark, rows) == brute_topk(rows, asks)
    huge = [*rows, (63, [1e200, -3.0]), (70, [2.0**40, 1.0]), (77, [2.0**-1074, 5.0])]
    assert searched(spark, huge) == brute_topk(huge, asks)
    assert searched(spark, [(0, [1.0])]) == [] and searched(spark, []) == []
    assert searched(spark, [(0, [1.0]), (1, [2.0])]) == [(0, 1, 1, 131072)]


def test_topk_spares_comparisons_of_far_nodes():
    rng = np.random.default_rng(3)
    x = np.floor(256 * (rng.normal(size=(20, 8))[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) / 50))
    space = topk.Space(8, float(np.sqrt((x * x).sum(1)).max()))
    page = topk.Page(space, np.arange(4000), list(range(4000)), x)
    best = topk.Best(space, 5, None)
    page.search(0, x[0], space.queries(x[:1])[0], best)
    right = sorted((-int(s), i) for i, s in enumerate(x @ x[0]) if i)[:5]
    assert [(s, v) for s, _, v, _ in best.rows] == right and page.computed < 2000


# --- ranked search ----------------------------------------------------------------------------------------------------


def brute_ranked(docs, items, top=20):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    said = [(d, Counter(words(t)), len(words(t))) for d, t in docs if words(t)]
    n_docs, n_words = len(said), sum(n for _, _, n in said)
    df = Counter(w for _, c, _ in said for w in c)
    out = []
    for item, text in items:
        asked, found = Counter(words(text)), []
        for d, c, n in said:
            m = 75 + (25 * n * n_docs) // n_words
            score = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 12 * m))
                        for w, q in asked.items() if w in c)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def rank_of(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").withColumn("n", F.lit("x")).withColumn("terms", F.lit(1))
    i = spark.createDataFrame(items, "item_id STRING, text STRING").withColumn("item", F.lit("x")).withColumn("words", F.lit(1))
    return sorted((tuple(r) for r in ranked.search(d, i, **more).collect()), key=str)


def test_ranked_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", 64)
    monkeypatch.setattr(ranked, "FEW", 3)
    rng = random.Random(6)
    kinds = [f"W{int(300 * rng.random() ** 3)}" for _ in range(4000)]

    def text(n):
        return " ".join(rng.choice(kinds) for _ in range(n))

    docs = [(i, text(rng.randrange(1, 120))) for i in range(500)]
    docs += [(i, docs[3][1]) for i in range(500, 560)]  # copies: ties by id
    docs += [(None, docs[3][1]), (3, docs[3][1]), (700, None), (701, ""), (702, "!!"), (703, "spin " * 30_000), (704, "Ünï w1 É"), (705, "unÏ x")]
    items = [("a", text(30)), ("b", docs[3][1]), ("c", "w1 W1 w2"), ("d", None), ("e", ""), ("f", "absent"), ("g", "spin ünï É"), ("c", text(5)), (None, text(9))]
    want = brute_ranked(docs, items)
    assert rank_of(spark, docs, items) == want
    monkeypatch.setattr(ranked, "GROUP_BYTES", 2000)
    assert rank_of(spark, docs, items) == want
    assert rank_of(spark, docs, [], top=3) == [] and rank_of(spark, [], items) == []
    assert rank_of(spark, docs, items, top=1) == brute_ranked(docs, items, 1)


def test_masks_that_cannot_reach_the_last_answer_are_not_split():
    n = 4096
    sizes = np.full(n, 2)
    rare = np.where(np.arange(n) < 40, 1, 2)
    terms = np.stack([np.zeros(n, np.int32), rare], axis=1).ravel()
    block = ranked.Block(np.arange(n), np.zeros(n, bool), np.full(n, 50), np.concatenate([[0], np.cumsum(sizes)]), terms, np.ones(2 * n, np.int64), n, 50 * n)
    scored, exact = [], block.scores
    block.scores = lambda docs, weights: scored.append(len(docs)) or exact(docs, weights)
    best = ranked.Best(20)
    block.search([0, 1, 2], np.array([3, 4000, 2]), best)
    assert best.doc.tolist() == list(range(20)) and sum(scored) == 40


def test_slices_are_views_of_bounded_size():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 1000] * 500), pa.array(range(500))], names=["t", "i"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), 50_000))
    assert sum(p.num_rows for p in parts) == 500 and max(p.nbytes for p in parts) < 60_000 and parts[-1].num_rows == 0
