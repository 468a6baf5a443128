"""Fitted models against direct solutions: cumulative-link likelihood, nonnegative least squares of rates, whole pipeline stages."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import hashed, mixing, ordinal, sharding

GRADED = {0: "vile awful the a", 1: "dull poor the a", 2: "fine clear the a"}


def graded_texts(n=240, seed=8):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        y = rng.choice([0, 1, 2, 2])
        said = GRADED[y if rng.random() < 0.85 else rng.randrange(3)].split()
        out.append((i, " ".join(rng.choice(said) for _ in range(rng.randrange(2, 9))), y))
    return out


def test_quality_is_the_direct_likelihood_fit(spark):
    rows = graded_texts()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id BIGINT, y INT")
    weights, cuts = ordinal.fit(docs, labels, rounds=1500)

    # the same likelihood, stated document by document, and climbed with numeric slopes
    said = [set(hashed.features(t)[0].tolist()) for _, t, _ in rows]
    words = sorted(set().union(*said))
    y = np.array([r[2] for r in rows])
    has = np.array([[w in s for w in words] for s in said], float)
    strength = np.zeros(len(words))
    for k in (1, 2):
        above = (y >= k).astype(float)
        n = has.sum(0)
        strength = np.maximum(strength, np.abs((has * above[:, None]).sum(0) / n - above.mean()) * np.sqrt(n) / above.std())
    strength = np.clip((strength - 3) / 3, 0, 1)

    def loss(x):
        place, edge = has @ (strength * x[2:]), [x[0], x[0] + np.exp(x[1])]
        total = 0.0
        for p, grade in zip(place, y, strict=True):
            hi = 1 / (1 + np.exp(-(edge[grade] - p))) if grade < 2 else 1.0
            lo = 1 / (1 + np.exp(-(edge[grade - 1] - p))) if grade else 0.0
            total -= np.log(hi - lo)
        return total / len(y) + 1e-4 / 2 * (x[2:] ** 2).sum()

    def slope(x):
        step = 1e-5 * np.eye(len(x))
        return np.array([(loss(x + e) - loss(x - e)) / 2e-5 for e in step])

    at = np.array([w in set(words) for w in range(len(weights))])
    assert not weights[~at].any()
    found = np.concatenate([[cuts[0], np.log(cuts[1] - cuts[0])], np.divide(weights[words], strength, out=np.zeros(len(words)), where=strength > 0)])
    best, rate = found.copy(), 4.0
    for _ in range(25):
        move = best - rate * slope(best)
        if loss(move) < loss(best):
            best = move
        else:
            rate /= 3
    assert cuts[0] < cuts[1] and np.abs(slope(found)).max() < 2e-3 and loss(found) - loss(best) < 1e-4
    scored = ordinal.score(docs, weights, cuts).collect()
    p = ordinal.grade_probabilities(has @ weights[words], cuts)
    assert np.allclose([r.expected_grade for r in sorted(scored, key=lambda r: r.doc_id)], p @ [0, 1, 2], atol=1e-5)


def direct_rates(p, t, goal, weight, least, pull):
    """The least of sum_k weight_k (sum_i r_i t_i p_ik - goal_k)^2 + pull sum_i t_i (r_i - 1)^2, one rate at a time."""
    r = np.full(len(p), max(1.0, least))
    now = (r * t) @ p
    for _ in range(4000):
        for i in range(len(p)):
            if t[i]:
                a = t[i] * (p[i] ** 2 * weight).sum() + pull
                b = (p[i] * weight * (now - r[i] * t[i] * p[i] - goal)).sum() - pull
                new = max(least, -b / a)
                now += (new - r[i]) * t[i] * p[i]
                r[i] = new
    return r


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_rates_are_the_least_squares(spark, least):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.4] * 3, 30) * [1, 1, 1]
    t = rng.integers(1, 60, 30)
    stored = spark.createDataFrame([(x.tolist(), int(n)) for x, n in zip(p, t, strict=True)], "p ARRAY<DOUBLE>, n_tokens BIGINT")
    targets = np.array([0.2, 0.2, 0.6])
    history, goal, _ = mixing.fit_rates(stored, 3, targets, least, rounds=400)
    now = t @ p
    share, whole = now / now.sum(), now.sum()
    size = max(1.0, least * (share / targets).max()) * whole
    assert np.allclose(goal, targets * size)
    want = direct_rates(p, t.astype(float), targets * size, 1 / share / whole, least, mixing.PULL)
    got = mixing.rates(p, history, least)

    def cost(r):
        return (((r * t) @ p - targets * size) ** 2 / share / whole).sum() / 2 + mixing.PULL / 2 * (t * (r - 1) ** 2).sum()

    # rates that weigh on the totals alike may differ; what they cost and reach may not
    assert (got >= least).all() and cost(got) - cost(want) < 1e-3 * cost(np.full(30, max(1.0, least)))
    assert np.allclose((got * t) @ p, (want * t) @ p, rtol=0.02)


def test_two_thousand_domains_stay_within_the_classifiers_bound(spark):
    k = 2000
    docs = spark.range(2 * k).selectExpr("id AS doc_id", f"concat('word', id % {k}, ' sign', id % 37) AS text")
    labelled = docs.selectExpr("doc_id", f"format_string('d%04d', doc_id % {k}) AS y")
    tracemalloc.start()
    model = mixing.fit_domains(docs, labelled, rounds=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.domains) == k and model.weights.size <= mixing.CELLS and model.weights.nbytes <= 16 << 20
    assert peak < 16 * 8 * mixing.CELLS
    p, n = model.posteriors(["word7 sign7", "word9 sign9", None])
    assert p.shape == (3, k) and np.allclose(p.sum(axis=1), 1) and list(n) == [4, 4, 0]


def test_blocks_of_rows_fit_the_same_classifier(spark, monkeypatch):
    rows = graded_texts()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id BIGINT, text STRING")
    labelled = spark.createDataFrame([(i, f"d{y}") for i, _, y in rows], "doc_id BIGINT, y STRING")
    whole = mixing.fit_domains(docs, labelled, bits=8)
    monkeypatch.setattr(mixing, "CELLS", 3 << 8)
    blocks = mixing.fit_domains(docs, labelled, bits=8)
    texts = [r[1] for r in rows]
    assert blocks.weights.shape == whole.weights.shape and np.allclose(whole.posteriors(texts)[0], blocks.posteriors(texts)[0], atol=1e-4)


def test_rates_of_many_domains_as_an_expression(spark):
    rng = np.random.default_rng(5)
    p, history = rng.dirichlet([0.1] * 500, 20), [rng.normal(size=500) for _ in range(40)]
    stored = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(p)], "i INT, p ARRAY<DOUBLE>")
    got = [r.r for r in stored.select("i", mixing.rate_of(F.col("p"), history, 0.0).alias("r")).orderBy("i").collect()]
    assert np.allclose(got, mixing.rates(p, history, 0.0))


def test_fitting_rows_are_the_lowest_hashes_of_each_class(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('w', id) AS text")
    graded = docs.selectExpr("doc_id", "CASE WHEN doc_id % 100 = 0 THEN 'few' ELSE 'many' END AS y").unionByName(
        spark.createDataFrame([(1, None)], "doc_id BIGINT, y STRING"))
    y, starts, flat, have = hashed.sample_rows(docs, graded, 40, ["few", "many"])
    assert have == {"few": 30, "many": 2970} and np.bincount(y).tolist() == [30, 40]
    rows = {(int(c), flat[a:b].tobytes()) for c, a, b in zip(y, starts[:-1], starts[1:], strict=True)}
    low = graded.where("y = 'many'").orderBy(F.xxhash64("doc_id")).limit(40).collect()
    want = {(1, hashed.features(f"w{r.doc_id}")[0].astype(np.int32).tobytes()) for r in low}
    assert {r for r in rows if r[0] == 1} == want


def corpus(spark):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        lang = "en" if i % 4 else "de"
        said = {"en": "the cat and a dog", "de": "der hund und die katze"}[lang].split()
        rows.append((i, " ".join(rng.choice(said) for _ in range(rng.randrange(3, 40))), lang, "s", 0))
    rows += [(200, None, "en", "s", 0), (201, "", "de", "s", 0), (5, "the the", "en", "s", 0), (5, "the the", "en", "s", 0)]
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT")


def test_pipeline_mix_repeats_rows_by_their_direct_rates(spark, tmp_root):
    docs = corpus(spark)
    spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 2)], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_root}/labels.parquet")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.mix(spark, docs, tmp_root).collect())
    labelled = docs.where("doc_id % 2 = 0 AND doc_id < 120").select("doc_id", F.col("lang").alias("y"))
    model = mixing.fit_domains(docs.select("doc_id", "text"), labelled)
    rows = docs.select("doc_id", "text", (F.pmod(F.xxhash64("doc_id", "text", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)).alias("chance")).collect()
    p, t = model.posteriors([r.text for r in rows])
    now = t @ p
    share, whole = now / now.sum(), now.sum()
    goal = np.sqrt(share) / np.sqrt(share).sum()
    size = max(1.0, (share / goal).max()) * whole
    rates = direct_rates(p, t.astype(float), goal * size, 1 / share / whole, 1.0, mixing.PULL)
    # a row whose rate is within the fit's tolerance of its chance may go either way, and a row without tokens any
    want, loose = Counter(), set()
    for r, rate, n in zip(rows, rates, t, strict=True):
        want[r.doc_id, r.text] += int(rate) + int(r.chance < rate - int(rate))
        if abs(r.chance - (rate - int(rate))) < 0.1 or not n:
            loose.add((r.doc_id, r.text))
    assert {k: v for k, v in got.items() if k not in loose} == {k: v for k, v in want.items() if k not in loose} and len(loose) < 50
    assert set(got) == set(want)


def test_pipeline_shards_hold_what_their_prefix_says(spark, monkeypatch):
    docs = corpus(spark)
    monkeypatch.setattr(sharding, "SHARD_BYTES", 500)
    rows = sharding.with_shards(docs, limit=500).withColumn("k", sharding.hash_key(F.col("doc_id"), F.col("text"))).collect()
    bits = {(r.doc_id, r.text): format(r.k, f"0{sharding.KEY_BITS}b") for r in rows}
    # extendible hashing by hand: a bucket over the limit splits on its next bit
    todo, want = [("", list(rows))], {}
    while todo:
        prefix, held = todo.pop()
        size = sum(len((r.text or "").encode()) for r in held)
        if size <= 500 or len({r.k for r in held}) == 1:
            for r in held:
                want[r.doc_id, r.text] = (prefix, size, len(held))
        else:
            for bit in "01":
                part = [r for r in held if bits[r.doc_id, r.text].startswith(prefix + bit)]
                if part:
                    todo.append((prefix + bit, part))
    assert {(r.doc_id, r.text): (r.shard, r.shard_bytes, r.shard_docs) for r in rows} == want and len({v[0] for v in want.values()}) > 4
    assert corpus_pipeline.shard(spark, docs, "").count() == docs.count()
