"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, decontam, hashed, jaccard, langid, mixing, neardup, ordinal, sharding, suffixdedup, warc
from tidemark.llm.common import held_out, maybe, may_match

DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def words(rng, n, kinds=400):
    return " ".join(f"w{rng.randrange(kinds)}x" for _ in range(n))


def corpus():
    """Texts with copies, near copies, shared passages, nulls, blanks and one long text."""
    rng = random.Random(7)
    base = [words(rng, rng.randrange(30, 200)) for _ in range(30)]
    passage = words(rng, 90)
    texts = [*base, base[0], base[0], base[1] + " tail", "lead " + base[2], base[3].upper()]
    texts += [f"{base[4]} {passage} {base[5]}", f"{passage} {base[6]}", passage, None, "", "   ", "one", "one two three", "one two three"]
    texts += ["spin " * 700, "long " + words(rng, 6000, 50_000), "Ünï " * 80]
    return [(i, t, "en", "s", 0) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


# --- substrings -----------------------------------------------------------------------------------------------------


def brute_substrings(rows, length):
    seen = Counter()
    for _, text in rows:
        raw = (text or "").encode()
        seen.update(raw[i:i + length] for i in range(len(raw) - length + 1))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_substrings_against_brute_force(spark, docs):
    got = suffixdedup.dedup_report(docs.withColumn("th", F.lit(1)).withColumn("a", F.lit("x")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_substrings([(r[0], r[1]) for r in corpus()], 200)


def test_substrings_rows_that_share_an_id(spark):
    rng = random.Random(1)
    a, b = words(rng, 80), words(rng, 80)
    rows = [(1, a), (1, a), (1, b), (None, b), (None, None), (2, "x" * 150)]
    got = suffixdedup.dedup_report(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_substrings(rows, 200)
    assert suffixdedup.dedup_report(spark.createDataFrame([], "doc_id BIGINT, text STRING")).collect() == []


def test_substrings_crowded_owner_goes_by_windows(spark, monkeypatch):
    monkeypatch.setattr(suffixdedup, "ONE_OWNER", 2)
    rng = random.Random(3)
    passage = words(rng, 60)
    rows = [(i, f"{words(rng, 20)} {passage} {words(rng, 20)}") for i in range(8)]
    got = suffixdedup.dedup_report(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_substrings(rows, 200)


def test_transform_is_the_sorted_suffixes_with_their_common_prefixes():
    rng = random.Random(5)
    texts = [np.array([rng.randrange(3) for _ in range(rng.randrange(1, 40))], dtype=np.uint16) for _ in range(25)]
    bwt, lcp, doc, size = suffixdedup.bwt_lcp(texts)
    suffixes = [tuple(texts[d][len(texts[d]) - n:]) for d, n in zip(doc, size, strict=True)]
    assert suffixes == sorted(suffixes)
    common = [0] + [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(suffixes, suffixes[1:])]
    assert common == lcp.tolist()
    before = [0 if n == len(texts[d]) else texts[d][len(texts[d]) - n - 1] + 1 for d, n in zip(doc, size, strict=True)]
    assert before == bwt.tolist()


def test_pieces_of_a_long_text_match_the_whole(monkeypatch):
    raw = np.frombuffer(words(random.Random(2), 900).encode(), np.uint8)
    lo, n, owner, place = suffixdedup.owners(raw)
    assert n.sum() == len(raw) - 199 and lo[0] == 0 and (lo[1:] == lo[:-1] + n[:-1]).all()
    assert ((place - lo >= n - 1) & (place - lo <= 168)).all()


# --- shingles ---------------------------------------------------------------------------------------------------------


def brute_components(rows, percent=80, k=5):
    def grams(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted((rows[i][0], len(sets[i]), min(rows[j][0] for j in range(len(rows)) if find(j) == find(i))) for i in range(len(rows)))


def test_jaccard_against_brute_force(spark, docs):
    got = jaccard.similarity_report(docs.withColumn("gid", F.lit(1)).withColumn("ck", F.lit("x")))
    assert sorted(tuple(r) for r in got.collect()) == brute_components([(r[0], r[1]) for r in corpus()])


def test_jaccard_chains_of_near_copies(spark):
    rng = random.Random(11)
    rows, text = [], [f"t{rng.randrange(10_000)}" for _ in range(120)]
    for i in range(60):
        rows.append((i, " ".join(text)))
        at = rng.randrange(len(text))
        text = [*text[:at], f"e{i}", *text[at + 1:]]
    for i in range(60, 90):  # many that share most of a text, not all of them alike
        own = list(text)
        for _ in range(rng.randrange(1, 5)):
            own[rng.randrange(len(own))] = f"v{rng.randrange(4)}"
        rows.append((i, " ".join(own)))
    got = jaccard.similarity_report(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"))
    assert sorted(tuple(r) for r in got.collect()) == brute_components(rows)


def test_jaccard_order_of_frequent_shingles_changes_nothing(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "FREQUENT", 1)
    got = jaccard.similarity_report(docs)
    assert sorted(tuple(r) for r in got.collect()) == brute_components([(r[0], r[1]) for r in corpus()])


def test_jaccard_empty(spark):
    assert jaccard.similarity_report(spark.createDataFrame([], "doc_id BIGINT, text STRING")).collect() == []


# --- embeddings -------------------------------------------------------------------------------------------------------


def test_embeddings_against_brute_force(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(12, 16))
    x = [*(c + 0.08 * rng.normal(size=16) for c in centre for _ in range(20)), *rng.normal(size=(200, 16))]
    x = [np.float32(v).tolist() for v in x]
    x += [x[0], x[0], None, [0.0] * 16, [float("nan")] * 16, [None] * 16, [], [1.0, 0.0], [1.0] + [0.0] * 15]
    rows = [(i * 3, v, 1) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in neardup.near_duplicates(
        spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT").withColumn("n", F.lit("clash"))).collect()}
    unit = np.zeros((len(x), 16))
    for i, v in enumerate(x):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            unit[i, :len(v)] = v
            unit[i] /= np.linalg.norm(unit[i])
    hit = unit @ unit.T >= 0.9
    np.fill_diagonal(hit, False)
    assert sum(got[i * 3].n_links for i in range(len(x))) >= 0.9 * hit.sum()
    assert all(got[i * 3].n_links <= hit[i].sum() for i in range(len(x)))
    assert [got[i * 3].n_links for i in range(len(x))] == hit.sum(axis=1).tolist()
    root = list(range(len(x)))
    for _ in range(len(x)):
        new = [min([root[i], *(root[j] for j in np.flatnonzero(hit[i]))]) for i in range(len(x))]
        if new == root:
            break
        root = new
    assert [got[i * 3].component_id for i in range(len(x))] == [3 * r for r in root]
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_embeddings_rare_near_copies(spark, monkeypatch):
    """Few pairs, hardly any in the sample: links must not hang on what the sample finds."""
    monkeypatch.setattr(neardup, "FIT_ROWS", 40)
    monkeypatch.setattr(neardup, "SAMPLE_QUERIES", 2, raising=False)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=(60, 16))
    side -= (side * x[:60]).sum(axis=1, keepdims=True) * x[:60]
    x = np.concatenate([x, x[:60] * 0.92 + side / np.linalg.norm(side, axis=1, keepdims=True) * (1 - 0.92**2) ** 0.5])
    hit = x @ x.T >= 0.9
    got = neardup.near_duplicates(spark.createDataFrame(
        [(i, v) for i, v in enumerate(x.tolist())], "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()
    assert hit.sum() >= len(x) + 120
    assert [r.n_links for r in sorted(got)] == (hit.sum(axis=1) - 1).tolist()


def test_embeddings_walks_of_any_length():
    """Bounds that spare nothing: of any two of 1,600 regions one asks the other."""
    rng = np.random.default_rng(9)
    first, second = neardup.Half(rng.normal(size=(40, 8)), 40), neardup.Half(rng.normal(size=(40, 8)), 40)
    whole = first.groups * second.groups
    home, asked = neardup.MultiIndex(first, second, 8, 1e9).walks(rng.normal(size=(30, 16)))
    assert whole > 1024
    for h, regions in zip(home.tolist(), asked, strict=True):
        assert sorted(regions) == [r for r in range(whole) if neardup._asks(h, r)]
    assert all(neardup._asks(a, b) != neardup._asks(b, a) for a in range(50) for b in range(a))


def test_embeddings_empty_and_all_bad(spark):
    kinds = "vec_id BIGINT, embedding ARRAY<FLOAT>"
    assert neardup.near_duplicates(spark.createDataFrame([], kinds)).collect() == []
    got = neardup.near_duplicates(spark.createDataFrame([(1, None), (2, [0.0, 0.0])], kinds)).collect()
    assert sorted(tuple(r) for r in got) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_traversal_visits_cells_by_distance():
    rng = np.random.default_rng(8)
    left, right = rng.random(7), rng.random(5)
    told = neardup.walk(left, right, 35)
    sums = [left[c // 5] + right[c % 5] for c in told]
    assert len(set(told)) == 35 and sums == sorted(sums)


# --- decontamination --------------------------------------------------------------------------------------------------


def brute_contamination(docs, items, window=13):
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    out = []
    for doc, text in docs:
        w, hit, ids = split(text), set(), set()
        for item, t in items:
            iw = split(t)
            n = min(window, len(iw))
            grams = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if iw else set()
            for p in range(len(w) - n + 1 if iw else 0):
                if tuple(w[p:p + n]) in grams:
                    hit |= set(range(p, p + n))
                    ids |= {str(item)} if item is not None else set()
        told = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(ids), told, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_against_brute_force(spark):
    rng = random.Random(9)
    items = [(i, words(rng, rng.randrange(14, 40), 60)) for i in range(6)]
    items += [(6, "short one"), (7, None), (8, "!!"), (9, "a a a a a a a a a a a a a a a"), (2, items[2][1]), (None, words(rng, 20, 60))]
    texts = [words(rng, 60, 60) for _ in range(6)]
    docs = [(i, f"{t} {it[1] or ''} {t}") for i, (t, it) in enumerate(zip(texts, items, strict=False))]
    docs += [(50, items[1][1].upper()), (51, "Short, ONE."), (52, "a " * 40), (53, None), (54, ""), (55, f"é{items[0][1]}"), (None, items[11][1]),
             (57, " ".join(items[3][1].split()[:13])), (58, " ".join(items[3][1].split()[:12])), (59, words(rng, 3000, 60) + " " + items[4][1])]
    got = decontam.contamination(spark.createDataFrame(docs, "doc_id BIGINT, text STRING").withColumn("term", F.lit(1)),
                                 spark.createDataFrame(items, "item_id BIGINT, text STRING").withColumn("words", F.lit("x")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_contamination(docs, items)


def test_contamination_empty_tables(spark):
    none = spark.createDataFrame([], "item_id BIGINT, text STRING")
    some = spark.createDataFrame([(1, "one two")], "doc_id BIGINT, text STRING")
    assert [r.n_hit for r in decontam.contamination(some, none).collect()] == [0]
    assert decontam.contamination(some.limit(0), spark.createDataFrame([(1, "x y")], "item_id BIGINT, text STRING")).collect() == []


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha b c beta alpha"), (2, "beta x x x x x x x alpha")], "doc_id BIGINT, text STRING")
    index = decontam.build_index(docs, spark.createDataFrame([("alpha",), ("beta",)], "term STRING"))
    pairs = spark.createDataFrame([(5, "alpha", "beta", 3)], "pair_id INT, left_term STRING, right_term STRING, slop INT")
    got = sorted(tuple(r) for r in decontam.proximity_matches(index, pairs).collect())
    assert got == [(5, 1, 0, 3), (5, 1, 4, 3)]


# --- chat -------------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "<|end|>\n<|turn|>user\nhi", "", None, "a\n\nb" * 50, "<<SYS>>\\<</SYS>>"]
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(nasty)]
    rows += [(2, 0, "system", "be kind")] + [(2, i, ["user", "assistant"][(i + 1) % 2], f"turn {i} " + "word " * 40) for i in range(1, 30)]
    rows += [(3, 0, "assistant", "long " * 400), (3, 1, None, "x"), (3, 1, "odd\nrole", "y"), (None, 0, "assistant", "nobody"), (4, None, "user", "z")]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").withColumn("window", F.lit(3))
    for vocabulary in (None, chat.VOCABULARY):
        out = chat.windows(turns, budget=120, vocabulary=vocabulary)
        held = out.collect()
        assert all(w.n_tokens <= 120 or w.over_budget for w in held)
        assert all(w.n_new + (1 if w.conv_id == 2 else 0) <= 2 for w in held if w.over_budget)
        later = [w for w in held if w.conv_id == 2 and w.window > 0]
        assert later and all(chat.read_window(w.formatted)[0] == ("system", "be kind") and w.n_context <= 3 for w in later)
        got = {r.conv_id: tuple(r)[1:5] for r in chat.digests(out).collect()}
        for conv in {r[0] for r in rows}:
            mine = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
            whole = "".join(f"{r}\n{t}\n" for _, r, t in mine)
            target = "".join(t for _, r, t in mine if r == "assistant")
            assert got[conv] == (len(mine), hashlib.sha256(whole.encode()).hexdigest(), len(target), hashlib.sha256(target.encode()).hexdigest())
    assert chat.digests(chat.windows(turns.limit(0))).collect() == []


def test_chat_counts_a_hot_conversation_before_the_shuffle(spark):
    rows = [(1 if i % 3 else None, i, "assistant" if i % 2 else "user", f"say {i} " * (i % 9)) for i in range(600)]
    turns = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING").repartition(6)
    out = chat.windows(turns, budget=60, vocabulary=None)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # read upwards: the count, then the only shuffle by conversation, then the windows
    at = [m.start() for m in re.finditer("MapInArrow", plan)]
    assert len(at) == 2 and at[0] < plan.index("hashpartitioning(conv_id") < at[1]
    held = out.collect()
    assert sum(w.n_new for w in held) == 600 and all(w.n_tokens <= 60 for w in held)
    for w in held:
        assert w.n_tokens == sum(len(t.split()) for _, t in chat.read_window(w.formatted))


# --- language ---------------------------------------------------------------------------------------------------------


def brute_grams(text):
    padded = " " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " "
    return Counter(g for n in (1, 2, 3) for i in range(len(padded) - n + 1) if (g := padded[i:i + n]).strip() and (n > 1 or g != " "))


def test_grams_of_pieces_are_those_of_the_whole(monkeypatch):
    text = "Ab, cd-éf  gh1ij. " * 9
    def told():
        return Counter(int(k) for g in langid.grams(text) for k in g)
    whole = told()
    assert sum(whole.values()) == sum(brute_grams(text).values()) and len(whole) == len(brute_grams(text))
    for piece in (1, 2, 3, 7, 50):
        monkeypatch.setattr(langid, "_PIECE", piece)
        assert told() == whole, piece


def test_language_cases(spark):
    train = [("the cat and the dog and the house", "en"), ("der hund und die katze und das haus", "de"), ("x", None), (None, "fr"), ("123", "es")]
    ask = [(1, "the dog"), (2, "die katze"), (3, None), (4, "12 !!"), (5, ""), (6, "the dog"), (7, "the " * 4000)]
    learn = spark.createDataFrame(train, "text STRING, lang STRING")
    asked = spark.createDataFrame(ask, "doc_id BIGINT, text STRING").withColumn("score", F.lit("clash"))
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(asked, learn).collect()}
    assert [got[i][0] for i in range(1, 8)] == ["en", "de", "und", "und", "und", "en", "en"]
    assert got[1] == got[6] and got[3][1] == 0.0 and all(0 <= s <= 1 for _, s in got.values())
    nothing = {r.lang_pred for r in langid.identify(asked, learn.limit(0)).collect()}
    assert nothing == {"und"}
    assert langid.identify(asked.limit(0), learn).collect() == []


def test_held_out(spark):
    got = spark.createDataFrame([(1,), (10,), (None,)], "doc_id BIGINT").select(held_out(F.col("doc_id"))).collect()
    import zlib
    assert [r[0] for r in got] == [zlib.crc32(b"1") % 5 == 0, zlib.crc32(b"10") % 5 == 0, True]


# --- quality ----------------------------------------------------------------------------------------------------------


def test_ordinal_grades_separate(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(300):
        kind = i % 3
        text = words(rng, 60, 300) + [" idiot scum", " %%% &&& %%%", ""][kind]
        rows.append((i, text))
        labels.append((i, 0 if kind == 1 else 1, 1 if kind == 0 else 0))
    labels += [(None, 1, 0), (5000, 1, 0), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    graded = ordinal.grades(spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT"))
    weights, thresholds = ordinal.fit(docs.where("doc_id < 240"), graded.where("doc_id < 240"))
    assert (np.diff(thresholds) > 0).all()
    asked = docs.unionByName(spark.createDataFrame([(900, None), (901, "")], "doc_id BIGINT, text STRING")).withColumn("place", F.lit("clash"))
    got = {r.doc_id: r for r in ordinal.score(asked, weights, thresholds).collect()}
    unseen = [i for i in range(240, 300)]
    assert sum(got[i].selected == (i % 3 == 2) for i in unseen) >= 55
    means = [np.mean([got[i].expected_grade for i in unseen if i % 3 == k]) for k in range(3)]
    assert means[0] < means[1] < means[2]
    assert got[900].place == got[901].place == 0.0
    w, t = ordinal.fit(docs, graded.limit(0))
    assert not w.any() and np.allclose(ordinal.grade_probabilities(np.zeros(1), t), 1 / 3)


def test_rows_that_share_a_labelled_id_are_one_sample(spark):
    docs = spark.createDataFrame([(1, f"text {i % 7}") for i in range(50)] + [(2, "two"), (3, None)], "doc_id BIGINT, text STRING")
    graded = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "doc_id BIGINT, y STRING")
    y, starts, _, have = hashed.sample_rows(docs, graded, 10, ["a", "b"])
    assert sorted(y.tolist()) == [0, 1, 1] and len(starts) == 4 and have == {"a": 1, "b": 2}


# --- mixing -----------------------------------------------------------------------------------------------------------


def mixing_input(spark):
    rng = random.Random(3)
    kinds = {"a": "alpha apple amber", "b": "beta bread birch"}
    rows = [(i, " ".join(rng.choice(kinds["a" if i % 4 else "b"].split()) for _ in range(rng.randrange(5, 60)))) for i in range(200)]
    rows += [(900, None), (901, "")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("rate", F.lit("clash"))
    labelled = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(100)] + [(5, None), (None, "a")], "doc_id BIGINT, y STRING")
    return docs, labelled


def test_mixing_reaches_targets(spark):
    docs, labelled = mixing_input(spark)
    got = mixing.mix(docs, labelled, {"a": 0.5, "b": 0.5}).collect()
    by = {d: sum(r.rate * r.n_tokens for r in got if r.domain == d) for d in "ab"}
    assert abs(by["a"] / (by["a"] + by["b"]) - 0.5) < 0.02
    assert abs(sum(by.values()) / sum(r.n_tokens for r in got) - 1) < 0.02
    assert all(r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1) for r in got)
    assert [r.copies for r in mixing.mix(docs, labelled, {"a": 0.5, "b": 0.5}).orderBy("doc_id").collect()] == \
        [r.copies for r in sorted(got, key=lambda r: r.doc_id)]


def test_mixing_with_many_domains(spark):
    names = [f"d{k:02}" for k in range(40)]
    rows = [(i, f"word{i % 40} " * 20) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    labelled = spark.createDataFrame([(i, names[i % 40]) for i in range(240)], "doc_id BIGINT, y STRING")
    assert mixing.fit_domains(docs, labelled, rounds=2).domains == names
    with pytest.raises(ValueError, match="nowhere"):
        mixing.mix(docs, labelled, {"d00": 0.5, "nowhere": 0.5})


def test_mixing_with_a_floor_keeps_every_row(spark):
    docs, labelled = mixing_input(spark)
    mixed = mixing.mix(docs, labelled, {"a": 0.4, "b": 0.6}, least=1.0)
    got = mixed.collect()
    assert all(r.rate >= 1 and r.copies >= 1 for r in got)
    by = {d: sum(r.rate * r.n_tokens for r in got if r.domain == d) for d in "ab"}
    assert abs(by["b"] / sum(by.values()) - 0.6) < 0.02
    assert mixing.repeated(mixed, ["doc_id", "text"]).select("doc_id").distinct().count() == len(got)


def test_mixing_without_labels_or_rows(spark):
    docs, labelled = mixing_input(spark)
    assert {r.rate for r in mixing.mix(docs, labelled.limit(0)).collect()} == {1.0}
    assert mixing.mix(docs.limit(0), labelled).collect() == []


# --- sharding ---------------------------------------------------------------------------------------------------------


def test_shards_fit_and_split_only_where_needed(spark):
    rng = random.Random(2)
    rows = [(i, "x" * rng.randrange(0, 300)) for i in range(400)] + [(900, "y" * 5000), (901, None), (None, "z"), (7, None)]
    rows += [(77, "same " * 20)] * 60
    got = sharding.with_shards(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("page", F.lit("clash")), 2000).collect()
    assert len(got) == len(rows)
    size, members = Counter(), Counter()
    for r in got:
        size[r.shard, r.page] += r.n_bytes
        members[r.shard, r.page] += 1
    assert all(b <= 2000 or members[k] == 1 for k, b in size.items())
    names = {s for s, _ in size}
    assert not any(a != b and b.startswith(a) for a in names for b in names)  # a directory: no shard inside another
    for s in names - {""}:
        parent = [r for r in got if r.shard.startswith(s[:-1])]
        assert sum(r.n_bytes for r in parent) > 2000  # the bucket it was split from did not fit
    assert max(p for _, p in size) >= 2


def test_shards_of_little_and_nothing(spark):
    kinds = "doc_id BIGINT, text STRING"
    assert [(r.shard, r.page) for r in sharding.assign_shards(spark.createDataFrame([(1, "a"), (2, None)], kinds)).collect()] == [("", 0), ("", 0)]
    assert sharding.assign_shards(spark.createDataFrame([], kinds)).collect() == []


def test_shards_written(spark, tmp_path):
    rows = [(i, "x" * 100) for i in range(40)]
    sharding.write_shards(spark.createDataFrame(rows, "doc_id BIGINT, text STRING"), str(tmp_path / "out"), 1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40 and all(r.b <= 1000 for r in back.groupBy("folder").agg(F.sum(F.length("text")).alias("b")).collect())


# --- WARC -------------------------------------------------------------------------------------------------------------


def test_audit_finds_exactly_the_damage(spark):
    pages = spark.createDataFrame([(i % 50, f"http://h/{i}", "p" * (i % 700)) for i in range(300)] + [(None, None, None)],
                                  "page_id BIGINT, url STRING, html STRING").withColumn("offset", F.lit("clash"))
    ours = warc.leaves(*warc.archive(pages))
    offsets = [tuple(r) for r in ours.select("file", "offset", "length").orderBy("file", "offset").collect()]
    assert len(offsets) == 301
    assert all(f != g or o + n == p for (f, o, n), (g, p, _) in zip(offsets, offsets[1:], strict=False))
    assert warc.audit(ours, ours, 1024, 4).collect() == []
    bad, gone = offsets[10], offsets[200]
    theirs = ours.where(~((F.col("file") == gone[0]) & (F.col("offset") == gone[1]))).withColumn(
        "hash", F.when((F.col("file") == bad[0]) & (F.col("offset") == bad[1]), "0").otherwise(F.col("hash")))
    expected = sorted([(bad[0], bad[1], "corrupt"), (gone[0], gone[1], "missing")])
    assert sorted(tuple(r) for r in warc.audit(ours, theirs, 1024, 4).collect()) == expected
    assert sorted(r.status for r in warc.audit(theirs, ours, 1024, 4).collect()) == ["added", "corrupt"]
    assert warc.audit(ours.limit(0), theirs.limit(0)).collect() == []


# --- helpers ----------------------------------------------------------------------------------------------------------


def test_bit_map_loses_nothing(spark):
    left, keys = spark.range(0, 5000).toDF("k"), spark.range(0, 5000, 7).toDF("j")
    kept = {r.k for r in may_match(left, F.col("k"), keys, F.col("j")).collect()}
    assert set(range(0, 5000, 7)) <= kept and len(kept) < 1000
    assert maybe(left, F.col("k"), keys.limit(0), F.col("j")).where("_maybe").count() == 0


# --- rows that share an id, vectors of any size, names that clash ------------------------------------------------------


def test_decontamination_tells_rows_of_one_id_apart(spark):
    rng = random.Random(21)
    item, clean = words(rng, 30), " ".join(f"unlike{i}" for i in range(40))
    bench = spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING")
    rows = [(1, item), (1, clean), (None, item), (None, clean), (None, item), (2, None)]
    got = decontam.contamination(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("row", F.lit(1)), bench).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in got) == sorted(
        (d or 0, 0 if t is None else 30 if t == item else 40, 30 if t == item else 0, int(t == item), t == item) for d, t in rows)


def test_vectors_whose_squares_leave_the_range_of_doubles(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1e200]), (3, [1e-200, 1e-200]), (4, [5e-324, 0.0]), (5, [3.0, 0.0]), (6, [-1e308, 1e-308]),
            (7, [0.0, 0.0]), (8, [float("inf"), 1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6), 7: (0, 7), 8: (0, 8)}


def test_mixing_keeps_columns_named_like_working_ones(spark, docs):
    extra = docs.withColumn("_chance", F.lit("c")).withColumn("p", F.lit(2)).withColumn("_text", F.lit("t")).withColumn("a b", F.lit(1))
    labelled = docs.where("text IS NOT NULL").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "x").otherwise("y").alias("y"))
    got = mixing.mix(extra, labelled)
    assert got.columns[:len(extra.columns)] == extra.columns
    assert {tuple(r) for r in got.select("_chance", "p", "_text", "`a b`").collect()} == {("c", 2, "t", 1)}
