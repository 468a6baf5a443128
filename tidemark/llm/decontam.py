"""Benchmark decontamination with a distributed positional inverted index.

The index stores postings (term, document, position) of the terms that a test set
asks for.  A phrase is looked up from its rarest terms: their posting lists,
each shifted by the term's offset in the phrase, are intersected, so an
occurrence shows as one (document, phrase, start) met by every list.  The lists
of the rarest terms leave next to nothing but true occurrences; the words that stand
there, read from those documents only, settle the rest of the phrase exactly.
Everything is DataFrame and SQL expressions.

A word is a maximal run outside ASCII punctuation, space and control characters,
with A-Z lower-cased.  A benchmark item asks for its windows of 13 words; an item
of fewer words is one window.

Defined cases: a null or empty text has no words, and such an item asks for nothing;
ties between equally rare terms go to the first in the item; repeated items count
once by their id; an item without an id marks hits but is not listed; repeated
documents give a row each; rows that share a doc_id, or have none, are judged each by its own
text; a long text is read like any other; empty tables give no rows, or no hits; other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, may_match, small

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
#: Posting lists intersected for a window, rarest first.
LISTS = 3


def words_of(text: Column) -> Column:
    """The words of a text as they stand."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def folded(word: Column) -> Column:
    """``word`` with A-Z lower-cased (other letters stay)."""
    return F.when(F.lower(word) == word, word).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def term_counts(docs: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """(term, n) over all of ``docs`` for the ``terms`` asked for; summed before the shuffle."""
    side, _ = small(terms.select("term"), F.octet_length("term"))
    return docs.select(F.explode(words_of(F.col(text))).alias("_w")).select(folded(F.col("_w")).alias("term")) \
        .join(side, "term").groupBy("term").agg(F.count("*").alias("n"))


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (term, doc_id, pos) of ``terms`` (term), stored in the shared folder."""
    side, _ = small(terms.select("term"), F.octet_length("term"))
    said = docs.select(F.col(doc_id).alias("doc_id"), F.posexplode(words_of(F.col(text))).alias("pos", "_w"))
    return cut(said.select(folded(F.col("_w")).alias("term"), "doc_id", "pos").join(side, "term"), "postings")


def phrase_windows(items: DataFrame, counts: DataFrame, window: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """For each item (item, item_id, words): its windows as (start, n, probes), the
    probes being the places in the item of the window's rarest terms, rarest first.

    A window with a term that the corpus lacks cannot occur and is left out.
    """
    placed = items.select("item", F.posexplode("words").alias("ipos", "term")).join(counts, "term", "left") \
        .groupBy("item").agg(F.array_sort(F.collect_list(F.struct("ipos", F.coalesce("n", F.lit(0)).alias("n")))).alias("seq"))
    n = F.least(F.lit(window), F.size("words"))

    def one(start: Column) -> Column:
        part = F.transform(F.slice("seq", start + 1, n), lambda x: F.struct(x["n"].alias("n"), x["ipos"].alias("ipos")))
        return F.struct(start.alias("start"), n.alias("n"), F.slice(F.array_sort(part), 1, lists).alias("probes"))

    windows = F.transform(F.sequence(F.lit(0), F.size("words") - n), one)
    return items.join(placed, "item").select(
        "item", "item_id", "words", F.filter(windows, lambda w: w["probes"][0]["n"] > 0).alias("windows")) \
        .where(F.size("windows") > 0)


def phrase_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """Every occurrence of every item window: (doc_id, item, item_id, start, n), where
    ``start`` is the place of its first word in the document.

    ``items`` has item (a key of its own), item_id and words (folded, at least one).
    """
    vocabulary = items.select(F.explode("words").alias("term")).distinct()
    counts = cut(term_counts(docs, vocabulary), "term-counts")
    asked = cut(phrase_windows(items, counts, window, lists), "phrase-windows")
    probes = cut(asked.select("item", "words", F.explode(F.array_distinct(F.flatten(F.transform(
        "windows", lambda w: F.transform(w["probes"], lambda p: p["ipos"]))))).alias("ipos"))
        .select("item", "ipos", F.element_at("words", F.col("ipos") + 1).alias("term")), "probes")
    index = build_index(docs, probes.select("term").distinct())
    side, _ = small(probes, F.octet_length("term"))
    met = index.join(side, "term").groupBy("doc_id", "item", (F.col("pos") - F.col("ipos")).alias("at")) \
        .agg(F.collect_set("ipos").alias("places"))
    by_item, _ = small(asked, F.octet_length(F.to_json(F.struct("words", "windows"))))
    fewest = F.array_min(F.transform("windows", lambda w: F.size(w["probes"])))
    inside = F.filter("windows", lambda w: (F.col("at") + w["start"] >= 0)
                      & F.forall(w["probes"], lambda p: F.array_contains("places", p["ipos"])))
    likely = cut(met.join(by_item, "item").where(F.size("places") >= fewest)
                 .select("doc_id", "item", "at", F.explode(inside).alias("w"))
                 .select("doc_id", F.struct("item", (F.col("at") + F.col("w.start")).alias("start"), F.col("w.start").alias("first"),
                                            F.col("w.n").alias("n")).alias("x"))
                 .groupBy("doc_id").agg(F.collect_set("x").alias("asked")), "likely")
    # the words that stand there settle the terms whose lists were not read
    read = may_match(docs.select("doc_id", "text"), F.col("doc_id"), likely, F.col("doc_id")).alias("d").join(
        likely.alias("k"), F.col("d.doc_id").eqNullSafe(F.col("k.doc_id"))) \
        .select("d.doc_id", "asked", words_of(F.col("text")).alias("_ws"))
    there = F.transform("asked", lambda x: F.struct(
        x["item"].alias("item"), x["start"].alias("start"), x["first"].alias("first"), x["n"].alias("n"),
        F.transform(F.slice("_ws", x["start"] + 1, x["n"]), folded).alias("said")))
    return read.select("doc_id", F.explode(there).alias("x")).select("doc_id", "x.*").join(by_item, "item") \
        .where(F.col("said") == F.slice("words", F.col("first") + 1, F.col("n"))) \
        .select("doc_id", "item", "item_id", "start", "n").distinct()


def proximity_matches(index: DataFrame, pairs: DataFrame) -> DataFrame:
    """Places where two terms stand at most ``slop`` words apart, in either order:
    (pair_id, doc_id, left_pos, right_pos) for ``pairs`` (pair_id, left_term,
    right_term, slop > 0), from postings of :func:`build_index`.

    The lists meet in blocks of ``slop`` positions, each with its neighbours, so a
    long document is never paired with itself as a whole.
    """
    def side(name: str) -> DataFrame:
        return index.select("term", "doc_id", "pos").join(
            pairs.select("pair_id", F.col(f"{name}_term").alias("term"), "slop"), "term")

    block = F.floor(F.col("pos") / F.col("slop"))
    left = side("left").select("pair_id", "doc_id", "slop", F.col("pos").alias("left_pos"), block.alias("block"))
    right = side("right").select("pair_id", "doc_id", F.col("pos").alias("right_pos"),
                                 F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    apart = F.abs(F.col("left_pos") - F.col("right_pos"))
    return left.join(right, ["pair_id", "doc_id", "block"]).where((apart > 0) & (apart <= F.col("slop"))) \
        .select("pair_id", "doc_id", "left_pos", "right_pos")


def item_words(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words) of the items that have words; item is a key of its own."""
    return cut(benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("string").alias("item_id"),
        F.transform(words_of(F.col("text")), folded).alias("words")).where(F.size("words") > 0), "benchmark-items")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, lists: int = LISTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside any occurrence of a
    window), n_items and items_sha256 (of the sorted ids of items that occur, comma
    between them), contaminated (at least a twentieth of the words are hit)."""
    # 128 bits of id and text tell rows apart; rows equal in both have equal hits
    keyed = docs.select(F.struct(F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", "doc_id").alias("b")).alias("row"), "doc_id", "text")
    hits = phrase_matches(keyed.select(F.col("row").alias("doc_id"), "text"), item_words(benchmark), window, lists)
    per_doc = hits.select("doc_id", "item_id", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("pos")) \
        .groupBy("doc_id").agg(F.countDistinct("pos").alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("_items"))
    sized = keyed.select("row", "doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    items = F.coalesce(F.col("_items"), F.array().cast("array<string>"))
    hit = F.coalesce(F.col("n_hit"), F.lit(0).cast("long"))
    return sized.join(per_doc.withColumnRenamed("doc_id", "row"), "row", "left").select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"),
        ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"))
