"""Ranked lexical search by presence masks.

Documents become the counts of the words that the queries hold.  In a block of documents
each word has a bitmap of the documents that hold it; bit operations split the block by
an item's words, the weightiest first, into sets of documents that hold the same ones of
them.  A set's highest possible score is the sum, over the words it may hold, of the
item's weight times the highest impact that the word has in the block.  Sets wait in a
heap, the highest first: the first one is split by its next word, or, once its mask is
settled or its documents are few, its documents are scored exactly.  A block ends when no
waiting set can reach the item's last kept score, which a task carries from block to block.

A task hands on the best documents of each item among its own rows; these are reduced over
salted groups before one group an item remains.  Scores are 64-bit integers.

Items are searched in groups whose words a broadcast holds (``GROUP_BYTES``); one group is
one pass over the documents.  Impacts need the corpus counts, so a pass writes the words'
counts and a second one, over this smaller table, scores.

Defined cases: null texts have no words; items without words, or whose words no document
holds, return nothing; equal scores go by doc_id, a null one last; rows that share an id
are documents each, and so are repeated rows, whose repeats follow one another in the
ranks; items that share an id are ranked each; an empty table gives no rows; other columns
are not read.  A long text is one row's counts.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import arrow_map, byte_views, cut

TOP = 20
#: Words of a group of items that are broadcast at once, in bytes.
GROUP_BYTES = 16 << 20
#: Documents and word counts that a block holds at most (one document at least); documents scored without further splits.
BLOCK_DOCS, BLOCK_COUNTS, FEW = 32_768, 2_000_000, 48
#: Tasks that share the reduction of one item.
SALTS = 64

#: ASCII letters and digits and all bytes of other letters stay, A-Z lower-cased; the rest parts words.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def words_of(text: memoryview | bytes | None) -> list[bytes]:
    """Maximal runs of UTF-8 bytes that are no ASCII sign, space or control character, A-Z lower-cased."""
    return bytes(text).translate(_FOLD).split() if text is not None else []


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = [Counter(words_of(t)) for t in byte_views(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item"), batch.column("item_id"), pa.array([list(c) for c in counted], pa.list_(pa.binary())),
             pa.array([list(c.values()) for c in counted], pa.list_(pa.int64()))], names=["item", "item_id", "words", "times"])


def item_words(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, words, times) of the items that have words; item is a key of its own."""
    kind = dict(items.dtypes)[item_id]
    keyed = items.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(text).alias("text"))
    return cut(arrow_map(keyed, _item_words, f"item long, item_id {kind}, words array<binary>, times array<long>")
               .where(F.size("words") > 0), "ranked-items")


def _counts(known):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = known.value
        for batch in batches:
            n, sizes, term, tf = [], [0], [], []
            for text in byte_views(batch.column("text")):
                said = words_of(text)
                held = [(terms[w], c) for w, c in Counter(said).items() if w in terms]
                n.append(len(said))
                sizes.append(sizes[-1] + len(held))
                term += [t for t, _ in held]
                tf += [c for _, c in held]
            at = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tf, pa.int32()))], names=["doc_id", "n", "terms", "tfs"])

    return run


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The highest scores of an item so far, equal ones by the smaller id, no id last."""

    def __init__(self, top: int):
        self.top, self.score, self.doc, self.none = top, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """The score that a document must reach."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, doc: np.ndarray, none: np.ndarray) -> None:
        good = score >= self.least()
        score, doc = np.concatenate([self.score, score[good]]), np.concatenate([self.doc, doc[good]])
        none = np.concatenate([self.none, none[good]])
        order = np.lexsort((doc, none, -score))[:self.top]
        self.score, self.doc, self.none = score[order], doc[order], none[order]


class Block:
    """Documents with their impacts by document, and by word a bitmap and the highest impact."""

    def __init__(self, doc: np.ndarray, none: np.ndarray, n: np.ndarray, starts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_docs: int, n_words: int):
        m = 75 + (25 * n * n_docs) // max(1, n_words)
        self.doc, self.none, self.starts = doc, none, starts
        by_doc = np.repeat(np.arange(len(doc)), np.diff(starts))
        impact = (1_000_000_000 * tfs) // (1000 * tfs + 12 * m[by_doc])
        self.terms, self.impact = terms, impact
        order = np.argsort(terms, kind="stable")
        self.words, first = np.unique(terms[order], return_index=True)
        self.most = np.maximum.reduceat(impact[order], first) if len(order) else impact
        self.docs_of = np.split(by_doc[order], first[1:])
        self.maps: dict[int, int] = {}
        self.place = {int(w): i for i, w in enumerate(self.words)}

    def bitmap(self, word: int) -> int:
        """The documents that hold ``word``, one bit each; made when an item first asks for it."""
        if word not in self.maps:
            bits = np.zeros(len(self.doc), np.uint8)
            bits[self.docs_of[self.place[word]]] = 1
            self.maps[word] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        return self.maps[word]

    def members(self, bitmap: int) -> np.ndarray:
        raw = np.frombuffer(bitmap.to_bytes((len(self.doc) + 7) // 8, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(raw, bitorder="little"))

    def scores(self, docs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs``; ``weights`` has the item's weight of every word."""
        lo, size = self.starts[docs], self.starts[docs + 1] - self.starts[docs]
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        parts = np.concatenate([[0], np.cumsum(weights[self.terms[at]] * self.impact[at])])
        ends = np.cumsum(size)
        return parts[ends] - parts[ends - size]

    def search(self, asked: list[int], weights: np.ndarray, best: Best) -> None:
        """Take an item's documents into ``best``: masks by descending highest score."""
        held = [(int(weights[t]) * int(self.most[self.place[t]]), t) for t in asked if t in self.place]
        held = sorted((x for x in held if x[0] > 0), reverse=True)
        left = [0] * (len(held) + 1)  # what the words from the k-th on can add
        for k in range(len(held) - 1, -1, -1):
            left[k] = left[k + 1] + held[k][0]
        everything = (1 << len(self.doc)) - 1
        # (-highest score, order of arrival, words decided, score of the words held, documents)
        heap, arrived = [(-left[0], 0, 0, 0, everything)] if held else [], 0
        while heap and -heap[0][0] >= best.least():
            _, _, k, sure, docs = heapq.heappop(heap)
            if k == len(held) or docs.bit_count() <= FEW:
                found = self.members(docs)
                best.add(self.scores(found, weights), self.doc[found], self.none[found])
                continue
            most, word = held[k]
            inside = docs & self.bitmap(word)
            for part, score in ((inside, sure + most), (docs ^ inside, sure)):
                if part and score + left[k + 1] >= best.least():
                    arrived += 1
                    heapq.heappush(heap, (-(score + left[k + 1]), arrived, k + 1, score, part))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows gathered up to BLOCK_DOCS documents or BLOCK_COUNTS counts: (doc, none, n, starts, terms, tfs)."""
    held: list[tuple] = []
    docs = counts = 0

    def joined() -> tuple[np.ndarray, ...]:
        doc, none, n, sizes, terms, tfs = (np.concatenate(x) for x in zip(*held, strict=True))
        return doc, none, n, np.concatenate([[0], np.cumsum(sizes)]), terms, tfs

    for batch in batches:
        if not batch.num_rows:
            continue
        terms, tfs = batch.column("terms"), batch.column("tfs")
        ids = batch.column("doc_id")
        row = (ids.fill_null(0).to_numpy().copy(), ids.is_null().to_numpy(zero_copy_only=False), batch.column("n").to_numpy().copy(),
               np.diff(terms.offsets.to_numpy()).astype(np.int64), terms.flatten().to_numpy().copy(), tfs.flatten().to_numpy().astype(np.int64))
        if held and (docs + len(row[0]) > BLOCK_DOCS or counts + len(row[4]) > BLOCK_COUNTS):
            yield joined()
            held, docs, counts = [], 0, 0
        held.append(row)
        docs, counts = docs + len(row[0]), counts + len(row[4])
    if held:
        yield joined()


def _search(shared, n_docs: int, n_words: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        bests = [Best(top) for _ in items]
        own = np.zeros(len(weights), np.int64)
        for part in _blocks(batches):
            block = Block(*part, n_docs, n_words)
            for (_, terms, times), best in zip(items, bests, strict=True):
                own[terms] = weights[terms] * times
                block.search(terms.tolist(), own, best)
                own[terms] = 0
        size = [len(b.score) for b in bests]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([i[0] for i in items], np.int64), size)),
             pa.array(np.concatenate([np.zeros(0, np.int64), *(b.doc for b in bests)]), mask=np.concatenate([np.zeros(0, bool), *(b.none for b in bests)])),
             pa.array(np.concatenate([np.zeros(0, np.int64), *(b.score for b in bests)]))], names=["item", "doc_id", "score"])

    return run


def _best(found: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The ``top`` documents (doc_id, text) of each item (item_id, text) by score: item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = item_words(items)
    n_bytes = asked.agg(F.sum(F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + F.octet_length(w) + 64))).first()[0] or 0
    groups = max(1, math.ceil(n_bytes / GROUP_BYTES))
    out = None
    for g in range(groups):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        part = _search_group(docs, mine, top)
        if part is not None:
            out = part if out is None else out.unionByName(part)
    kind = dict(items.dtypes)["item_id"]
    empty = f"item_id {kind}, rank int, doc_id long, score long"
    return out if out is not None else spark.createDataFrame([], empty)


def _search_group(docs: DataFrame, asked: DataFrame, top: int) -> DataFrame | None:
    """One pass for items whose words fit a broadcast."""
    spark = docs.sparkSession
    rows = asked.select("item", "words", "times").collect()
    vocabulary = sorted({bytes(w) for r in rows for w in r["words"]})
    if not vocabulary:
        return None
    number = {w: i for i, w in enumerate(vocabulary)}
    terms = spark.sparkContext.broadcast(number)
    counted = cut(arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), _counts(terms),
                            "doc_id long, n long, terms array<int>, tfs array<int>")
                  .where("n > 0"), "word-counts")
    terms.unpersist()
    n_docs, n_words = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)
    for r in counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
        weights[r["t"]] = weight(n_docs, r["df"])
    items = [(r["item"], np.array([number[bytes(w)] for w in r["words"]], np.int64), np.array(r["times"], np.int64)) for r in rows]
    shared = spark.sparkContext.broadcast((items, weights))
    found = cut(arrow_map(counted.where(F.size("terms") > 0), _search(shared, n_docs, n_words, top), "item long, doc_id long, score long"), "ranked-parts")
    shared.unpersist()
    # a task's best, then the best of salted groups, then of all
    some = _best(found.withColumn("salt", F.monotonically_increasing_id() % SALTS), ["item", "salt"], top).drop("salt", "rank")
    return _best(some, ["item"], top).join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
