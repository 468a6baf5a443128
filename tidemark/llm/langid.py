"""Language identification by rank-order profiles (out-of-place distance).

A profile is the list of a language's most frequent letter n-grams, most
frequent first.  A document is ranked the same way, and for each language the
places by which its n-grams are out of order are summed; an n-gram missing
from the profile counts the whole profile length.  The smallest sum wins.

Letters are taken after lower-casing; everything else is a word boundary, which
takes part in 2- and 3-grams.  Whole texts are read, in pieces that overlap so that
no n-gram is lost, so memory does not follow the longest document.

Defined cases: null texts and texts without a letter are ``und`` with score 0, as is
everything where nothing could be learned; ties between n-grams go to the smaller
n-gram, ties between languages to the smaller name; repeated rows are learned from
and answered as often as they come; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, cut

#: n-grams in a profile.
PROFILE = 300
UNKNOWN = "und"
_PIECE = 1 << 20
_FLUSH = 1 << 20
#: Stands for a word boundary in n-grams, after every code point.
_GAP = np.uint64(0x110000)
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> itself if it is a letter, else 0; built once per worker."""
    if not _LETTERS:
        _LETTERS.append(np.array([c if chr(c).isalpha() else 0 for c in range(0x110000)], dtype=np.uint32))
    return _LETTERS[0]


def _pieces(text: str) -> Iterator[np.ndarray]:
    """The letters of a text with one 0 between words, at both ends too; a piece
    starts with the last two places of the one before."""
    keep, tail = _letters(), np.zeros(1, dtype=np.uint64)
    for at in range(0, len(text), _PIECE):
        last = at + _PIECE >= len(text)
        part = text[at:at + _PIECE].lower() + (" " if last else "")
        codes = keep[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.uint64)
        codes = np.concatenate([tail, codes])
        gap = codes == 0
        new = ~(gap[1:] & gap[:-1])
        new[:len(tail) - 1] = True
        codes = codes[np.concatenate([[True], new])]
        yield codes
        tail = codes[-2:]


def grams(text: str) -> Iterator[np.ndarray]:
    """Keys of the 1-, 2- and 3-grams, in pieces; 21 bits a letter."""
    seen = 1
    for piece in _pieces(text):
        codes = np.where(piece == 0, _GAP, piece)
        one, two = codes[seen:], (codes[:-1] << np.uint64(21)) | codes[1:]
        three = (two[:-1] << np.uint64(21)) | codes[2:]
        yield np.concatenate([one[one != _GAP], two[seen - 1:], three[max(0, seen - 2):]])
        seen = min(2, len(codes))


def _counts(parts: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    if counts is None:
        return np.unique(keys, return_counts=True)
    uniq, place = np.unique(keys, return_inverse=True)
    return uniq, np.bincount(place, weights=np.concatenate(counts), minlength=len(uniq)).astype(np.int64)


def ranked(text: str, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams of a whole text, most frequent first."""
    parts = [_counts([g]) for g in grams(text)]
    keys, counts = parts[0] if len(parts) == 1 else _counts([p[0] for p in parts], [p[1] for p in parts])
    return keys[np.argsort(-counts, kind="stable")[:size]]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each language's n-grams in this task; held below a bound, then sent on."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    buffers: dict[str, list[np.ndarray]] = {}
    waiting: dict[str, int] = {}

    def merge(lang: str) -> None:
        keys, counts = _counts(buffers.pop(lang))
        waiting[lang] = 0
        if lang in totals:
            keys, counts = _counts([totals[lang][0], keys], [totals[lang][1], counts])
        totals[lang] = (keys, counts)

    def rows() -> Iterator[pa.RecordBatch]:
        for lang in list(buffers):
            merge(lang)
        for lang, (keys, counts) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(counts.astype(np.int64))],
                names=["lang", "gram", "n"])
        totals.clear()

    for batch in batches:
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            for g in grams(text):
                buffers.setdefault(lang, []).append(g)
                waiting[lang] = waiting.get(lang, 0) + len(g)
                if waiting[lang] > _FLUSH:
                    merge(lang)
        if sum(len(k) for k, _ in totals.values()) + sum(waiting.values()) > 8 * _FLUSH:
            yield from rows()
    yield from rows()


def learn_profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """(lang, gram, place) of each language's profile, from every row of ``docs``
    (columns text and lang) whose text and lang are not null."""
    known = docs.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counted = arrow_map(known, _count_grams, "lang string, gram long, n long")
    total = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")) - 1
    return total.withColumn("place", place).where(F.col("place") < size).select("lang", "gram", "place")


def predict(docs: DataFrame, profiles: DataFrame, size: int = PROFILE, keep_text: bool = False) -> DataFrame:
    """``docs`` (but ``text``, if it isn't to be kept) with lang_pred and score (1 less the
    distance as a part of the largest possible one).

    The profiles reach the driver: ``size`` rows a language, so they follow the number
    of languages and not the corpus.
    """
    rows = profiles.select("lang", "gram", "place").collect()
    langs = sorted({r["lang"] for r in rows})
    keys = np.array(sorted({r["gram"] for r in rows}), dtype=np.uint64)
    places = np.full((len(langs), len(keys) + 1), -1, dtype=np.int32)
    for r in rows:
        places[langs.index(r["lang"]), np.searchsorted(keys, np.uint64(r["gram"]))] = r["place"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text").to_pylist():
                top = ranked(text, size) if text else keys[:0]
                if not len(top) or not langs:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                at = np.searchsorted(keys, top)
                at[(at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] != top)] = len(keys)
                known = places[:, at]
                out = np.where(known < 0, size, np.abs(known - np.arange(len(top), dtype=np.int32))).sum(axis=1)
                best = int(np.argmin(out))
                names.append(langs[best])
                scores.append(float(1.0 - out[best] / (size * len(top))))
            kept = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*others, "lang_pred", "score"])

    others = [c for c in docs.columns if c not in ("lang_pred", "score") and (keep_text or c != "text")]
    schema = T.StructType([docs.schema[c] for c in others] + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return arrow_map(docs.select(*others, *([] if keep_text else ["text"])), score, schema)


def identify(docs: DataFrame, train: DataFrame, size: int = PROFILE, keep_text: bool = False) -> DataFrame:
    """:func:`predict` for ``docs`` with the profiles of ``train`` (text, lang)."""
    return predict(docs, cut(learn_profiles(train, size), "language-profiles"), size, keep_text)
