"""Exact substring deduplication on suffix arrays built column by column.

Every byte covered by a 200-byte string that also starts anywhere else is removed.

The collection's Burrows-Wheeler transform is built as the column-wise method for
many documents does it: in round j each document gets its next symbol from the right
inserted where its suffix of length j stands, and the common prefixes of neighbours
are updated in the same sequential pass.  Rounds over whole texts would be as many as
the longest text has bytes, each a pass over all the text; so the documents of a
collection are short here.  A window of 200 bytes is *owned* by one place inside it,
the smallest hash of a 32-byte piece (leftmost on ties).  Equal windows have equal
owners at equal offsets, so:

* the windows that one place owns, a run of neighbouring starts, make one segment of
  at most 368 bytes; segments can only match within the same owner hash;
* segments that occur twice or more as they are need no further look, and owner
  hashes that occur once cannot match: neither sends any text;
* what is left, segments that are unlike but share an owner, is cut by the window's
  distance from its owner into steps of STEP: the windows of a step all hold the same
  core of 200 - STEP + 1 bytes, so they can only match where the cores do, and a core
  is one symbol with at most STEP - 1 bytes before and behind it;
* these short documents are built into collections, and suffixes whose common prefix
  reaches STEP symbols, core included, are repeated windows.

A collection holds a bounded number of documents, so its files are arrays in the
memory of one task.  An owner shared by more unlike segments than a collection
takes goes by counts of single windows instead, exactly and without a bound.

Defined cases: a null text is empty; texts under 200 bytes keep every byte; documents
repeated row for row match each other; a null doc_id is an id; an empty table gives
no rows; other columns are not read.  Long texts are read in pieces that overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, cut, may_match

LENGTH = 200
_K = 32
_PIECE = 1 << 22
#: Windows of one step share a core.
STEP = 32
#: Documents in a collection, and the most unlike segments of one owner that go into one.
COLLECTION = 2048
ONE_OWNER = 4096

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ODD = [np.uint64(x) | np.uint64(1) for x in _rng.integers(0, 1 << 63, 6, dtype=np.uint64)]
_INDEX = np.uint64((1 << 24) - 1)


def owners(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first start, number of starts, owner hash, owner's place) of each run of windows with one owner."""
    h = _BYTE[data]
    step = 1
    for odd in _ODD[:5]:
        h = h[:-step] * odd + h[step:]
        step *= 2
    h = (h ^ (h >> np.uint64(29))) * _ODD[5]
    key = (h & ~_INDEX) | np.arange(len(h), dtype=np.uint64)
    width, have = length - _K + 1, 1
    while 2 * have <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    key = np.minimum(key[:len(key) - (width - have)], key[width - have:])
    place = (key & _INDEX).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return first, np.diff(np.concatenate([first, [len(place)]])), h[place[first]], place[first]


def _segments(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = [], []
            cols: dict[str, list[np.ndarray]] = {"owner": [], "seg": [], "at": [], "own": []}
            sizes: dict[str, list[int]] = {"owner": [0], "own": [0]}
            for doc, th, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                lo_, n_, o_, p_ = [], [], [], []
                for at in range(0, len(raw) - length + 1, _PIECE):
                    lo, n, o, place = owners(np.frombuffer(raw, np.uint8, min(len(raw) - at, _PIECE + length - 1), at), length)
                    p_.append(place - lo)
                    lo_.append(lo + at)
                    n_.append(n)
                    o_.append(o)
                if not lo_:
                    continue
                lo, n, o, ahead = np.concatenate(lo_), np.concatenate(n_), np.concatenate(o_).view(np.int64), np.concatenate(p_)
                seg = np.array([xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(lo.tolist(), (lo + n + (length - 1)).tolist(), strict=True)],
                               dtype=np.uint64).view(np.int64)
                _, first, place, count = np.unique(seg, return_index=True, return_inverse=True, return_counts=True)
                twice = count > 1
                own = np.zeros(0, np.int64)
                if twice.any():
                    again = twice[place]
                    a, b = lo[again], (lo + n)[again]
                    split = np.flatnonzero(np.concatenate([[True], a[1:] != b[:-1]]))
                    own = np.stack([a[split], b[np.concatenate([split[1:], [len(b)]]) - 1]], axis=1).ravel()
                ids.append(doc)
                hashes.append(th)
                cols["owner"].append(o[first])
                cols["seg"].append(seg[first])
                cols["at"].append((lo[first] << 25) | (ahead[first] << 13) | (n[first] << 1) | twice)
                cols["own"].append(own)
                sizes["owner"].append(len(first))
                sizes["own"].append(len(own))
            many, few = (pa.array(np.cumsum(sizes[k]), pa.int32()) for k in ("owner", "own"))
            flat = {k: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for k, v in cols.items()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(hashes, pa.int64()),
                 *(pa.ListArray.from_arrays(many, flat[k]) for k in ("owner", "seg", "at")), pa.ListArray.from_arrays(few, flat["own"])],
                names=["doc_id", "th", "owner", "seg", "at", "own"])

    return run


def bwt_lcp(segments: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Column-wise transform of a collection of symbol arrays: (bwt, lcp, document, suffix
    length) in suffix order.  In the transform a symbol is one more than it was and 0 ends
    a document; lcp counts no end mark."""
    n = len(segments)
    size = np.array([len(s) for s in segments], dtype=np.int64)
    text = np.zeros((n, int(size.max(initial=0)) + 1), dtype=np.uint16)
    for i, s in enumerate(segments):
        text[i, text.shape[1] - len(s):] = s
        text[i, text.shape[1] - len(s):] += 1
    text = text[:, ::-1]
    symbols, text = np.unique(text, return_inverse=True)
    text = text.reshape(n, -1).astype(np.uint8 if len(symbols) < 256 else np.uint16)
    bwt, lcp = text[:, 0].copy(), np.zeros(n, dtype=np.uint16)
    doc, length = np.arange(n, dtype=np.int32), np.zeros(n, dtype=np.uint16)
    live, place = np.arange(n), np.arange(n)
    for j in range(1, text.shape[1]):
        alive = size[live] >= j
        live, place = live[alive], place[alive]
        order = np.argsort(bwt, kind="stable")
        ends = int(np.searchsorted(bwt[order], 1)) if len(symbols) else 0
        # suffix number k >= n of the new list extends the suffix at order[ends + k - n]
        rank = np.empty(len(bwt), dtype=np.int64)
        rank[order] = np.arange(len(bwt)) - ends + n
        new = rank[place]
        by = np.argsort(new, kind="stable")
        live, new = live[by], new[by]
        total = len(bwt) + len(new)
        old = np.ones(total, dtype=bool)
        old[new] = False

        def merged(before: np.ndarray, values: np.ndarray) -> np.ndarray:
            out = np.empty(total, dtype=before.dtype)
            out[old] = before
            out[new] = values
            return out

        fresh = merged(lcp, np.zeros(len(new), dtype=np.uint16))
        touched = np.concatenate([new, new + 1])
        touched = touched[(touched > n) & (touched < total)]
        p, q = order[ends + touched - n], order[ends + touched - n - 1]
        same = bwt[p] == bwt[q]
        fresh[touched[~same]] = 0
        p, q, touched = p[same], q[same], touched[same]
        if len(p):
            pairs = np.empty(2 * len(p), dtype=np.int64)
            pairs[0::2], pairs[1::2] = q + 1, p + 1
            fresh[touched] = np.minimum.reduceat(np.append(lcp, np.uint16(0)), pairs)[0::2] + 1
        lcp = fresh
        bwt, doc = merged(bwt, text[live, j]), merged(doc, live.astype(np.int32))
        length = merged(length, np.full(len(new), j, dtype=np.uint16))
        place = new
    return symbols[bwt], lcp, doc, length


def repeated_starts(segments: list[np.ndarray], length: int) -> list[np.ndarray]:
    """For each segment, the offsets whose ``length`` symbols start at another place too."""
    _, lcp, doc, suffix = bwt_lcp(segments)
    long = lcp >= length
    long[:-1] |= long[1:].copy()
    size = np.array([len(s) for s in segments])
    docs, at = doc[long], (size[doc[long]] - suffix[long])
    by = np.lexsort([at, docs])
    docs, at = docs[by], at[by]
    return np.split(at, np.searchsorted(docs, np.arange(1, len(segments))))


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    cutat = np.flatnonzero(np.diff(starts) != 1)
    return list(zip(starts[np.concatenate([[0], cutat + 1])].tolist(), (starts[np.concatenate([cutat, [len(starts) - 1]])] + 1).tolist(), strict=True))


def _collections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (owner, step, core)."""
    held: list[tuple] = []
    group: list[tuple] = []
    key = None

    def close() -> None:
        # a core that stands alone, or whose documents are all settled, tells nothing
        if len(group) > 1 and not all(r[3] for r in group):
            held.extend((*r, len(group)) for r in group)
        group.clear()

    def solve() -> pa.RecordBatch:
        out, told, core, last = [], [], 255, None
        for _, _, _, _, before, after, which, _ in held:
            core, last = (core, last) if which == last else (core + 1, which)
            told.append(np.concatenate([np.frombuffer(before, np.uint8), [core], np.frombuffer(after, np.uint8)]).astype(np.uint16))
        for (doc, th, lo, settled, _, _, _, _), at in zip(held, repeated_starts(told, STEP), strict=True):
            if not settled:
                out += [(doc, th, lo + a, lo + b) for a, b in _runs(at)]
        held.clear()
        cols = list(zip(*out, strict=True)) or [[], [], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "th", "a", "b"])

    for batch in batches:
        for owner, step, core, *row in zip(*(batch.column(c).to_pylist() for c in ("owner", "step", "core", "doc_id", "th", "lo", "settled", "before", "after")), strict=True):
            if (owner, step, core) != key:
                close()
                key = (owner, step, core)
                if len(held) >= COLLECTION:
                    yield solve()
            group.append((*row, key))
    close()
    if held:
        yield solve()


_PIECE_COLUMNS = {"doc_id": pa.int64(), "th": pa.int64(), "owner": pa.int64(), "step": pa.int32(), "core": pa.int64(), "lo": pa.int64(),
                  "settled": pa.bool_(), "crowded": pa.bool_(), "before": pa.binary(), "after": pa.binary()}


def _cut_out(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, th, text, asked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text", "asked")), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                for x in asked:
                    lo, ahead, n = x["at"] >> 25, (x["at"] >> 13) & 4095, (x["at"] >> 1) & 4095
                    if x["crowded"]:
                        rows.append((doc, th, x["owner"], -1, 0, lo, x["settled"], True, raw[lo:lo + n + length - 1], b""))
                        continue
                    for step in range((ahead - n + 1) // STEP, ahead // STEP + 1):
                        core = lo + ahead - STEP * step  # the last start of this step; the core goes on from it
                        end = core - STEP + 1 + length
                        first, last = max(lo, core - STEP + 1), min(lo + n - 1, core)
                        rows.append((doc, th, x["owner"], step, xxhash.xxh3_64_intdigest(raw[core:end]) - (1 << 63), first, x["settled"],
                                     False, raw[first:core], raw[end:last + length]))
            cols = list(zip(*rows, strict=True)) or [[]] * len(_PIECE_COLUMNS)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PIECE_COLUMNS.values(), strict=True)], names=list(_PIECE_COLUMNS))

    return run


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, th, lo, settled, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "lo", "settled", "before")), strict=True):
                rows += [(xxhash.xxh3_128_digest(data[i:i + length]), doc, th, lo + i, settled) for i in range(len(data) - length + 1)]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=["w", "doc_id", "th", "s", "settled"])

    return run


def repeated_windows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Runs of repeated window starts: (doc_id, th, a, b) for starts a to b - 1, of
    ``docs`` (doc_id, th, text), where th is a hash of the text."""
    told = docs.where(F.octet_length("text") >= length)
    segs = cut(arrow_map(told, _segments(length), "doc_id long, th long, owner array<long>, seg array<long>, at array<long>, own array<long>"), "segments")
    own = segs.where(F.size("own") > 0).select("doc_id", "th", F.explode(F.transform(
        F.sequence(F.lit(1), (F.size("own") / 2).cast("int")),
        lambda i: F.struct(F.element_at("own", 2 * i - 1).alias("a"), F.element_at("own", 2 * i).alias("b")))).alias("r")) \
        .select("doc_id", "th", "r.a", "r.b")
    flat = segs.select(F.explode(F.arrays_zip("owner", "seg", "at")).alias("x"), "doc_id", "th") \
        .select("x.owner", "x.seg", "x.at", "doc_id", "th")
    seen = F.when(F.col("at").bitwiseAND(1) == 1, 2).otherwise(1)
    shared = cut(flat.groupBy("owner").agg(F.sum(seen).alias("n"), (F.min("seg") != F.max("seg")).alias("unlike"))
                 .where("n > 1").select("owner", "unlike"), "shared-owners")
    members = cut(may_match(flat, F.col("owner"), shared, F.col("owner")).join(shared, "owner"), "members")
    lo, n = F.call_function("shiftright", F.col("at"), F.lit(25)), F.call_function("shiftright", F.col("at").bitwiseAND(8191), F.lit(1))
    run = [F.col("doc_id"), F.col("th"), lo.alias("a"), (lo + n).alias("b")]
    alike = members.where(~F.col("unlike")).select(*run)
    # unlike segments of one owner: those seen twice are settled, the others are compared
    mixed = members.where("unlike")
    classes = cut(mixed.groupBy("owner", "seg").agg(
        F.sum(seen).alias("n"), F.min(F.struct("doc_id", "th", "at")).alias("one")), "classes")
    settled = mixed.join(classes.where("n > 1").select("owner", "seg"), ["owner", "seg"]).select(*run)
    crowd = classes.groupBy("owner").agg(F.count("*").alias("k"), F.sum(F.when(F.col("n") == 1, 1)).alias("open")).where("open > 0")
    asked = classes.join(crowd, "owner").select(
        "one.doc_id", "one.th", F.struct("owner", "one.at", (F.col("n") > 1).alias("settled"),
                                         (F.col("k") > ONE_OWNER).alias("crowded")).alias("x")) \
        .groupBy("doc_id", "th").agg(F.collect_list("x").alias("asked"))
    asked = cut(asked, "asked")
    texts = may_match(told, F.col("th"), asked, F.col("th")).alias("t").join(
        asked.alias("q"), F.col("t.doc_id").eqNullSafe(F.col("q.doc_id")) & (F.col("t.th") == F.col("q.th"))) \
        .select("t.doc_id", "t.th", "text", "asked")
    pieces = cut(arrow_map(texts, _cut_out(length),
                           "doc_id long, th long, owner long, step int, core long, lo long, settled boolean, crowded boolean, "
                           "before binary, after binary"), "pieces")
    compared = arrow_map(pieces.where("not crowded").repartition("owner", "step", "core").sortWithinPartitions("owner", "step", "core"),
                         _collections, "doc_id long, th long, a long, b long")
    windows = arrow_map(pieces.where("crowded"), _windows(length), "w binary, doc_id long, th long, s long, settled boolean")
    twice = windows.groupBy("w").agg(F.count("*").alias("n")).where("n > 1").select("w")
    crowded = windows.where("not settled").join(twice, "w").select("doc_id", "th", F.col("s").alias("a"), (F.col("s") + 1).alias("b"))
    return own.unionByName(alike).unionByName(settled).unionByName(compared).unionByName(crowded)


def _remove(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, th, text, runs in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "text", "runs")), strict=True):
                raw, kept, end, removed, spans = text.encode("utf-8", "surrogatepass"), [], 0, 0, 0
                for a, b in sorted((r["a"], r["b"] + length - 1) for r in runs):
                    if a > end or not spans:
                        kept.append(raw[end:a])
                        spans += 1
                        removed += b - a
                    elif b > end:
                        removed += b - end
                    end = max(end, b)
                kept.append(raw[end:])
                rest = b"".join(kept)
                rows.append((doc, th, removed, spans, hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "replace")))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                             names=["doc_id", "th", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text) with nulls as empty texts; th keeps rows apart that share an id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def trimmed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents that lose bytes: doc_id, th, n_removed, n_spans, kept_sha256 and
    kept, the remaining text (a character cut in two is shown as U+FFFD there)."""
    rows = keyed(docs)
    runs = cut(repeated_windows(rows, length).groupBy("doc_id", "th").agg(F.collect_set(F.struct("a", "b")).alias("runs")), "runs")
    texts = may_match(rows, F.col("th"), runs, F.col("th")).alias("t").join(
        runs.alias("r"), F.col("t.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("t.th") == F.col("r.th"))) \
        .select("t.doc_id", "t.th", "text", "runs")
    return arrow_map(texts, _remove(length),
                     "doc_id long, th long, n_removed long, n_spans long, kept_sha256 string, kept string")


def dedup_report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    loss = cut(trimmed(docs, length).drop("kept").dropDuplicates(["doc_id", "th"]), "losses")
    whole = keyed(docs).select("doc_id", "th", F.octet_length("text").cast("long").alias("n_bytes"),
                               F.sha2(F.col("text").cast("binary"), 256).alias("sha"))
    zero = F.lit(0).cast("long")
    return whole.alias("w").join(loss.alias("l"), F.col("w.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("w.th") == F.col("l.th")), "left") \
        .select("w.doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"),
                F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
