"""Fill-in-the-middle transformation over piece tables.

A document is a list of descriptors (buffer, start, length) over two buffers that never
change: the document's own bytes and the three sentinels.  Cutting splits a descriptor
at an offset, an arrangement permutes descriptors with sentinels put between, and the text
is read by streaming the descriptors in their order.  Going back cuts the output at its
sentinels, drops these and applies the inverse permutation; it needs the output and the form alone.
The bytes of a batch stay where Arrow holds them: a descriptor is a view, never a copy.

Units are lines (`[^\\n]*\\n|[^\\n]+`).  Where the cuts fall and which form is used is
drawn from the sha256 of `seed:doc_id`, so a lost task makes the same output again.

Defined cases: a null text is empty; an empty text, and one that holds a sentinel, is plain
(left as it is, its prefix_chars and middle_chars null); any part may be empty; a null
doc_id draws as an empty one; rows that share an id share their draws, each on its own
text; repeated rows give repeated rows; an empty table gives no rows; other columns are
not read.  A long text is one row's bytes and its output, batches are cut to a few MB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import arrow_map, byte_views, text_array

#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
TEXT, MARKS = 0, 1
#: The order of the parts (0 prefix, 1 middle, 2 suffix) and the sentinel before each, by form.
ARRANGED = {"psm": ((0, PREFIX), (2, SUFFIX), (1, MIDDLE)), "spm": ((2, SUFFIX), (0, PREFIX), (1, MIDDLE))}
SEED, RATE, SPM_RATE = 7, 100, 50

Piece = tuple[int, int, int]  # buffer, start, length


def cut_at(pieces: list[Piece], offset: int) -> list[Piece]:
    """The same text with a boundary between descriptors ``offset`` bytes from its start."""
    out = []
    for buffer, start, length in pieces:
        if 0 < offset < length:
            out += [(buffer, start, offset), (buffer, start + offset, length - offset)]
        else:
            out.append((buffer, start, length))
        offset -= length
    return out


def split(pieces: list[Piece], first: int, second: int) -> list[list[Piece]]:
    """Prefix, middle and suffix, each a list of descriptors (none, if empty)."""
    parts: list[list[Piece]] = [[], [], []]
    at = 0
    for piece in cut_at(cut_at(pieces, first), second):
        if piece[2]:
            parts[0 if at < first else 1 if at < second else 2].append(piece)
        at += piece[2]
    return parts


def arrange(parts: list[list[Piece]], form: str) -> list[Piece]:
    out = []
    for part, mark in ARRANGED[form]:
        out += [(MARKS, SENTINELS.index(mark), len(mark)), *parts[part]]
    return out


def undo(output: memoryview, form: str) -> list[Piece]:
    """The descriptors over ``output`` that give the text back."""
    whole = (TEXT, 0, len(output))
    if form == "plain":
        return [whole]
    pieces, ends, at = [whole], [], 0
    raw = bytes(output)
    for _, mark in ARRANGED[form]:
        at = raw.index(mark, at)
        ends.append((at, at + len(mark)))
        at += len(mark)
    for start, end in ends:
        pieces = cut_at(cut_at(pieces, start), end)
    starts = {start for start, _ in ends}
    parts: list[list[Piece]] = [[], [], []]
    order = [part for part, _ in ARRANGED[form]]
    k = -1
    for piece in pieces:
        if piece[1] in starts and piece[2] == len(PREFIX) and k + 1 < len(ends) and piece[1] == ends[k + 1][0]:
            k += 1
        elif piece[2]:
            parts[order[k]].append(piece)
    return parts[0] + parts[1] + parts[2]


def stream(pieces: list[Piece], text: memoryview) -> Iterator[memoryview]:
    buffers = (text, memoryview(SENTINELS))
    for buffer, start, length in pieces:
        yield buffers[buffer][start:start + length]


def digest(pieces: list[Piece], text: memoryview) -> str:
    seen = hashlib.sha256()
    for part in stream(pieces, text):
        seen.update(part)
    return seen.hexdigest()


def draws(doc_id: int | None, seed: int) -> tuple[int, ...]:
    name = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(name[8 * i:8 * i + 8], 16) for i in range(4))


def line_ends(text: memoryview) -> np.ndarray:
    """Byte offsets where lines end; a last line may lack its line break."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not len(text) or (len(ends) and ends[-1] == len(text)) else np.append(ends, len(text))


def chars(text: memoryview) -> int:
    """Code points of UTF-8 bytes: all bytes but those that continue one."""
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def plan(doc_id: int | None, text: memoryview, seed: int, rate: int, spm_rate: int) -> tuple[int, str, list[list[Piece]]]:
    """Number of lines, form and parts of one document."""
    ends, raw = line_ends(text), bytes(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not raw or PREFIX in raw or SUFFIX in raw or MIDDLE in raw or h3 % 100 >= rate:
        return len(ends), "plain", [[(TEXT, 0, len(raw))], [], []]
    low, high = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    at = [int(ends[k - 1]) if k else 0 for k in (low, high)]
    return len(ends), "spm" if h4 % 100 < spm_rate else "psm", split([(TEXT, 0, len(raw))], *at)


_PIECES = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))


def _transform(seed: int, rate: int, spm_rate: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, forms, first, middle, tables, outputs = [], [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), byte_views(batch.column("text")), strict=True):
                text = memoryview(b"") if text is None else text
                lines, form, parts = plan(doc_id, text, seed, rate, spm_rate)
                pieces = parts[0] if form == "plain" else arrange(parts, form)
                size = [None, None] if form == "plain" else [sum(chars(p) for p in stream(part, text)) for part in parts[:2]]
                n.append(lines)
                forms.append(form)
                first.append(size[0])
                middle.append(size[1])
                tables.append([{"buffer": b, "start": s, "length": k} for b, s, k in pieces])
                outputs.append(b"".join(stream(pieces, text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(first, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(tables, _PIECES), text_array(outputs)],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "pieces", "output"])

    return run


def transform(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """One row per document (doc_id, text): doc_id, n (lines), form (psm, spm or plain), prefix_chars,
    middle_chars, pieces (the descriptors, in bytes; buffer 0 is the text, 1 the sentinels), output.
    ``rate`` per cent of the documents are transformed, ``spm_rate`` per cent of these as spm."""
    return arrow_map(docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]), _transform(seed, rate, spm_rate),
                     "doc_id long, n long, form string, prefix_chars long, middle_chars long, "
                     "pieces array<struct<buffer:int,start:long,length:long>>, output string")


def _restore(names: list[str], texts: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, back, restored = [], [], []
            for form, output in zip(batch.column("form").to_pylist(), byte_views(batch.column("output")), strict=True):
                pieces = undo(output, form)
                made.append(digest([(TEXT, 0, len(output))], output))
                back.append(digest(pieces, output))
                if texts:
                    restored.append(b"".join(stream(pieces, output)))
            kept = [batch.column(c) for c in names] + ([text_array(restored)] if texts else [])
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.string()), pa.array(back, pa.string())],
                                             names=names + (["restored"] if texts else []) + ["output_sha256", "restored_sha256"])

    return run


def restore(transformed: DataFrame, texts: bool = True) -> DataFrame:
    """``transformed`` (of which form and output are read) with restored, the text as it was, and the digests of
    output and restored, streamed from the descriptors.  Without ``texts`` both texts are left out."""
    lost = {"output", "pieces"} if not texts else set()
    names = [c for c in transformed.columns if c not in lost]
    kinds = dict(transformed.dtypes)
    schema = [f"`{c}` {kinds[c]}" for c in names] + (["restored string"] if texts else []) + ["output_sha256 string", "restored_sha256 string"]
    given = transformed if texts else transformed.drop("pieces")
    return arrow_map(given, _restore(names, texts), ", ".join(schema))
