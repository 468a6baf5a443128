"""Chat formatting in budgeted windows.

A conversation becomes windows of at most ``budget`` tokens.  Prefix sums of the turns'
tokens choose turn-aligned spans: a window ends before the first turn whose prefix sum
would pass the budget.  Every window after the first starts with the system turn in
force and the last few turns before it, within a budget of their own; these repeat
what an earlier window held and carry no loss.  The loss mask covers the text of each
assistant turn exactly once.

Template: ``<|turn|>role\\ntext<|end|>\\n`` for each turn.  Control strings inside a text
(this template's and those of other common ones) get a backslash after their first
character, and a backslash is doubled, so :func:`read_window` gives back every text as
it was; a line break in a role is written as backslash n.

Tokens are counted where the turns are read, before any shuffle, so a conversation of any
length is counted by many tasks.  Turns are then read in order through a sorted stream:
a task holds one window and its history, so neither a conversation nor a key is ever held whole.

Defined cases: null texts and roles are empty; turns of one number are ordered by role
and text; a turn over the budget is a window of its own (with the system turn),
``over_budget``; rows without conv_id are one conversation; repeated rows are turns
like others; an empty table gives no windows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import arrow_map, cut

BUDGET, HISTORY_TURNS, HISTORY_BUDGET = 1024, 2, 256
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
TURN, END = "<|turn|>", "<|end|>"
#: Control strings of common chat templates.
CONTROL = [TURN, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>",
           "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>", "<|assistant|>"]
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_TURN = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _role_back(role: str) -> str:
    return re.sub(r"\\(\\|n|)", lambda m: "\n" if m[1] == "n" else m[1], role)


_TOKENIZERS: dict[str, object] = {}


def counter(vocabulary: str | None) -> Callable[[list[str]], list[int]]:
    """Tokens of each text: by a tokenizer file, read once per worker, or words where there
    is none.  A few texts at a time, as an encoding is many times as large as its text."""
    if vocabulary is None:
        return lambda texts: [len(t.split()) for t in texts]
    if vocabulary not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _TOKENIZERS[vocabulary] = Tokenizer.from_file(vocabulary)
        _TOKENIZERS[vocabulary].encode_special_tokens = True
    known = _TOKENIZERS[vocabulary]
    return lambda texts: [len(e) for i in range(0, len(texts), 64) for e in known.encode_batch_fast(texts[i:i + 64], add_special_tokens=False)]


def read_window(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted window."""
    return [(_role_back(r), unescape(t)) for r, t in _TURN.findall(text)]


class _Writer:
    """Windows of one conversation, turn by turn."""

    def __init__(self, budget: int, history_turns: int, history_budget: int):
        self.budget, self.history_turns, self.history_budget = budget, history_turns, history_budget
        self.window, self.system = 0, None
        self.past: deque = deque(maxlen=max(1, history_turns))
        self._start(None)

    def _start(self, turn: tuple | None) -> None:
        """Open a window; ``turn`` is the one it must have room for."""
        context = []
        if self.window:
            held = list(self.past)[-self.history_turns:] if self.history_turns else []
            held = [t for t in held if t is not self.system]
            room = min(self.history_budget, self.budget - turn[2] - (self.system[2] if self.system else 0))
            while held and sum(t[2] for t in held) > room:
                held.pop(0)
            context = ([self.system] if self.system else []) + held
        self.context, self.new, self.total = context, [], sum(t[2] for t in context)

    def add(self, turn: tuple) -> Iterator[tuple]:
        # self.total is the prefix sum since the window began; the turn must fit under the budget
        if self.new and self.total + turn[2] > self.budget:
            yield self.close()
            self._start(turn)
        self.new.append(turn)
        self.total += turn[2]
        if turn[0] == "system":
            self.system = turn
        self.past.append(turn)

    def close(self) -> tuple:
        parts, spans, at = [], [], 0
        for i, (role, text, _) in enumerate(self.context + self.new):
            head, body = f"{TURN}{_role(role)}\n", escape(text)
            if i >= len(self.context) and role == "assistant":
                spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
            parts += [head, body, END, "\n"]
            at += len(head) + len(body) + len(END) + 1
        self.window += 1
        return (self.window - 1, "".join(parts), len(self.context), len(self.new), self.total, self.total > self.budget, spans)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_NAMES = ["conv_id", "window", "formatted", "n_context", "n_new", "n_tokens", "over_budget", "loss_spans"]
_KINDS = [pa.int64(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), _SPANS]


def _count(vocabulary: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary)
        for batch in batches:
            yield batch.append_column("n", pa.array(count(batch.column("text").to_pylist()), pa.int32()))

    return run


def _write(budget: int, history_turns: int, history_budget: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, writer = None, None
        for batch in batches:
            rows = []
            for conv, role, text, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "n")), strict=True):
                if writer is None or conv != key:
                    if writer is not None:
                        rows.append((key, *writer.close()))
                    key, writer = conv, _Writer(budget, history_turns, history_budget)
                rows += [(key, *w) for w in writer.add((role, text, n))]
            cols = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _KINDS, strict=True)], names=_NAMES)
        if writer is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((key, *writer.close()), _KINDS, strict=True)], names=_NAMES)

    return run


def windows(turns: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
            history_budget: int = HISTORY_BUDGET, vocabulary: str | None = VOCABULARY) -> DataFrame:
    """Windows of ``turns`` (conv_id, turn, role, text): conv_id, window, formatted, n_context
    (turns repeated in front), n_new, n_tokens, over_budget, loss_spans (character
    ranges of ``formatted`` that are targets)."""
    empty = F.lit("")
    clean = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"),
                         F.coalesce("text", empty).alias("text"))
    schema = T.StructType([*clean.schema.fields, T.StructField("n", T.IntegerType())])
    counted = arrow_map(clean, _count(vocabulary), schema)
    return arrow_map(counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"),
                     _write(budget, history_turns, history_budget),
                     "conv_id long, window int, formatted string, n_context int, n_new int, n_tokens int, over_budget boolean, "
                     "loss_spans array<struct<start:int,end:int>>")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, state = None, None

    def told() -> tuple:
        return (key, state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["formatted"])

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    for batch in batches:
        rows = []
        for conv, text, repeated, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "n_context", "loss_spans")), strict=True):
            if state is None or conv != key:
                if state is not None:
                    rows.append(told())
                key, state = conv, {"turns": 0, "chars": 0, "formatted": 0, "all": hashlib.sha256(), "loss": hashlib.sha256()}
            for role, said in read_window(text)[repeated:]:
                state["turns"] += 1
                state["all"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
            for span in spans:
                target = unescape(text[span["start"]:span["end"]])
                state["chars"] += len(target)
                state["loss"].update(target.encode("utf-8", "surrogatepass"))
            state["formatted"] += len(text)
        cols = list(zip(*rows, strict=True)) or [[]] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(told(), kinds, strict=True)], names=names)


def digests(formatted: DataFrame) -> DataFrame:
    """Each conversation as read back from its windows: n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    return arrow_map(cut(formatted, "windows").select("conv_id", "window", "formatted", "n_context", "loss_spans")
                     .repartition("conv_id").sortWithinPartitions("conv_id", "window"), _digest,
                     "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
