"""Chat formatting in budgeted windows.

A conversation is rendered turn by turn and cut into windows of a token budget. Prefix sums of
the turns' token counts choose where: a window takes the system turn, a few of the turns before it
as history, and as many new turns as then fit. Only new turns of the assistant are under the loss mask, so each is
trained on once, however often it is repeated as history.

A turn is `<|im_start|>` + role + line feed + text + `<|im_end|>` + line feed. Where a role or text holds
one of `CONTROLS`, a backslash is put behind its first character; where backslashes are there already,
one more. Taking one away restores the text, and no control string is left inside.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections import deque
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Strings that chat templates and tokenizers treat as control marks.
CONTROLS = [
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>", "<|system|>", "<|user|>",
    "<|assistant|>", "<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<SYS>", "</SYS>",
]
_PLAIN = re.compile("|".join(f"{re.escape(c[0])}(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS))
_ESCAPED = re.compile("|".join(f"{re.escape(c[0])}\\\\(?=\\\\*{re.escape(c[1:])})" for c in CONTROLS))

BUDGET = 512
HISTORY_TURNS = 2
# Tokens of a window that history may take.
HISTORY_BUDGET = 128
WINDOWS = (
    "conv_id long, window int, n_repeated int, n_turns int, n_tokens long, text string, "
    "loss_starts array<bigint>, loss_ends array<bigint>"
)


def escape(text: str) -> str:
    return _PLAIN.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[0][:-1], text)


def _role_line(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(line))


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its text begins and ends in it."""
    head, body = f"{OPEN}{_role_line(role)}\n", escape(text)
    return f"{head}{body}{CLOSE}\n", len(head), len(head) + len(body)


def parse(window: str) -> list[tuple[str, str, int, int]]:
    """(role, text, begin, end of the escaped text) of each turn of a window."""
    turns, at = [], 0
    while at < len(window):
        line = window.index("\n", at)
        end = window.index(CLOSE, line)
        turns.append((_role_of(window[at + len(OPEN) : line]), unescape(window[line + 1 : end]), line + 1, end))
        at = end + len(CLOSE) + 1
    return turns


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def token_counts(texts: list[str], path: str) -> list[int]:
    """Number of ids that a tokenizers file gives for each text."""
    counts = []
    for at in range(0, len(texts), 256):
        found = _tokenizer(path).encode_batch_fast(texts[at : at + 256], add_special_tokens=False)
        counts.extend(len(x.ids) for x in found)
    return counts


class _Windows:
    """The windows of one conversation, turn after turn; holds one window and its possible history.

    A turn is (role, text, tokens of all turns before it, its own tokens): a span of turns has as
    many tokens as the difference of two such prefix sums.
    """

    def __init__(self, conv_id, budget: int, history_turns: int, history_budget: int):
        self.conv_id, self.budget, self.history_budget = conv_id, budget, history_budget
        self.system = None
        self.number, self.seen, self.before = 0, 0, 0
        self.new, self.history, self.past = [], [], deque(maxlen=history_turns)

    def _fixed(self) -> int:
        """Tokens of the system turn, where the window doesn't begin with it."""
        return self.system[3] if self.system and self.number else 0

    def add(self, role: str, text: str, tokens: int):
        turn = (role, text, self.before, tokens)
        if self.new:
            first = (self.history or self.new)[0]
            if self._fixed() + self.before + tokens - first[2] > self.budget:
                yield self.flush()
        if not self.new:
            room = min(self.history_budget, self.budget - self._fixed() - tokens)
            self.history = [t for t in self.past if self.before - t[2] <= room]
        if self.seen == 0 and role == "system":
            self.system = turn
        self.new.append(turn)
        self.seen += 1
        self.before += tokens

    def flush(self) -> tuple:
        repeated = ([self.system] if self._fixed() else []) + self.history
        text, starts, ends, tokens = "", [], [], 0
        for i, (role, said, _, n) in enumerate([*repeated, *self.new]):
            shown, begin, end = render(role, said)
            if i >= len(repeated) and role == "assistant":
                starts.append(len(text) + begin)
                ends.append(len(text) + end)
            text += shown
            tokens += n
        row = (self.conv_id, self.number, len(repeated), len(repeated) + len(self.new), tokens, text, starts, ends)
        self.past.extend(t for t in self.new if t is not self.system)
        self.number, self.new = self.number + 1, []
        return row


def _batch(rows: list[tuple], kinds: list) -> pa.RecordBatch:
    names, types = zip(*kinds)
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], list(names))


_WINDOW_KINDS = [
    ("conv_id", pa.int64()), ("window", pa.int32()), ("n_repeated", pa.int32()), ("n_turns", pa.int32()),
    ("n_tokens", pa.int64()), ("text", pa.string()), ("loss_starts", pa.list_(pa.int64())), ("loss_ends", pa.list_(pa.int64())),
]


def format_conversations(
    turns: DataFrame, tokenizer: str, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
    history_budget: int = HISTORY_BUDGET, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Windows of all conversations: text, loss spans [start, end) in code points, repeated turns first.

    `n_repeated` turns at the start of a window are the system turn and history: as many of the last
    `history_turns` as `history_budget` tokens and the first new turn allow. A turn above the budget has a window of its own and is kept whole.
    The system turn is in every window, however long it is: where it leaves no room for the next turn, a window is the system
    turn and that turn, above the budget and without history. Null texts
    and roles are empty; rows are ordered by turn, then role and text, nulls first; repeated rows are
    turns of their own; rows without a conv_id are one conversation. An empty table gives no windows.
    Tokens of turns are counted where the rows are read. A conversation then goes through one task as a sorted stream that
    adds up these counts and holds a window at a time.
    """
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def count(batches):
        for batch in batches:
            said = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())
            counts = pa.array(token_counts([render(*turn)[0] for turn in said], tokenizer), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, "n_tokens"])

    def cut(batches):
        current = None
        for batch in batches:
            done = []
            for conv, who, said, n in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text", "n_tokens"))):
                if current is None or current.conv_id != conv:
                    if current:
                        done.append(current.flush())
                    current = _Windows(conv, budget, history_turns, history_budget)
                done.extend(current.add(who, said, n))
            yield _batch(done, _WINDOW_KINDS)
        if current:
            yield _batch([current.flush()], _WINDOW_KINDS)

    counted = rows.mapInArrow(count, T.StructType([*rows.schema, T.StructField("n_tokens", T.LongType())]))
    ordered = counted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text", "n_tokens").mapInArrow(cut, WINDOWS)


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
_DIGEST_KINDS = [
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_windows", pa.int64()),
]


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """What stored windows hold of each conversation: its turns, and the text under the loss mask, as digests.

    Windows are read in order; turns that repeat are skipped, spans are unescaped. Hashing goes
    along the sorted stream, so a long conversation takes no memory.
    """

    def digest(batches):
        state = None

        def row():
            return (state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5], state[6])

        for batch in batches:
            done = []
            names = ("conv_id", "n_repeated", "text", "loss_starts", "loss_ends")
            for conv, repeated, text, starts, ends in zip(*(batch.column(k).to_pylist() for k in names)):
                if state is None or state[0] != conv:
                    if state:
                        done.append(row())
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for who, said, _, _ in parse(text)[repeated:]:
                    state[1] += 1
                    state[2].update(f"{who}\n{said}\n".encode())
                for a, b in zip(starts, ends):
                    learnt = unescape(text[a:b])
                    state[3] += len(learnt)
                    state[4].update(learnt.encode())
                state[5] += len(text)
                state[6] += 1
            yield _batch(done, _DIGEST_KINDS)
        if state:
            yield _batch([row()], _DIGEST_KINDS)

    windows = spark.read.schema(WINDOWS).parquet(path)
    ordered = windows.repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(digest, DIGESTS)
