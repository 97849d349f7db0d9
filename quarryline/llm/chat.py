"""Chat formatting with offset-aligned loss masks.

A conversation is rendered with a marker before and behind every turn, encoded
once with offsets, and the sorted spans of the assistant texts are met with the
sorted token spans by binary search.  A token that reaches over the border of a
text is masked for the part inside, so the mask covers exactly the texts.

A long conversation is rendered in blocks of `BLOCK_TURNS` consecutive turn numbers, in pieces of as many rows at
most.  Rows are dealt out in ranges of conversation, turn, role and beginning of the text, so neither a conversation nor
a turn number that holds very many rows fills a task.
Turns end with a line feed and start with a bracket, where the tokenizer's pattern
always cuts, so the blocks' tokens are those of the whole.  Only digests need the blocks of a conversation in order; they pass one task
as a stream and are never held together.

Defined results: null texts and roles count as empty; equal turn numbers are
ordered by role, then text, and repeated rows stay; null turn numbers come first;
rows without a conv_id form one conversation of their own.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_TURNS = 64
#: Characters encoded at a time.
BATCH_CHARS = 1 << 20
#: Characters of a text that decide which task it goes to; whole texts would fill the sample that sets the ranges.
RANGE_CHARS = 100

MARKERS = {"user": ("[INST]", "[/INST]"), "assistant": ("[OUT]", "[/OUT]</s>"), "system": ("[SYS]", "[/SYS]")}
#: Any other role: its name stands between the first two.
OTHER_ROLE = ("[ROLE]", "[IS]", "[/ROLE]")
_CONTROL = re.compile(r"([<\[])(\\*)(/?(?:s>|(?:INST|OUT|SYS|ROLE|IS)\]))")
_LOADED = re.compile(r"([<\[])\\(\\*/?(?:s>|(?:INST|OUT|SYS|ROLE|IS)\]))")


def escape(text: str) -> str:
    """One backslash more behind the bracket of every control string, escaped ones included."""
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _LOADED.sub(r"\1\2", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns and the spans of the assistant texts in it."""
    parts, spans, at = [], [], 0

    def add(piece: str) -> None:
        nonlocal at
        parts.append(piece)
        at += len(piece)

    for role, text in turns:
        if role in MARKERS:
            first, last = MARKERS[role]
        else:
            first, last = OTHER_ROLE[0] + escape(role) + OTHER_ROLE[1], OTHER_ROLE[2]
        add(first)
        start = at
        add(escape(text))
        if role == "assistant":
            spans.append((start, at))
        add(last + "\n")
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    at, turns = 0, []
    while at < len(formatted):
        for role, (first, last) in MARKERS.items():
            if formatted.startswith(first, at):
                at += len(first)
                break
        else:
            name = formatted.index(OTHER_ROLE[1], at)
            role, last = unescape(formatted[at + len(OTHER_ROLE[0]) : name]), OTHER_ROLE[2]
            at = name + len(OTHER_ROLE[1])
        end = formatted.index(last, at)
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(last) + 1
    return turns


def mask(token_starts: np.ndarray, token_ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token, from, to) of every part of a token inside a span; both sides are sorted."""
    edges = np.array([s for s in spans if s[0] < s[1]], np.int64).reshape(-1, 2)
    low = np.searchsorted(token_ends, edges[:, 0], side="right")
    high = np.searchsorted(token_starts, edges[:, 1], side="left")
    counts = np.maximum(high - low, 0)
    token = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    own = np.repeat(np.arange(len(edges)), counts)
    return token, np.maximum(token_starts[token], edges[own, 0]), np.minimum(token_ends[token], edges[own, 1])


def masked_pieces(formatted: str, starts: np.ndarray, ends: np.ndarray) -> Iterator[str]:
    """The text under a mask; tokens that share a character give it once."""
    done = 0
    for a, b in zip(starts.tolist(), ends.tolist()):
        if b > done:
            yield formatted[max(a, done) : b]
            done = b


@cache
def tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer, processors

    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    loaded.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets with their spaces
    return loaded


def _runs(batches, keys: list[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Slices of equal keys of a sorted partition, and whether a slice starts a new key."""
    last = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        marks = list(zip(*columns))
        at = 0
        while at < len(marks):
            end = at + 1
            while end < len(marks) and marks[end] == marks[at]:
                end += 1
            yield marks[at] != last, batch.slice(at, end - at)
            last, at = marks[at], end


def _formatted(batches, path: str, block_turns: int) -> Iterator[pa.RecordBatch]:
    coder = tokenizer(path)
    held: list[tuple] = []  # conversation, block, piece, turns
    size = own = 0
    piece = TaskContext.get().partitionId() << 32

    def out() -> pa.RecordBatch:
        rendered = [render(turns) for *_, turns in held]
        coded = coder.encode_batch([text for text, _ in rendered], add_special_tokens=False)
        columns: list[list] = [[] for _ in range(6)]
        for (_, spans), code in zip(rendered, coded):
            offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
            token, start, end = mask(offsets[:, 0], offsets[:, 1], spans)
            for column, values in zip(columns, (code.ids, offsets[:, 0], offsets[:, 1], token, start, end)):
                column.append(np.asarray(values, "<u4").tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([h[0] for h in held], kind)]
            + [pa.array(values, pa.int64()) for values in ([h[1] for h in held], [h[2] for h in held], [len(h[3]) for h in held])]
            + [pa.array([t for t, _ in rendered], pa.string())]
            + [pa.array(c, pa.binary()) for c in columns],
            names=["conv_id", "block", "piece", "n_turns", "formatted", "ids", "starts", "ends", "loss_tokens", "loss_starts", "loss_ends"],
        )

    kind = None
    for new, rows in _runs(batches, ["conv_id", "block"]):
        kind = rows.schema.field("conv_id").type
        conversation, block = (rows.column(c)[0].as_py() for c in ("conv_id", "block"))
        for turn in zip(rows.column("role").to_pylist(), rows.column("text").to_pylist()):
            if new or len(held[-1][3]) >= block_turns or own >= BATCH_CHARS:
                if size > BATCH_CHARS:
                    yield out()
                    held, size = [], 0
                held.append((conversation, block, piece, []))
                piece, own, new = piece + 1, 0, False
            held[-1][3].append(turn)
            chars = len(turn[0]) + len(turn[1])
            own, size = own + chars, size + chars
    if held:
        yield out()


def format_conversations(turns: DataFrame, path: str, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per piece of a conversation, in the order of (conv_id, block, piece).

    A block is `block_turns` turn numbers, and null ones a block of their own.  A piece is `block_turns` rows of a block at most:
    however many rows a turn number has, they are dealt out by role and the beginning of their text, and a task holds a
    piece or so at a time.  Only rows that agree in all of these come to one task.

    formatted: the text; ids, starts, ends: its tokens and their characters; loss_tokens,
    loss_starts, loss_ends: the masked tokens and the characters of each that count.
    All numbers are little-endian 32-bit.  Needs conv_id, turn, role and text.
    """
    block = F.floor(F.col("turn") / block_turns).cast("long")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), block.alias("block"))
    dealt = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, RANGE_CHARS))
    met = dealt.sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = turns.schema["conv_id"].dataType.simpleString()
    binary = ", ".join(f"{c} binary" for c in ("ids", "starts", "ends", "loss_tokens", "loss_starts", "loss_ends"))
    return met.mapInArrow(partial(_formatted, path=path, block_turns=block_turns), f"conv_id {kind}, block long, piece long, n_turns long, formatted string, {binary}")


class _Digest:
    def __init__(self, conv_id):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts: bytes, ends: bytes) -> None:
        for role, text in parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        # An escaped string lies within one text, so texts are put together before they are unescaped.
        masked = unescape("".join(masked_pieces(formatted, np.frombuffer(starts, "<u4").astype(np.int64), np.frombuffer(ends, "<u4").astype(np.int64))))
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _digests(batches) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    done: list[tuple] = []
    current, kind = None, None

    def out() -> pa.RecordBatch:
        kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)

    for new, rows in _runs(batches, ["conv_id"]):
        kind = rows.schema.field("conv_id").type
        if new:
            if current is not None:
                done.append(current.row())
            if len(done) >= 1000:
                yield out()
                done = []
            current = _Digest(rows.column("conv_id")[0].as_py())
        for i in range(rows.num_rows):
            current.add(*(rows.column(c)[i].as_py() for c in ("formatted", "loss_starts", "loss_ends")))
    if current is not None:
        done.append(current.row())
        yield out()


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted blocks: turns and masked text, counted and hashed."""
    rows = formatted.select("conv_id", "block", "piece", "formatted", "loss_starts", "loss_ends")
    met = rows.repartition("conv_id").sortWithinPartitions("conv_id", "block", "piece")
    kind = formatted.schema["conv_id"].dataType.simpleString()
    return met.mapInArrow(_digests, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
