"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

Pre-tokens are found without a regular expression.  Every code point gets a class
from a table, look-ahead is folded into the symbol (last white space of a run, an
apostrophe that opens a contraction), and an eight-state automaton runs over the
symbols as a parallel scan: each stretch of the text is reduced to the function
it applies to a state, the functions are composed by doubling, and a second pass
marks where tokens start.  The slices between the marks go through a bounded
cache of merged pairs.

Defined results: a null text counts as empty and has no tokens; bytes that are
not valid UTF-8 count as characters that are neither letters, numbers nor space.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import arrays

#: Merged pieces a worker remembers.
CACHE_PIECES = 300_000
BLOCK_BYTES = 2 << 20
STRETCH = 64

# Character classes.
OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
#: Code points with the White_Space property other than U+0020.
WHITE_SPACE = [*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: What may follow an apostrophe in the contractions of the pattern.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]

# Symbols of the automaton: a class with its look-ahead; FIRST is added at the start of a text.
S_OTHER, S_LETTER, S_NUMBER, S_SPACE, S_SPACE_LAST, S_BLANK, S_BLANK_LAST, S_SHORT, S_LONG = range(9)
FIRST = 9
# States: nothing open; in letters, numbers, others, white space; after a space that joins what follows; one or two
# letters of a contraction to come.
EMPTY, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, JOINING, ONE_MORE, TWO_MORE = range(8)


@cache
def code_classes() -> np.ndarray:
    """The class of every code point."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8)
    table[WHITE_SPACE] = BLANK
    table[0x20] = SPACE
    return table


@cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a token starts) by symbol * 8 + state."""
    step, starts = np.zeros((18, 8), np.uint8), np.zeros((18, 8), bool)
    runs = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS}
    for symbol in range(9):
        for state in range(8):
            if state == TWO_MORE:
                now, new = ONE_MORE, False
            elif state == ONE_MORE:
                now, new = EMPTY, False
            elif symbol in runs:
                now, new = runs[symbol], state not in (runs[symbol], JOINING)
            elif symbol in (S_SHORT, S_LONG):
                if state in (IN_OTHERS, JOINING):
                    now, new = IN_OTHERS, False
                else:
                    now, new = ONE_MORE if symbol == S_SHORT else TWO_MORE, True
            elif symbol in (S_SPACE, S_BLANK):
                now, new = IN_SPACE, state != IN_SPACE
            else:
                now, new = JOINING if symbol == S_SPACE_LAST else EMPTY, True
            step[symbol, state], starts[symbol, state] = now, new
        step[symbol + FIRST], starts[symbol + FIRST] = step[symbol, EMPTY], True
    return step.reshape(-1), starts.reshape(-1)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, byte position of each) of UTF-8 texts."""
    lead = (data & 0xC0) != 0x80
    lead[offsets[:-1][offsets[:-1] < len(data)]] = True
    at = np.flatnonzero(lead)
    first = data[at].astype(np.int32)
    points = first.copy()
    for low, high, keep, more in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0xF8, 0x07, 3)):
        rows = np.flatnonzero((first >= low) & (first < high))
        if len(rows):
            value = first[rows] & keep
            for i in range(1, more + 1):
                value = (value << 6) | (data[np.minimum(at[rows] + i, len(data) - 1)] & 0x3F)
            points[rows] = np.minimum(value, sys.maxunicode)
    points[(first >= 0x80) & (first < 0xC0) | (first >= 0xF8)] = 0xFFFD
    return points, at


def symbols(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The automaton's symbol at every code point; firsts: positions where a text starts."""
    n = len(points)
    kind = code_classes()[points]
    space = kind >= SPACE
    last = np.zeros(n, bool)  # white space with other text behind it
    last[:-1] = space[:-1] & ~space[1:]
    before = firsts[firsts > 0] - 1
    last[before] = False
    out = kind.copy()
    out[kind == SPACE] = S_SPACE
    out[kind == BLANK] = S_BLANK
    out[last] += 1
    marks = np.flatnonzero(points == 0x27)
    if len(marks):
        border = np.zeros(n + 3, bool)
        border[firsts] = True
        border[n:] = True
        padded = np.concatenate([points, np.zeros(3, points.dtype)])
        for tail in CONTRACTIONS:
            fits = np.ones(len(marks), bool)
            for i, c in enumerate(tail, 1):
                fits &= (padded[marks + i] == ord(c)) & ~border[marks + i]
            out[marks[fits]] = S_SHORT if len(tail) == 1 else S_LONG
    out[firsts] += FIRST
    return out


def token_starts(symbol: np.ndarray) -> np.ndarray:
    """Where tokens start, by composing transition functions over stretches."""
    step, starts = automaton()
    n = len(symbol)
    rows = -(-n // STRETCH)
    padded = np.zeros(rows * STRETCH, np.uint8)
    padded[:n] = symbol
    base = np.ascontiguousarray(padded.reshape(rows, STRETCH).T).astype(np.intp) * 8
    function = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for column in base:
        function = step[column[:, None] + function]
    width = 1
    while width < rows:  # row r: the functions of all stretches up to r
        later = np.take_along_axis(function[width:], function[:-width].astype(np.intp), axis=1)
        function[width:] = later
        width *= 2
    state = np.full(rows, EMPTY, np.uint8)
    state[1:] = function[:-1, EMPTY]
    marks = np.zeros((STRETCH, rows), bool)
    for i, column in enumerate(base):
        at = column + state
        marks[i], state = starts[at], step[at]
    return np.flatnonzero(marks.T.reshape(-1)[:n])


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of every pre-token, first pre-token of every text)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    points, at = code_points(data, offsets)
    begins = offsets[:-1][offsets[1:] > offsets[:-1]]
    found = at[token_starts(symbols(points, np.searchsorted(at, begins)))]
    return found, np.searchsorted(found, offsets)


class Vocabulary(dict):
    """Byte strings to ids, read from a rank file; as a dict: pieces to their ids as little-endian bytes."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        size = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.lengths)])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.merge(piece), "<u4").tobytes()
        self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the adjacent pair of least rank is joined until none is known, the leftmost first."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n, ranks = len(piece), self.ranks
        behind, ahead = list(range(1, n + 1)), list(range(-1, n - 1))  # start of the next part, of the one before
        waiting = []
        for i in range(n - 1):
            rank = ranks.get(piece[i : i + 2])
            if rank is not None:
                waiting.append((rank, i, i + 2))
        heapq.heapify(waiting)
        alive = bytearray(b"\1") * n
        while waiting:
            _, i, end = heapq.heappop(waiting)
            j = behind[i]
            if not alive[i] or j >= n or behind[j] != end:
                continue  # one of the two parts has changed
            alive[j] = 0
            behind[i] = end
            if end < n:
                ahead[end] = i
                rank = ranks.get(piece[i : behind[end]])
                if rank is not None:
                    heapq.heappush(waiting, (rank, i, behind[end]))
            p = ahead[i]
            if p >= 0:
                rank = ranks.get(piece[p:end])
                if rank is not None:
                    heapq.heappush(waiting, (rank, p, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : behind[i]]])
            i = behind[i]
        return out

    def trim(self) -> None:
        if len(self) > CACHE_PIECES:
            self.clear()

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        starts, bounds = pieces(data, offsets)
        raw = data.tobytes()
        cuts = [*starts.tolist(), len(raw)]
        get, out, at = self.__getitem__, [], bounds.tolist()
        for a, b in zip(at, at[1:]):
            out.append(b"".join(map(get, [raw[x:y] for x, y in zip(cuts[a:b], cuts[a + 1 : b + 1])])))
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, end of each token in them)."""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        source = np.repeat(self.begins[ids] - (ends - sizes), sizes)
        source += np.arange(len(source))
        return self.bytes[source], ends


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _encoded(batches, text_at: int, path: str) -> Iterator[pa.RecordBatch]:
    own = vocabulary(path)
    for batch in batches:
        for block in arrays.text_blocks(batch, f"c{text_at}", BLOCK_BYTES):
            own.trim()
            ids = own.encode(*arrays.text_bytes(block.column(f"c{text_at}")))
            flat = np.frombuffer(b"".join(ids), "<u4")
            bounds = np.cumsum([0, *(len(x) // 4 for x in ids)])
            sizes = own.lengths[flat]
            ends = np.cumsum(sizes)
            base = np.concatenate([[0], ends])[bounds[:-1]]
            offsets = (ends - sizes - np.repeat(base, np.diff(bounds))).astype("<u4").tobytes()
            offsets = [offsets[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [*block.columns, pa.array(np.diff(bounds)), pa.array(ids, pa.binary()), pa.array(offsets, pa.binary())],
                names=[*block.schema.names, "n_tokens", "ids", "offsets"],
            )


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The documents' columns as c0, c1, ... with n_tokens, and ids and byte offsets as little-endian 32-bit integers."""
    names = docs.columns
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    more = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("offsets", T.BinaryType())]
    return rows.mapInArrow(partial(_encoded, text_at=names.index(text_col), path=path), T.StructType(rows.schema.fields + more))


def _decoded(batches, path: str) -> Iterator[pa.RecordBatch]:
    own = vocabulary(path)
    for batch in batches:
        for block in arrays.text_blocks(batch, "ids", BLOCK_BYTES):
            texts = [own.decode(np.frombuffer(x or b"", "<u4"))[0].tobytes() for x in block.column("ids").to_pylist()]
            kept = [c for c in block.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(block.column(c) for c in kept), pa.array(texts, pa.binary())], names=[*kept, "decoded"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Replace the ids column by the bytes that they stand for; a null counts as no ids."""
    fields = [f for f in encoded.schema.fields if f.name != "ids"]
    return encoded.mapInArrow(partial(_decoded, path=path), T.StructType([*fields, T.StructField("decoded", T.BinaryType())]))


def _round_trip(batches, path: str, with_ids: bool) -> Iterator[pa.RecordBatch]:
    own = vocabulary(path)
    for batch in batches:
        for block in arrays.text_blocks(batch, "text", BLOCK_BYTES):
            own.trim()
            ids = own.encode(*arrays.text_bytes(block.column("text")))
            text, ends = own.decode(np.frombuffer(b"".join(ids), "<u4"))
            counts = [len(x) // 4 for x in ids]
            cut = np.concatenate([[0], ends])[np.cumsum([0, *counts])].tolist()
            raw = text.tobytes()
            more = [pa.array(ids, pa.binary())] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(cut, cut[1:])], pa.string()),
                    *more,
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids],
            )


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Encode every text and decode it again in the same task: doc_id, n_tokens, digests of ids and bytes, the ids if wanted."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    fields = [plain.schema.fields[0], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    fields += [T.StructField("ids", T.BinaryType())] * with_ids
    return plain.mapInArrow(partial(_round_trip, path=path, with_ids=with_ids), T.StructType(fields))
