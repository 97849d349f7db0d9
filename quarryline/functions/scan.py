"""Lexical state of source files: which characters are code, and how deep brackets are nested there.

A file is read by a small automaton (code, strings, comments).  Where it stands at a byte
depends on all bytes before, but what a stretch of bytes does is a map from states to states, and maps compose: each
stretch of all texts of a batch is mapped side by side, the maps are composed by doubling, and a second pass from the
now known states marks every byte.  Nothing is read byte by byte in Python, and a long file costs no more a byte
than a short one.

Python has comments and strings in one or three quotes; the brace languages have both kinds of comments, strings and
back-quoted text.  Regular expression literals are not told from divisions.  An unfinished string ends with its line,
unfinished text of another kind with the file.  Any other language is all code and not nested.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CHUNK_SIZE, LANGUAGE_SEPARATORS
from . import code
from .slices import in_slices
from .text import col

PYTHON = ["python"]
BRACES = ["javascript", "java", "cpp", "c", "objective-c", "go"]
STRETCH = 64
NOTHING = 256  # beyond a text's end; changes no state
MASK = "\x01"
_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("level", T.IntegerType())])


# --- automata ------------------------------------------------------------------------
def _table(states: int, rules: dict[int, tuple[int, dict[str, int]]]) -> np.ndarray:
    """Next state by (byte, state): a state's rules are what else leads to, and where single characters lead."""
    table = np.tile(np.arange(states, dtype=np.uint8), (NOTHING + 1, 1))
    for state, (otherwise, single) in rules.items():
        table[:NOTHING, state] = otherwise
        for char, then in single.items():
            table[ord(char), state] = then
    return table


@cache
def _python() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = {"'": 2, '"': 10, "#": 1}
    rules = {0: (0, start), 1: (1, {"\n": 0})}
    ends = np.zeros(18, np.int64)  # the character that ends a state's text and belongs to it
    long = np.zeros(18, bool)
    long[1] = True
    for quote, at in (("'", 2), ('"', 10)):
        one, two, inside, escape, triple, t1, t2, t_escape = range(at, at + 8)
        rules |= {
            one: (inside, {quote: two, "\\": escape, "\n": 0}), two: (0, start | {quote: triple}),
            inside: (inside, {quote: 0, "\\": escape, "\n": 0}), escape: (inside, {}),
            triple: (triple, {quote: t1, "\\": t_escape}), t1: (triple, {quote: t2, "\\": t_escape}),
            t2: (triple, {quote: 0, "\\": t_escape}), t_escape: (triple, {}),
        }
        ends[[inside, t2]] = ord(quote)
        long[triple : t_escape + 1] = True
    return _table(18, rules), ends, long


@cache
def _braces() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    start = {"/": 1, "'": 5, '"': 7, "`": 9}
    rules = {0: (0, start), 1: (0, start | {"/": 2, "*": 3}), 2: (2, {"\n": 0}), 3: (3, {"*": 4}), 4: (3, {"*": 4, "/": 0})}
    for quote, at in (("'", 5), ('"', 7)):
        rules |= {at: (at, {quote: 0, "\\": at + 1, "\n": 0}), at + 1: (at, {})}
    rules |= {9: (9, {"`": 0, "\\": 10}), 10: (9, {})}
    ends, long = np.zeros(11, np.int64), np.zeros(11, bool)
    ends[[4, 5, 7, 9]] = [ord(c) for c in "/'\"`"]
    long[[2, 3, 4, 9, 10]] = True
    return _table(11, rules), ends, long


def _states(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The state after each byte; every text starts in state 0."""
    sizes = np.diff(offsets)
    parts = np.maximum(1, -(-sizes // STRETCH))
    text = np.repeat(np.arange(len(sizes)), parts)
    first = np.repeat(np.cumsum(parts) - parts, parts)
    place = np.arange(len(text)) - first
    at = (offsets[:-1][text] + place * STRETCH)[:, None] + np.arange(STRETCH)
    inside = at < offsets[1:][text][:, None]
    rows = np.full(at.shape, NOTHING, np.int64)
    rows[inside] = data[at[inside]]
    maps = np.tile(np.arange(table.shape[1], dtype=np.uint8), (len(text), 1))
    for i in range(STRETCH):
        maps = table[rows[:, i][:, None], maps]
    step = 1
    while step <= place.max(initial=0):
        later = np.flatnonzero(place >= step)
        maps[later] = np.take_along_axis(maps[later], maps[later - step].astype(np.int64), axis=1)
        step *= 2
    state = np.zeros(len(text), np.uint8)
    state[1:] = np.where(place[1:] > 0, maps[:-1, 0], 0)
    out = np.empty(at.shape, np.uint8)
    for i in range(STRETCH):
        state = table[rows[:, i], state]
        out[:, i] = state
    return out[inside]


def scan(data: np.ndarray, offsets: np.ndarray, family: str) -> tuple[np.ndarray, np.ndarray]:
    """(part, depth) of each byte: 0 code, 1 string in single quotes, 2 comment or text over lines; open brackets in code."""
    part, depth = np.zeros(len(data), np.uint8), np.zeros(len(data), np.int64)
    if family == "other" or not len(data):
        return part, depth
    table, ends, long = _python() if family == "python" else _braces()
    after = _states(data, offsets, table)
    before = np.r_[np.uint8(0), after[:-1]]
    before[offsets[:-1][offsets[:-1] < len(data)]] = 0
    open_state = after >= (1 if family == "python" else 2)
    closing = (after == 0) & (ends[before] == data) & (ends[before] > 0)
    part[open_state | closing] = 1
    part[(open_state & long[after]) | (closing & long[before])] = 2
    if family != "python":  # the slash in front of a comment
        slash = np.flatnonzero((after[:-1] == 1) & (before[1:] == 1) & ((after[1:] == 2) | (after[1:] == 3)))
        part[slash] = 2
    change = (np.isin(data, list(b"([{")).astype(np.int64) - np.isin(data, list(b")]}"))) * (part == 0)
    total = np.cumsum(change)
    base = np.r_[0, total][offsets[:-1]]
    return part, total - np.repeat(base, np.diff(offsets))


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    held = [t.encode() if t else b"" for t in texts.to_pylist()]
    return np.frombuffer(b"".join(held), np.uint8), np.r_[0, np.cumsum([len(h) for h in held], dtype=np.int64)]


def _by_family(texts: pa.Array, langs: pa.Array):
    """(places, data, offsets, family) of the texts of each family."""
    names = langs.to_pylist()
    family = np.array(["python" if n in PYTHON else "braces" if n in BRACES else "other" for n in names])
    for name in np.unique(family):
        places = np.flatnonzero(family == name)
        yield places, *_flat(texts.take(pa.array(places))), str(name)


# --- masked text -----------------------------------------------------------------------
def _masked(least: int):
    def slice_of(texts: pa.Array, langs: pa.Array) -> pa.Array:
        out = [None] * len(texts)
        for places, data, offsets, family in _by_family(texts, langs):
            part, _ = scan(data, offsets, family)
            hidden = part >= least
            shown = np.where(hidden & (data != 10), ord(MASK), data)
            kept = ~(hidden & ((data & 0xC0) == 0x80))  # one mask a character
            cut = np.r_[0, np.cumsum(kept)][offsets]
            body = shown[kept].astype(np.uint8).tobytes()
            for i, a, b in zip(places, cut, cut[1:]):
                out[i] = body[a:b].decode()
        return pa.array([o if t is not None else None for o, t in zip(out, texts.to_pylist())], pa.string())

    @F.arrow_udf(T.StringType())
    def mask(texts: pa.Array, langs: pa.Array) -> pa.Array:
        return in_slices(slice_of, texts, langs)

    return mask


_mask_all, _mask_long = _masked(1), _masked(2)


def only_code(text: Column | str, lang: Column | str) -> Column:
    """The text with every character of a string or comment masked; line breaks and length stay."""
    return _mask_all(col(text), col(lang))


def without_comments(text: Column | str, lang: Column | str) -> Column:
    """The text with comments, and strings that may run over lines, masked; strings on one line stay."""
    return _mask_long(col(text), col(lang))


def code_functions(text: Column | str, lang: Column | str) -> Column:
    """Function names, as `code.functions` finds them, in code only."""
    return code.functions(only_code(text, lang), lang)


def code_imports(text: Column | str, lang: Column | str) -> Column:
    """Import targets outside comments; Python's also outside all strings, as no target is one there."""
    shown = F.when(col(lang).isin(*PYTHON), only_code(text, lang)).otherwise(without_comments(text, lang))
    return code.imports(shown, lang)


def code_complexity(text: Column | str, lang: Column | str) -> Column:
    """1 plus the number of branch words in code."""
    return code.complexity(only_code(text, lang))


# --- cutting -----------------------------------------------------------------------------
def _cuts(data: np.ndarray, part: np.ndarray, depth: np.ndarray, starts: list[bytes]) -> list[np.ndarray]:
    """Where a text may be cut, in characters: before an outermost declaration, outside brackets, outside strings."""
    lines = np.flatnonzero((data == 10) & (part == 0)) + 1
    lines = lines[lines < len(data)]
    outer = lines[depth[lines - 1] <= 0]
    raw = data.tobytes()
    declared = np.array([p for p in outer.tolist() if any(raw.startswith(s, p) for s in starts)], np.int64)
    chars = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    return [chars[c] for c in (declared, outer, lines)]


def nested_spans(data: np.ndarray, part: np.ndarray, depth: np.ndarray, starts: list[bytes], size: int) -> list[tuple[int, int, int]]:
    """(start, end, level) in characters.  Each span takes what fits up to the last cut of the best level there is."""
    cuts = _cuts(data, part, depth, starts)
    length = int(((data & 0xC0) != 0x80).sum())
    spans, at = [], 0
    while length - at > size:
        for level, places in enumerate(cuts):
            i = int(np.searchsorted(places, at + size, side="right")) - 1
            if i >= 0 and places[i] > at:
                end = int(places[i])
                break
        else:
            level, end = 3, at + size
        spans.append((at, end, level))
        at = end
    return [*spans, (at, length, 0)] if length else []


def nested_chunks(text: Column | str, lang: Column | str, size: int = CHUNK_SIZE) -> Column:
    """Spans that part a text without gaps or overlap, `size` characters at most.

    The level tells where a span ends: 0 before an outermost declaration of its language or with the text, 1 at a
    line end outside brackets, 2 at one inside brackets, 3 anywhere, where `size` characters hold no better place.  Levels 0
    to 2 are never inside a string or comment.
    """
    marks = {name: [s[1:].encode() for s in own] for name, own in LANGUAGE_SEPARATORS.items()}

    def slice_of(texts: pa.Array, langs: pa.Array) -> pa.Array:
        names, out = langs.to_pylist(), [[] for _ in range(len(texts))]
        for places, data, offsets, family in _by_family(texts, langs):
            part, depth = scan(data, offsets, family)
            for i, a, b in zip(places.tolist(), offsets.tolist(), offsets[1:].tolist()):
                spans = nested_spans(data[a:b], part[a:b], depth[a:b], marks.get(names[i], []), size)
                out[i] = [{"start": s, "end": e, "level": v} for s, e, v in spans]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("level", pa.int32())]))
        return pa.array(out, kind)

    @F.arrow_udf(T.ArrayType(_SPAN))
    def cut(texts: pa.Array, langs: pa.Array) -> pa.Array:
        return in_slices(slice_of, texts, langs)

    return cut(col(text), col(lang))
