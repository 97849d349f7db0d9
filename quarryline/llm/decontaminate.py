"""Benchmark decontamination: an FM-index per shard of documents, searched for benchmark windows.

A shard is a block of texts inside a task.  Words are numbered by the benchmark's
vocabulary; all others end a run, and a run shorter than the shortest window can
hold none, so the index covers exactly what may match.  All windows are searched
backwards at once, their occurrences located from sampled positions and merged
into removal spans.  There is no shuffle: each document is read once.

The benchmark goes to the tasks in parts of about `PART_BYTES` of text, one pass over
the running result for each part, which is written in between, so that the driver and the
tasks hold the windows of one part at a time.  A part is never less than an item.

Defined results: null and empty texts have no words and no hits; items without
words have no window; an item id that repeats counts once; a null item id is the
empty string.  Columns of the documents pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from . import arrays
from .fmindex import FMIndex

WINDOW = 13
#: Bytes of benchmark text sent to the tasks at a time.
PART_BYTES = 16 << 20
SHARD_BYTES = 4 << 20

_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("word_spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


class Windows:
    """The distinct windows of some benchmark items over a vocabulary of word hashes."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        data, offsets = arrays.text_bytes(pa.array([t for _, t in items], pa.string()))
        data = arrays.lowered(data)
        starts, ends, bounds = arrays.runs(data, offsets, arrays.WORD_CHARS)
        hashes = arrays.span_hashes(data, starts, ends)
        self.vocabulary = np.unique(hashes)
        symbols = np.searchsorted(self.vocabulary, hashes) + 1
        of: dict[tuple, set[str]] = {}
        for (name, _), a, b in zip(items, bounds, bounds[1:]):
            own = symbols[a:b].tolist()
            for i in range(max(1, len(own) - window + 1) if own else 0):
                of.setdefault(tuple(own[i : i + window]), set()).add(name)
        self.lengths = np.array([len(w) for w in of], np.int64)
        self.phrases = np.zeros((len(of), window), np.int64)
        for row, w in enumerate(of):
            self.phrases[row, window - len(w) :] = w
        self.names = [sorted(v) for v in of.values()]
        self.shortest = int(self.lengths.min()) if len(of) else 0

    def number(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words; 0 for words of no item."""
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at + 1, 0)


def occurrences(symbols: np.ndarray, rows: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """(window, first word) of all occurrences within the texts of a shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(windows.lengths) or not len(symbols):
        return none
    inside = symbols > 0
    cut = np.ones(len(symbols) + 1, bool)
    cut[1:-1] = (inside[1:] != inside[:-1]) | (rows[1:] != rows[:-1])
    edge = np.flatnonzero(cut)
    starts, ends = edge[:-1], edge[1:]
    fit = inside[starts] & (ends - starts >= windows.shortest)
    starts, sizes = starts[fit], (ends - starts)[fit]
    if not len(starts):
        return none
    # Runs one behind the other, a 0 after each.
    at = np.concatenate([[0], np.cumsum(sizes + 1)])
    text, place = np.zeros(at[-1], np.int64), np.zeros(at[-1], np.int64)
    source = np.repeat(starts - at[:-1], sizes + 1) + np.arange(at[-1])
    body = np.ones(at[-1], bool)
    body[at[1:] - 1] = False
    text[body], place[body] = symbols[source[body]], source[body]
    index = FMIndex(text, len(windows.vocabulary) + 1)
    low, high = index.ranges(windows.phrases, windows.lengths)
    counts = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return which, place[index.locate(np.repeat(low, counts) + inner)]


def _merged(cover: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of the runs of covered words, cut at text borders."""
    before = np.zeros_like(cover)
    before[1:] = cover[:-1]
    before[bounds[:-1][bounds[:-1] < len(cover)]] = False
    after = np.zeros_like(cover)
    after[:-1] = cover[1:]
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(cover & ~before), np.flatnonzero(cover & ~after) + 1
    return np.searchsorted(bounds, starts, side="right") - 1, starts, ends


def _search(batches, text_at: int, windows: Windows, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in arrays.text_blocks(batch, f"c{text_at}", shard_bytes):
            yield _search_shard(block, text_at, windows)


def _search_shard(block: pa.RecordBatch, text_at: int, windows: Windows) -> pa.RecordBatch:
    raw, offsets = arrays.text_bytes(block.column(f"c{text_at}"))
    data = arrays.lowered(raw)
    starts, ends, bounds = arrays.runs(data, offsets, arrays.WORD_CHARS)
    rows = arrays.row_of(bounds)
    which, first = occurrences(windows.number(arrays.span_hashes(data, starts, ends)), rows, windows)
    steps = np.zeros(len(starts) + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + windows.lengths[which], -1)
    items: dict[int, set[str]] = {}
    for row, w in zip(rows[first].tolist(), which.tolist()):
        items.setdefault(row, set()).update(windows.names[w])
    if "word_spans" in block.schema.names:  # what earlier parts of the benchmark found
        for row, (spans, names) in enumerate(zip(block.column("word_spans").to_pylist(), block.column("items").to_pylist())):
            for a, b in spans:
                steps[bounds[row] + a] += 1
                steps[bounds[row] + b] -= 1
            if names:
                items.setdefault(row, set()).update(names)
    cover = np.cumsum(steps[:-1]) > 0
    n_hit = arrays.segment_sums(cover.astype(np.int64), bounds)
    spans: list[list] = [[] for _ in range(block.num_rows)]
    word_spans: list[list] = [[] for _ in range(block.num_rows)]
    for row, a, b in zip(*(x.tolist() for x in _merged(cover, bounds))):
        base = offsets[row]
        head = len(bytes(raw[base : starts[a]]).decode("utf-8", "replace"))
        spans[row].append([head, head + len(bytes(raw[starts[a] : ends[b - 1]]).decode("utf-8", "replace"))])
        word_spans[row].append([a - int(bounds[row]), b - int(bounds[row])])
    kept = [n for n in block.schema.names if n[0] == "c" and n[1:].isdigit()]
    pairs = pa.list_(pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [
            *(block.column(n) for n in kept),
            pa.array(np.diff(bounds)),
            pa.array(n_hit),
            pa.array([sorted(items.get(r, ())) for r in range(block.num_rows)], pa.list_(pa.string())),
            pa.array(spans, pairs),
            pa.array(word_spans, pairs),
        ],
        names=[*kept, "n_words", "n_hit", "items", "spans", "word_spans"],
    )


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, part_bytes: int = PART_BYTES
) -> DataFrame:
    """The documents' columns as c0, c1, ... with n_words, n_hit, items (sorted as strings) and removal spans.

    spans: [first, behind the last] character of each merged stretch of hit words; word_spans: the same in words.
    """
    names = docs.columns
    text_at = names.index(text_col)
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema = T.StructType(rows.schema.fields + _FOUND.fields)
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.col(f"`{item_text_col}`").alias("body"))
    size = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(parts)) == part).collect()
        search = partial(_search, text_at=text_at, windows=Windows([tuple(r) for r in own], window), shard_bytes=SHARD_BYTES)
        rows = rows.mapInArrow(search, schema)
        if part + 1 < parts:  # so the driver and the tasks hold the windows of one part at a time
            rows = written(rows, "found")
    return rows


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", rule=None) -> DataFrame:
    """The documents that are not contaminated, with their columns."""
    found = find_contamination(docs, benchmark, text_col)
    rule = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")) if rule is None else rule
    return found.where(~rule).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def strip_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """All documents, with the removal spans cut out of their texts."""
    found = find_contamination(docs, benchmark, text_col)
    at = docs.columns.index(text_col)
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("spans", lambda s: s[1]))
    starts = F.concat(F.transform("spans", lambda s: s[0]), F.array(F.char_length(f"c{at}").cast("long")))
    pieces = F.zip_with(ends, starts, lambda a, b: F.substring(F.col(f"c{at}"), a.cast("int") + 1, (b - a).cast("int")))
    text = F.when(F.size("spans") > 0, F.array_join(pieces, "")).otherwise(F.col(f"c{at}"))
    return found.select(*[(text if i == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return find_contamination(plain, benchmark).select(
        F.col("c0").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
