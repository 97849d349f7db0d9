"""Exact duplicates: compressed radix tries whose terminals hold the owner of each text.

Every text is inserted in full, under a key of its length and content hash.  A
task first merges the copies it reads itself, so a hot text leaves it as one
row; rows with the same length and hash then meet in one partition, in order,
where a second trie compares whole byte strings.  A trie that passes its memory
bound spills whole subtrees: before the exchange any subtree may go (the same
text may then leave the task twice), after it only those whose keys are over.

Defined results: a null text counts as an empty one; a null id is smaller than
any other; of rows with equal text and equal id the one with the greatest other
columns is the owner.  Other columns travel with their row, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of keys that a trie holds before it spills subtrees.
TRIE_BYTES = 48 << 20


class _Node:
    __slots__ = ("label", "children", "value")

    def __init__(self, label: bytes, value=None):
        self.label, self.value, self.children = label, value, {}


class RadixTrie:
    """A compressed radix (Patricia) trie from byte strings to values, merged by `merge`."""

    def __init__(self, merge):
        self.root, self.merge, self.bytes = _Node(b""), merge, 0

    def insert(self, key: bytes, value) -> None:
        """Add a value under the whole key; equal keys share a terminal."""
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = _Node(key[at:], value)
                self.bytes += len(key) - at + 200
                return
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, key, at)
            fork = _Node(label[:same])
            fork.children[label[same]] = child
            child.label = label[same:]
            node.children[key[at]] = fork
            self.bytes += 200
            node, at = fork, at + same
        node.value = value if node.value is None else self.merge(node.value, value)

    def spill(self, keep: bytes | None = None) -> Iterator[tuple[bytes, object]]:
        """Take out the terminals of the subtrees at the top; the one that `keep` leads into stays."""
        node, path = self.root, b""
        while len(node.children) == 1 and node.value is None:
            child = next(iter(node.children.values()))
            if keep is not None and not keep.startswith(path + child.label):
                break
            if not child.children:
                break
            node, path = child, path + child.label
        for first, child in list(node.children.items()):
            if keep is not None and keep.startswith(path + child.label[: max(1, len(keep) - len(path))]):
                continue
            yield from _terminals(child, path)
            del node.children[first]
            self.bytes -= _size(child)

    def drain(self) -> Iterator[tuple[bytes, object]]:
        yield from _terminals(self.root, b"")
        self.root, self.bytes = _Node(b""), 0


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common part of `label` and key[at:]; they differ somewhere."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(label[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def _terminals(node: _Node, path: bytes) -> Iterator[tuple[bytes, object]]:
    stack = [(node, path)]
    while stack:
        node, path = stack.pop()
        path += node.label
        if node.value is not None:
            yield path, node.value
        stack.extend((child, path) for child in node.children.values())


def _size(node: _Node) -> int:
    total, stack = 0, [node]
    while stack:
        node = stack.pop()
        total += len(node.label) + 200
        stack.extend(node.children.values())
    return total


def _newer(largest: bool, a: tuple, b: tuple) -> tuple:
    """The owner of two (order, row, copies), with the copies of both."""
    owner = (a if a[0] >= b[0] else b) if largest else (a if a[0] <= b[0] else b)
    return owner[0], owner[1], a[2] + b[2]


def _trie_rows(batches, id_at: int, text_at: int, columns: int, largest: bool, sorted_input: bool, bound: int):
    """Arrow batches to Arrow batches (length, digest, copies, c0, c1, ...), one row per text."""
    trie = RadixTrie(partial(_newer, largest))
    schema, last = None, None

    def table(found) -> pa.RecordBatch:
        rows = list(found)
        fields = [pa.field("length", pa.int64()), pa.field("digest", pa.binary()), pa.field("copies", pa.int64())]
        fields += [schema.field(f"c{i}") for i in range(columns)]
        texts = [key[40:] for key, _ in rows]
        arrays = [
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([key[8:40] for key, _ in rows], pa.binary()),
            pa.array([v[2] for _, v in rows], pa.int64()),
        ]
        for i in range(columns):
            kind = schema.field(f"c{i}").type
            if i == text_at:
                arrays.append(pa.array(texts, pa.large_binary()).cast(kind))
            else:
                arrays.append(pa.array([v[1][i] for _, v in rows], kind))
        return pa.RecordBatch.from_arrays(arrays, schema=pa.schema(fields))

    def chunks(found):
        part, size = [], 0
        for key, value in found:
            part.append((key, value))
            size += len(key)
            if len(part) >= 2000 or size > 8 << 20:
                yield table(part)
                part, size = [], 0
        if part:
            yield table(part)

    for batch in batches:
        schema = batch.schema
        # One text object at a time: a batch may hold far more bytes than the trie may.
        text_column = batch.column(f"c{text_at}").cast(pa.large_binary())
        others = [None if i == text_at else batch.column(f"c{i}").to_pylist() for i in range(columns)]
        copies = batch.column("copies").to_pylist() if sorted_input else None
        for r in range(batch.num_rows):
            text = text_column[r].as_py() or b""
            row = tuple(None if i == text_at else others[i][r] for i in range(columns))
            own = row[id_at]
            rank = tuple((v is not None, repr(v)) for i, v in enumerate(row) if i not in (id_at, text_at))
            head = len(text).to_bytes(8, "big") + hashlib.sha256(text).digest()
            if sorted_input and head != last:
                # The keys come in order: what lies under other heads is over.
                if trie.bytes > bound // 8:
                    yield from chunks(trie.spill(keep=head))
                last = head
            trie.insert(head + text, (((own is not None, own if own is not None else 0), rank), row, copies[r] if copies else 1))
            if not sorted_input and trie.bytes > bound:
                yield from chunks(trie.spill())
    if schema is not None:
        yield from chunks(trie.drain())


def owner_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per text: length, digest, copies, and the owner's own columns as c0, c1, ... in their order."""
    names = docs.columns
    at = names.index(id_col), names.index(text_col)
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema = T.StructType(
        [T.StructField("length", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("copies", T.LongType())]
        + [T.StructField(f.name, f.dataType) for f in plain.schema.fields]
    )
    # Bound late: Spark ships this module's functions to the tasks by name.
    local = plain.mapInArrow(partial(_trie_rows, id_at=at[0], text_at=at[1], columns=len(names), largest=largest, sorted_input=False, bound=trie_bytes), schema)
    met = local.repartition("length", "digest").sortWithinPartitions("length", "digest")
    return met.mapInArrow(partial(_trie_rows, id_at=at[0], text_at=at[1], columns=len(names), largest=largest, sorted_input=True, bound=trie_bytes), schema)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """The owner row of every text, with the columns of `docs`.  A null text comes back empty."""
    rows = owner_rows(docs, id_col, text_col, largest)
    return rows.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", largest: bool = True) -> DataFrame:
    """Every row's (doc_id, keep_id, group_size, kept, text_sha256).

    Rows that share both id and text are one document: each of them is marked kept
    where their id is.  A hot text is one row of owners; adaptive execution splits
    the documents' side of the join.
    """
    plain = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    owners = owner_rows(plain, "doc_id", "text", largest).select(
        F.lower(F.hex("digest")).alias("text_sha256"), F.col("length"), F.col("c0").alias("keep_id"), F.col("copies").alias("group_size")
    )
    members = plain.select("doc_id", F.sha2("text", 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("length"))
    return members.join(owners, ["text_sha256", "length"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
