"""Language-model scores from sharded Elias-Fano n-gram tries, of any order.

The model is interpolated: P(w | h) = (1 - l) c(h, w) / c(h) + l P(w | h without its first
word, down to P1(w) = (c(w) + 1) / (N + V + 1).  With `counted` the weight is that of Witten and
Bell, l = t / (c(h) + t), with the context's t distinct successors in the training texts;
else it follows from the context's count.  A text's first words have shorter contexts.

1. Texts become blocks of tokens, written once to the shared folder as a table in buckets, so
   that only answers are exchanged to meet them.
2. The blocks' distinct words go to word shards, whose sums come back to the blocks.
3. For each order from 2 on, the blocks' distinct n-grams go to shards by context; a context
   with more than a shard's share of all tokens is split by its successors.  Each shard builds
   a trie of its n-grams of training texts, maps it into memory, and searches it for the
   n-grams of all texts.  The counts come back to the blocks, which score their texts.  A
   context's parts are disjoint by successor, so a block adds up their distinct successors.

An n-gram is not sent if the order below tells its count: words or n-grams that only this block
has make it one that only this block has, and a part that training texts lack makes it unseen.
With `counted` its context is still asked for, with the number of successors only this block has.
Nothing goes through the driver but N and V.  The number of shards follows the corpus, so a
shard's arrays stay the same size.  Words are 64-bit hashes, and those that are sent in n-grams
have numbers, small for frequent ones, which the word shards deal out; a context's successors go
as differences of their numbers.  Within a shard contexts are 48-bit fingerprints.

Defined results: a null text counts as empty and has one token, the end; a row with
null id is scored like any other; without training texts every token is unknown.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path, written
from . import arrays
from .eliasfano import NgramTrie

#: Bytes of text of a block, and tokens or distinct words of a shard.
BLOCK_BYTES, SHARD_TOKENS = 7 << 20, 1_500_000
#: Without counted successors the weight of the shorter context is (HELD + SPREAD * c ** HEAPS) / (c + HELD).
HELD, SPREAD, HEAPS = 2.0, 0.9, 0.95
_STEP = np.uint64(0x9E3779B97F4A7C15)
END, BEGIN = np.uint64(0xE17D_0000_0000_0001), np.uint64(0xBE61_0000_0000_0001)


def pack(*columns: np.ndarray) -> bytes:
    """Arrays as bytes: planes of equal significance, compressed."""
    head, body = [], []
    for c in columns:
        c = np.ascontiguousarray(c)
        head += [c.dtype.itemsize, len(c)]
        body.append(c.view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() if len(c) else b"")
    first = np.array([len(columns), *head], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(first + b"".join(body))


def unpack(data: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    count = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 2 * count, 8).reshape(-1, 2)
    at, out = 8 + 16 * count, []
    for (width, n), kind in zip(head.tolist(), kinds):
        planes = np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += width * n
    return out


def backoff(count: np.ndarray) -> np.ndarray:
    """The shorter context's weight after a context of this count; 1 after an unseen one."""
    return np.minimum(1.0, (HELD + SPREAD * np.power(count, HEAPS)) / (count + HELD))


def counted_weight(count: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """That of Witten and Bell; 1 after a context that is unseen or, if it shares its fingerprint, without a successor of its own."""
    return np.where((count > 0) & (distinct > 0), distinct / np.maximum(count + distinct, 1), 1.0)


def steps(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Differences within each ascending run of the given sizes, a run's first value as it is."""
    out = np.diff(values, prepend=0)
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    out[first] = values[first]
    return out


def from_steps(out: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.cumsum(out.astype(np.int64))
    first = (np.cumsum(sizes, dtype=np.int64) - sizes)[sizes > 0]
    return total - np.repeat(total[first] - out[first], sizes[sizes > 0])


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (arrays.mix(keys ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(shards)).astype(np.int64)


def order_of(keys: np.ndarray) -> np.ndarray:
    """Stable order of whole numbers from 0; sorting key and place as one number is faster, where they fit."""
    bits = len(keys).bit_length()
    if not len(keys) or int(keys.max()).bit_length() + bits > 63:
        return np.argsort(keys, kind="stable")
    both = keys.astype(np.int64) << bits | np.arange(len(keys))
    both.sort()
    return both & ((1 << bits) - 1)


def distinct_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct key comes first, in order of the keys, and the place of each entry among them."""
    order = order_of(keys)
    key = keys[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    place = np.empty(len(key), np.int32)
    place[order] = np.cumsum(new, dtype=np.int32) - 1
    return order[new], place


def shard_order(of: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Stable order by shard, then by keys of 48 bits: by as many of their bits as fit, if these tell all apart."""
    drop = max(0, len(of).bit_length() + int(of.max(initial=0)).bit_length() + 48 - 63)
    if drop < 48:
        order = order_of(of << (48 - drop) | (keys >> np.uint64(drop)).astype(np.int64))
        same, key = np.diff(of[order]) == 0, keys[order]
        if not (same & (key[1:] < key[:-1])).any():
            return order
    return np.lexsort((keys, of))


def _cuts(order_keys: np.ndarray) -> list[tuple[int, int, int]]:
    """(key, from, to) of the runs of an ordered array."""
    if not len(order_keys):
        return []
    at = np.flatnonzero(np.concatenate([[True], order_keys[1:] != order_keys[:-1]])).tolist()
    return [(int(order_keys[a]), a, b) for a, b in zip(at, [*at[1:], len(order_keys)])]


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """(block, n_words, ids, held_out, tokens): the distinct words' hashes and training counts, each text's words."""
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for block in arrays.text_blocks(batch, "text", BLOCK_BYTES):
            data, offsets = arrays.text_bytes(block.column("text"))
            data = arrays.lowered(data)
            starts, ends, bounds = arrays.runs(data, offsets, arrays.NOT_SPACE)
            n = block.num_rows
            rows = arrays.row_of(bounds)
            stream = np.full(len(starts) + n, END, np.uint64)
            stream[np.arange(len(starts)) + rows] = arrays.span_hashes(data, starts, ends)
            words, index, uses = np.unique(stream, return_inverse=True, return_counts=True)
            # Frequent words get small numbers, and words used alike follow each other by hash: both pack better.
            order = np.argsort(-np.floor(np.log2(uses)), kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            words, index = words[order], rank[index]
            held = block.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            sizes = np.diff(bounds) + 1
            training = np.bincount(index[~np.repeat(held, sizes)], minlength=len(words))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([len(words)], pa.int64()),
                    pa.array([len(stream)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), block.column("doc_id")),
                    pa.array([pack(held)], pa.binary()),
                    pa.array([pack(words)], pa.binary()),
                    pa.array([pack(training.astype("<u4"))], pa.binary()),
                    pa.array([pack(sizes.astype("<u4"), index.astype("<u4"))], pa.binary()),
                ],
                names=["block", "n_words", "n_tokens", "ids", "held_out", "words", "training", "tokens"],
            )
            number += 1


def _send_words(batches, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in range(batch.num_rows):
            (words,) = unpack(batch.column("words")[r].as_py(), "<u8")
            (training,) = unpack(batch.column("training")[r].as_py(), "<u4")
            of = shard_of(words, shards)
            order = order_of(of)
            cuts = _cuts(of[order])
            words, training = words[order], training[order]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([c[0] for c in cuts], pa.int64()),
                    pa.array([batch.column("block")[r].as_py()] * len(cuts), pa.int64()),
                    pa.array([pack(words[a:b], training[a:b]) for _, a, b in cuts], pa.binary()),
                ],
                names=["shard", "block", "payload"],
            )


def _by_shard(batches) -> Iterator[tuple[int, list[tuple]]]:
    """The rows of each shard of a sorted partition, one shard at a time."""
    held, shard = [], None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in batch.schema.names]
        for row in zip(*columns):
            if row[0] != shard and held:
                yield shard, held
                held = []
            shard = row[0]
            held.append(row)
    if held:
        yield shard, held


def _sum_words(batches, shards: int) -> Iterator[pa.RecordBatch]:
    """Answers (shard, block, distinct, total, payload): the sums of each block's words, in the order they came in, whether no other block has them, and else their numbers."""
    for shard, rows in _by_shard(batches):
        sent = [unpack(payload, "<u8", "<u4") for _, _, payload in rows]
        every, index = np.unique(np.concatenate([w for w, _ in sent]), return_inverse=True)
        total = np.bincount(index, weights=np.concatenate([c for _, c in sent]), minlength=len(every)).astype(np.int64)
        sole = np.bincount(index, minlength=len(every)) == 1
        # Numbers of all shards are distinct; a word that is not sent has none.
        order = np.argsort(np.where(sole, 0, -total), kind="stable")
        number = np.empty(len(every), np.int64)
        number[order] = np.arange(len(every)) * shards + shard
        number[sole | (total == 0)] = 0
        at = np.cumsum([0, *(len(w) for w, _ in sent)])
        first = [True] + [False] * (len(rows) - 1)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(rows), pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([int((total > 0).sum()) if f else 0 for f in first], pa.int64()),
                pa.array([int(total.sum()) if f else 0 for f in first], pa.int64()),
                pa.array([pack(total[index[a:b]].astype("<u8"), sole[index[a:b]], number[index[a:b]].astype("<u4")) for a, b in zip(at, at[1:])], pa.binary()),
            ],
            names=["shard", "block", "distinct", "total", "payload"],
        )


class Block:
    """A block's texts: the n-grams of the order reached, their counts and probabilities."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray, index: np.ndarray, held: np.ndarray, by_successors: bool):
        self.by_successors = by_successors
        self.words, self.sizes = words, sizes.astype(np.int64)
        lengths = self.sizes + 1  # with the begin
        self.bounds = np.concatenate([[0], np.cumsum(lengths)])
        self.place = (np.arange(self.bounds[-1]) - np.repeat(self.bounds[:-1], lengths)).astype(np.int32)
        self.stream = np.full(len(self.place), len(words), np.int32)
        self.stream[self.place > 0] = index
        self.training = ~np.repeat(held, lengths)
        self.order, self.gram, self.keys = 1, self.stream, np.append(words, BEGIN)

    def words_known(self, answers: list[bytes], word_shards: int, total: int, distinct: int, begins: int) -> None:
        order = order_of(shard_of(self.words, word_shards))
        parts = [unpack(p, "<u8", "?", "<u4") for p in answers]
        self.number = np.zeros(len(self.words), np.int64)
        self.number[order] = np.concatenate([n for _, _, n in parts])
        self.rank = np.empty(len(self.words), np.int64)
        self.rank[order_of(self.number)] = np.arange(len(self.words))
        self.count, self.sole = np.zeros(len(self.words) + 1, np.int64), np.zeros(len(self.words) + 1, bool)
        self.count[order] = np.concatenate([c for c, _, _ in parts]).astype(np.int64)
        self.sole[order] = np.concatenate([s for _, s, _ in parts])
        self.count[-1] = begins
        self.p = (self.count + 1) / (total + distinct + 1)
        self.log_p = np.log10(self.p)[self.stream]
        self.base, self.known = self.sums(self.log_p), self.sums((self.count > 0)[self.stream])

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text's words."""
        return arrays.segment_sums(np.where(self.place > 0, values, 0), self.bounds)

    def extend(self, shards: int, total: int, send: bool = True) -> list[tuple[int, bytes]]:
        """Go to the n-grams of the next order; (shard, payload) of what has to be counted, unless it was sent before."""
        self.order += 1
        self.ends = np.flatnonzero(self.place >= self.order - 1)
        before = self.gram[self.ends - 1]
        first, self.index = distinct_of(before.astype(np.int64) * (len(self.words) + 1) + self.stream[self.ends])
        self.prefix, self.suffix, self.last = before[first], self.gram[self.ends[first]], self.stream[self.ends[first]]
        self.local = np.bincount(self.index[self.training[self.ends]], minlength=len(first))
        open_ = (self.count > 0) & ~self.sole
        self.sent = np.flatnonzero(open_[self.prefix] & open_[self.suffix])
        # Distinct successors that only this block can count.
        alone = self.local > 0
        alone[self.sent] = False
        self.successors = np.bincount(self.prefix[alone], minlength=len(self.count))
        prefix, words = self.prefix[self.sent], self.words[self.last[self.sent]]
        used = self.prefix[open_[self.prefix]] if self.by_successors else prefix
        contexts = used[np.diff(used, prepend=-1) > 0]  # n-grams are ordered by their prefixes
        rank = np.zeros(len(self.count), np.int64)
        rank[contexts] = np.arange(len(contexts))
        rank = rank[prefix]
        # A context beyond a shard's share is split by its successors.
        parts = 1 + self.count[contexts] * shards // max(1, total)
        base = np.cumsum(parts) - parts
        request = base[rank]
        split = np.flatnonzero(parts[rank] > 1)
        request[split] += (arrays.mix(words[split]) % parts[rank[split]].astype(np.uint64)).astype(np.int64)
        context = np.repeat(np.arange(len(contexts)), parts)
        part = np.arange(len(context)) - base[context]
        keys = arrays.mix(self.keys[contexts[context]] + part.astype(np.uint64) * _STEP)
        of = shard_of(keys, shards)
        keys = keys >> np.uint64(16)
        order = shard_order(of, keys)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        last = self.last[self.sent]
        self.sent = self.sent[by := order_of(place[request] * (len(self.words) + 1) + self.rank[last])]
        self.asked = contexts[context[order]]
        if not send:
            return []
        each = np.bincount(place[request], minlength=len(order))
        bounds = np.concatenate([[0], np.cumsum(each)])
        words = steps(self.number[last[by]], each).astype("<u4")
        local, keys = self.local[self.sent].astype("<u4"), keys[order]
        alone = np.where(part == 0, self.successors[contexts[context]], 0)[order].astype("<u4")
        out = []
        for shard, a, b in _cuts(of[order]):
            some = slice(a, b) if self.by_successors else a + np.flatnonzero(each[a:b])
            c, d = bounds[a], bounds[b]
            if self.by_successors or d > c:
                out.append((shard, pack(np.diff(keys[some], prepend=np.uint64(0)).astype("<u8"), each[some].astype("<u4"), words[c:d], local[c:d], alone[some])))
        return out

    def counted(self, answers: list[bytes]) -> None:
        """Take the answers to `extend`, in the order of their shards."""
        count, sole = self.local, np.ones(len(self.local), bool)
        if answers:
            parts = [unpack(p, "<u8", "<u4") for p in answers]
            codes = np.concatenate([c for c, _ in parts])
            count[self.sent], sole[self.sent] = (codes >> np.uint64(1)).astype(np.int64), (codes & np.uint64(1)).astype(bool)
        context = self.count[self.prefix]
        if self.by_successors:
            if answers:
                self.successors[self.asked] = 0
                self.successors += np.bincount(self.asked, weights=np.concatenate([t for _, t in parts]), minlength=len(self.count)).astype(np.int64)
            distinct = self.successors[self.prefix]
            weight = counted_weight(context, distinct)
        else:
            weight = backoff(context)
        self.p = (1 - weight) * count / np.maximum(context, 1) + weight * self.p[self.suffix]
        self.log_p[self.ends] = np.log10(self.p)[self.index]
        self.keys = arrays.mix(self.keys[self.prefix] * _STEP ^ self.words[self.last])
        self.gram = np.full(len(self.stream), -1, np.int32)
        self.gram[self.ends] = self.index
        self.count, self.sole = count, sole
        del self.ends, self.index, self.prefix, self.suffix, self.last, self.local, self.sent, self.successors, self.asked


def _read(own: pa.Table, answers: pa.Table, order: int, word_shards: int, shards: int, total: int, distinct: int, begins: int, counted: bool) -> tuple[Block, np.ndarray, pa.Array]:
    """A block with its n-grams up to `order` counted, whether its texts are held out, and their ids."""
    words, held, tokens = (own.column(c)[0].as_py() for c in ("words", "held_out", "tokens"))
    words, (held,), (sizes, index) = unpack(words, "<u8")[0], unpack(held, "?"), unpack(tokens, "<u4", "<u4")
    rows = sorted(zip(*(answers.column(c).to_pylist() for c in ("level", "shard", "payload"))), key=lambda r: r[:2])
    sent = {n: [payload for level, _, payload in rows if level == n] for n in range(1, order + 1)}
    block = Block(words, sizes, index, held, counted)
    block.words_known(sent[1], word_shards, total, distinct, begins)
    for n in range(2, order + 1):
        block.extend(shards, total, send=False)
        block.counted(sent[n])
    return block, held, own.column("ids").combine_chunks().flatten()


def _send_ngrams(own: pa.Table, answers: pa.Table, order: int, shards: int, total: int, **sizes) -> pa.Table:
    """Rows (shard, block, payload): the n-grams of this order of a block."""
    block = _read(own, answers, order - 1, shards=shards, total=total, **sizes)[0]
    out = block.extend(shards, total)
    number = own.column("block")[0].as_py()
    return pa.table({"shard": pa.array([s for s, _ in out], pa.int64()), "block": pa.array([number] * len(out), pa.int64()), "payload": pa.array([p for _, p in out], pa.binary())})


def _count_shards(batches) -> Iterator[pa.RecordBatch]:
    """Answers (shard, block, payload): twice the count of each n-gram, and 1 if no other block has it; distinct successors of each context."""
    for shard, rows in _by_shard(batches):
        sent = [unpack(p, "<u8", "<u4", "<u4", "<u4", "<u4") for _, _, p in rows]
        keys, asked = np.unique(np.concatenate([np.cumsum(s[0]) for s in sent]), return_inverse=True)
        rank = np.repeat(asked, np.concatenate([s[1] for s in sent]))
        distinct = np.bincount(asked, weights=np.concatenate([s[4] for s in sent]), minlength=len(keys)).astype(np.int64)
        of = np.cumsum([0, *(len(s[0]) for s in sent)])
        word = np.concatenate([from_steps(s[2], s[1]) for s in sent]).astype(np.uint64)
        uses = np.concatenate([s[3] for s in sent])
        at = np.cumsum([0, *(len(s[2]) for s in sent)])
        del sent
        key = (rank.astype(np.uint64) << np.uint64(32)) | word
        order = np.argsort(key)
        key = key[order]
        cut = np.flatnonzero(np.concatenate([np.ones(min(1, len(key)), bool), key[1:] != key[:-1]]))
        blocks = np.diff(np.append(cut, len(key)))
        own = np.add.reduceat(uses[order].astype(np.int64), cut) if len(cut) else np.zeros(0, np.int64)
        learned = own > 0
        key = key[cut]
        context, word = (key >> np.uint64(32)).astype(np.int64), key & np.uint64(0xFFFF_FFFF)
        trie = NgramTrie(keys[context[learned]], word[learned], (2 * own + (blocks == 1))[learned])
        distinct += np.bincount(context[learned], minlength=len(keys))
        found = np.empty(len(order), np.uint64)
        found[order] = np.repeat(trie.value(keys[context], word), blocks)
        distinct = distinct[asked].astype("<u4")
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard] * len(rows), pa.int64()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([pack(found[a:b].astype("<u8"), distinct[c:d]) for a, b, c, d in zip(at, at[1:], of, of[1:])], pa.binary()),
            ],
            names=["shard", "block", "payload"],
        )


def _collect(own: pa.Table, answers: pa.Table, order: int, total: int, **sizes) -> pa.Table:
    """One row for each text of a block."""
    block, held, ids = _read(own, answers, order, total=total, **sizes)
    n = len(block.sizes)
    return pa.table({
        "doc_id": ids, "held_out": pa.array(held), "n_tokens": pa.array(block.sizes), "n_known": pa.array(block.known),
        "train_tokens": pa.array([total] * n, pa.int64()), "base_score": pa.array(block.base), "score": pa.array(block.sums(block.log_p)),
    })


def _bucketed(blocks: DataFrame, n_bytes: int) -> DataFrame:
    """The blocks written in buckets by number, so that no exchange moves them when their answers are grouped by block.

    Spark keeps buckets only for tables, so one is named for the time of the write; the files stay in the shared folder.
    With fewer buckets than shuffle partitions the blocks would be exchanged all the same.
    """
    spark = blocks.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // (2 * BLOCK_BYTES)))
    name = f"ngram_blocks_{uuid.uuid4().hex}"
    blocks.write.format("parquet").option("compression", "zstd").option("path", fresh_path(spark, "blocks")).bucketBy(
        min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))), "block"
    ).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def score_corpus(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", order: int = 2, counted: bool = False) -> DataFrame:
    """Per text: doc_id (long), held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the texts where `held_out` does not hold and scores all of them with
    n-grams of up to `order` words, weighted by counted successors or by `backoff`.
    """
    if order < 2:
        raise ValueError("order is 2 at least")
    plain = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(f"`{text_col}`").alias("text"))
    n_bytes, begins = plain.agg(F.sum(F.octet_length("text")), F.count_if(~F.col("held_out"))).first()
    blocks = _bucketed(
        plain.mapInArrow(_blocks, "block long, n_words long, n_tokens long, ids array<long>, held_out binary, words binary, training binary, tokens binary"), n_bytes or 0
    )
    words, tokens = blocks.agg(F.sum("n_words"), F.sum("n_tokens")).first()
    if words is None:
        return blocks.sparkSession.createDataFrame([], _RESULT)
    word_shards = max(8, -(-words // SHARD_TOKENS))
    sent = blocks.select("block", "words", "training").mapInArrow(partial(_send_words, shards=word_shards), "shard long, block long, payload binary")
    met = sent.repartition(word_shards, "shard").sortWithinPartitions("shard", "block")
    answers = written(met.mapInArrow(partial(_sum_words, shards=word_shards), "shard long, block long, distinct long, total long, payload binary"), "word-counts")
    distinct, total = answers.agg(F.sum("distinct"), F.sum("total")).first()

    shards = max(8, -(-tokens // SHARD_TOKENS))
    sizes = {"word_shards": word_shards, "shards": shards, "total": total, "distinct": distinct, "begins": begins, "counted": counted}
    own = blocks.select("block", "words", "held_out", "tokens", "ids").groupBy("block")
    known = answers.select("block", F.lit(1).alias("level"), "shard", "payload")
    for n in range(2, order + 1):
        sent = own.cogroup(known.groupBy("block")).applyInArrow(_with(_send_ngrams, order=n, **sizes), "shard long, block long, payload binary")
        met = sent.repartition(shards, "shard").sortWithinPartitions("shard", "block")
        answers = met.mapInArrow(_count_shards, "shard long, block long, payload binary")
        if n < order:
            answers = written(answers, f"counts-{n}")
        known = known.unionByName(answers.select("block", F.lit(n).alias("level"), "shard", "payload"))
    return own.cogroup(known.groupBy("block")).applyInArrow(_with(_collect, order=order, **sizes), _RESULT)


def _with(fn: Callable[..., pa.Table], **options) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda own, answers: fn(own, answers, **options)


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
