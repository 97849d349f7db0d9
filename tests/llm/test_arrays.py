import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import arrays, eliasfano, fmindex


@given(st.lists(st.one_of(st.none(), st.text(max_size=40)), max_size=12))
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = arrays.text_bytes(pa.array(texts, pa.string()))
    starts, ends, bounds = arrays.runs(data, offsets, arrays.NOT_SPACE)
    raw = data.tobytes()
    found = [[raw[a:b].decode() for a, b in zip(starts[x:y], ends[x:y])] for x, y in zip(bounds, bounds[1:])]
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    words = ["a", "ab", "ba", "abc" * 50, "é", "a"] * 3000
    data, offsets = arrays.text_bytes(pa.array([" ".join(words)]))
    starts, ends, _ = arrays.runs(data, offsets, arrays.NOT_SPACE)
    by_hash = {}
    for word, h in zip(words, arrays.span_hashes(data, starts, ends, chunk=1000).tolist()):
        assert by_hash.setdefault(h, word) == word
    assert len(by_hash) == 5


def test_blocks_are_bounded_and_whole():
    texts = ["x" * n for n in (0, 5, 50, 3, 3, 3, 0)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    blocks = [b.column("text").to_pylist() for b in arrays.text_blocks(batch, "text", 10)]
    assert sum(blocks, []) == texts
    assert all(sum(map(len, b)) <= 10 or len(b) == 1 for b in blocks)


@given(st.lists(st.integers(0, 2**40), max_size=300), st.lists(st.integers(0, 2**40), min_size=1, max_size=50))
@settings(max_examples=60, deadline=None)
def test_elias_fano(values, wanted):
    values = np.sort(np.array(values, np.uint64))
    sequence = eliasfano.EliasFano(*eliasfano.EliasFano.encode(values, 2**40 + 1))
    assert (sequence.get(np.arange(len(values))) == values).all()
    wanted = np.array(wanted, np.uint64)
    assert (sequence.successor(wanted) == np.searchsorted(values, wanted)).all()


def test_bigram_trie_finds_its_entries_only():
    draw = np.random.default_rng(3)
    pairs = np.unique(np.stack([draw.integers(0, 200, 3000), draw.integers(0, 2**32, 3000)]), axis=1).astype(np.uint64)
    log_p = -draw.random(pairs.shape[1]) * 8
    trie = eliasfano.BigramTrie(pairs[0] * np.uint64(10**15), pairs[1], log_p)
    found = trie.log_probability(pairs[0] * np.uint64(10**15), pairs[1])
    assert np.abs(found - log_p).max() < 4e-4
    assert np.isnan(trie.log_probability(pairs[0] * np.uint64(10**15) + np.uint64(1), pairs[1])).all()
    empty = eliasfano.BigramTrie(pairs[0][:0], pairs[1][:0], log_p[:0])
    assert np.isnan(empty.log_probability(pairs[0][:3], pairs[1][:3])).all()


@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=8), st.integers(1, 9))
@settings(max_examples=120, deadline=None)
def test_fm_index_counts_and_locates(runs, sample):
    text = np.array([s for r in runs for s in [*r, 0]])
    index = fmindex.FMIndex(text, 5, sample)
    phrases = [p for r in runs for p in (r[:3], r[-2:], [4, 4], [1])]
    matrix = np.zeros((len(phrases), 3), np.int64)
    for row, p in enumerate(phrases):
        matrix[row, 3 - len(p) :] = p
    low, high = index.ranges(matrix, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, low, high):
        want = [i for i in range(len(text)) if text[i : i + len(p)].tolist() == p]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == want
