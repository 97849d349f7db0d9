"""Exact and near duplicates against brute force."""

import random
import re
from collections import defaultdict

import pytest

from quarryline.llm import exact, graph, minhash
from odd_rows import no_docs, odd_docs  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def groups_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_exact_groups_of_odd_rows(odd_docs):
    found = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.exact_groups(odd_docs).collect()}
    assert found == {
        (1, 2, 3, False), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True), (6, 6, 1, True),
        (None, None, 1, True), (8, 8, 1, True), (9, 9, 1, True),
    }
    assert exact.exact_groups(odd_docs).count() == odd_docs.count()


def test_deduplicate_keeps_the_owner_row_and_its_columns(odd_docs, no_docs):
    kept = exact.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: x or 0) == [None, 2, 4, 5, 6, 8, 9]
    smallest = exact.deduplicate(odd_docs, largest=False).where("doc_id < 4").collect()
    assert sorted(r.doc_id for r in smallest) == [1, 3]
    assert exact.deduplicate(no_docs).count() == 0 and exact.exact_groups(no_docs).count() == 0


def test_trie_spills_subtrees_and_loses_nothing(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 9))) for _ in range(3000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    owners = {}
    for i, t in enumerate(texts):
        owners[t] = i
    for bound in (1 << 10, 1 << 26):
        rows = exact.owner_rows(docs, trie_bytes=bound).collect()
        assert {r.c1: (r.c0, r.copies) for r in rows} == {t: (i, texts.count(t)) for t, i in owners.items()}
        assert len(rows) == len(owners)


def test_radix_trie_against_a_dict():
    draw = random.Random(1)
    trie, want = exact.RadixTrie(max), {}
    for i in range(4000):
        key = bytes(draw.choice(b"abc") for _ in range(draw.randint(1, 8)))
        trie.insert(key, i)
        want[key] = i
    kept = b"ab"
    out = dict(trie.spill(keep=kept))
    rest = dict(trie.drain())
    assert out | rest == want and not out.keys() & rest.keys()
    assert all(k in rest for k in want if k.startswith(kept))


def brute(rows, k, percent):
    """(size of the set, smallest id reachable) of each id."""
    sets = {}
    for i, text in rows:
        words = WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids, where = sorted(sets), defaultdict(list)
    for i in ids:
        near = defaultdict(int)
        for s in sets[i]:
            for j in where[s]:
                near[j] += 1
            where[s].append(i)
        for j, both in near.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(n, words, seed):
    """Copies of one text with more and more words changed: links of every strength around the threshold."""
    draw = random.Random(seed)
    base = [f"w{draw.randint(0, 5000)}" for _ in range(words)]
    out = []
    for i in range(n):
        copy = list(base)
        for _ in range(draw.randint(0, words // 20)):
            copy[draw.randrange(words)] = f"x{draw.randint(0, 10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("k, percent, tile", [(3, 85, 2048), (5, 80, 16)])
def test_near_duplicates_against_brute_force(spark, k, percent, tile):
    texts = family(120, 150, 1) + family(60, 60, 2) + family(40, 12, 3) + ["one two", "one two", "One TWO", "", None, "z"]
    rows = [(i * 3 % 1000, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, k=k, percent=percent, tile=tile).collect()}
    assert found == brute(rows, k, percent)


def test_near_duplicates_on_documents(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    df = minhash.near_duplicates(spark.read.parquet(f"{folder}/documents.parquet"), k=3, percent=85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()} == brute(rows, 3, 85)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = minhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r.doc_id: (r.component_id, r.kept) for r in rows}
    assert found[1] == (1, True) and found[2] == (1, False) and found[3] == (3, True) and found[4] == (4, True)
    assert found[None] == (None, True) and found[5] == (5, True) and found[6] == (6, True)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_banding_keeps_its_promise():
    for percent in (50, 80, 85, 95):
        bands, rows = minhash.banding(percent / 100)
        assert bands * rows <= minhash.HASHES
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.BAND_MISS


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (3, 1), (5, 5), *((i, i + 1) for i in range(100, 160)), *((1000, i) for i in range(1001, 1100))]
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {1: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 7} | {i: 100 for i in range(100, 161)} | {i: 1000 for i in range(1000, 1100)}
    assert found == want


def test_families_of_long_texts_meet_in_small_tiles(spark, monkeypatch):
    """Tiles are bounded by the bytes of their sets, not by members alone."""
    monkeypatch.setattr(minhash, "TILE_BYTES", 40_000)
    made, plain = [], minhash._tiled

    def watched(rows, tile):
        out = plain(rows, tile)
        made.append(out)
        return out

    monkeypatch.setattr(minhash, "_tiled", watched)
    words = [f"w{i}" for i in range(3000)]
    docs = [(i, " ".join([*words[:1500], f"x{i}", *words[1500:]])) for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.component_id for r in minhash.near_duplicates(df).collect()} == {0}
    held = made[-1].groupBy("key", "first", "second").agg(minhash.F.sum(minhash.F.octet_length("shingles")).alias("bytes")).collect()
    assert len(held) > 3 and max(r.bytes for r in held) < 12 * 8 * 3000 / 2
