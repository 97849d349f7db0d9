import math
import re
import zlib
from collections import Counter

import pytest

from quarryline.llm import ngram_lm, training
from odd_rows import no_docs, odd_docs  # noqa: F401

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    tokens = [(i, [*WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), 0]) for i, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in tokens]
    one, two, begins = Counter(), Counter(), 0
    for (_, t), h in zip(tokens, held):
        if not h:
            one.update(t)
            two.update(zip([1, *t], t))
            begins += 1
    n, v = sum(one.values()), len(one)
    out = []
    for (i, t), h in zip(tokens, held):
        base = sum(math.log10((one[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for u, w in zip([1, *t], t):
            c = begins if u == 1 else one[u]
            part = min(1, (ngram_lm.HELD + ngram_lm.SPREAD * c**ngram_lm.HEAPS) / (c + ngram_lm.HELD))
            score += math.log10((1 - part) * two[u, w] / max(c, 1) + part * (one[w] + 1) / (n + v + 1))
        out.append((i, h, len(t), sum(w in one for w in t), n, base, score))
    return sorted(out, key=repr)


def check(docs, monkeypatch=None):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in ngram_lm.score_corpus(docs, training.held_out(7, 2)).collect()), key=repr)
    for got, want in zip(found, brute(rows), strict=True):
        assert got[:5] == want[:5]
        assert got[5] == pytest.approx(want[5], rel=1e-9)
        assert abs(got[6] - want[6]) < 3e-4 * want[2]
    return found


def test_against_brute_force(spark, folder):
    found = check(spark.read.parquet(f"{folder}/documents.parquet"))
    held = [r for r in found if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_many_shards_and_split_contexts(spark, folder, monkeypatch):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 900)
    docs = spark.createDataFrame([(i, "the " * (i % 7) + f"the w{i % 11} the w{i % 5}") for i in range(400)], "doc_id long, text string")
    check(docs.repartition(5))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert ngram_lm.score_corpus(no_docs, training.held_out(7, 2)).count() == 0
    none = ngram_lm.score_corpus(odd_docs, training.F.lit(True)).collect()
    assert len(none) == odd_docs.count() and all(r.train_tokens == 0 and r.n_known == 0 for r in none)


def test_packing():
    import numpy as np

    columns = np.arange(5, dtype="<u8") << np.uint64(40), np.zeros(0, "<u4"), np.array([True, False])
    for a, b in zip(columns, ngram_lm.unpack(ngram_lm.pack(*columns), "<u8", "<u4", "?")):
        assert a.tolist() == b.tolist()


def brute_of_order(rows, order):
    """(id, score) with contexts of up to order - 1 words."""
    tokens = [(i, [1, *WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), 0]) for i, t in rows]
    counts = Counter()
    for i, t in tokens:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update(tuple(t[a:b]) for b in range(1, len(t) + 1) for a in range(max(0, b - order), b))
    words = {g[0]: c for g, c in counts.items() if len(g) == 1 and g != (1,)}
    n, v = sum(words.values()), len(words)

    def p(context, w):
        if not context:
            return (words.get(w, 0) + 1) / (n + v + 1)
        c = counts[context]
        part = min(1, (ngram_lm.HELD + ngram_lm.SPREAD * c**ngram_lm.HEAPS) / (c + ngram_lm.HELD))
        return (1 - part) * counts[*context, w] / max(c, 1) + part * p(context[1:], w)

    return sorted(((i, sum(math.log10(p(tuple(t[max(0, b - order + 1) : b]), t[b])) for b in range(1, len(t)))) for i, t in tokens), key=repr)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_orders_against_brute_force(spark, folder, odd_docs, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 20_000)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    rows = [(i, t) for i, t in docs.collect()]
    found = ngram_lm.score_corpus(docs.repartition(5), training.held_out(7, 2), order=order)
    for got, want in zip(sorted(((r.doc_id, r.score) for r in found.collect()), key=repr), brute_of_order(rows, order), strict=True):
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], rel=1e-9)


def brute_counted(rows, order):
    """(id, score) with the weights of Witten and Bell."""
    tokens = [(i, [1, *WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")), 0]) for i, t in rows]
    counts = Counter()
    for i, t in tokens:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            counts.update(tuple(t[a:b]) for b in range(1, len(t) + 1) for a in range(max(0, b - order), b))
    successors = Counter(g[:-1] for g in counts)
    words = {g[0]: c for g, c in counts.items() if len(g) == 1 and g != (1,)}
    n, v = sum(words.values()), len(words)

    def p(context, w):
        if not context:
            return (words.get(w, 0) + 1) / (n + v + 1)
        c, distinct = counts[context], successors[context]
        return (counts[*context, w] + distinct * p(context[1:], w)) / (c + distinct) if c else p(context[1:], w)

    return sorted(((i, sum(math.log10(p(tuple(t[max(0, b - order + 1) : b]), t[b])) for b in range(1, len(t)))) for i, t in tokens), key=repr)


@pytest.mark.parametrize("order", [2, 3])
def test_counted_successors_of_split_contexts(spark, folder, odd_docs, monkeypatch, order):
    monkeypatch.setattr(ngram_lm, "SHARD_TOKENS", 20_000)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").union(odd_docs.select("doc_id", "text"))
    # A context of many uses and two successors, which is split.
    docs = docs.union(spark.createDataFrame([(10_000 + i, f"alpha {'beta' if i % 3 else 'gamma'} " * 60) for i in range(200)], "doc_id long, text string"))
    rows = [(i, t) for i, t in docs.collect()]
    found = ngram_lm.score_corpus(docs.repartition(5), training.held_out(7, 2), order=order, counted=True)
    for got, want in zip(sorted(((r.doc_id, r.score) for r in found.collect()), key=repr), brute_counted(rows, order), strict=True):
        assert got[0] == want[0] and got[1] == pytest.approx(want[1], rel=1e-9)


def test_steps():
    import numpy as np

    sizes, values = np.array([0, 3, 0, 1, 2], "<u4"), np.array([4, 4, 9, 7, 0, 2**32 - 1])
    sent = ngram_lm.steps(values, sizes).astype("<u4")
    assert sent.tolist() == [4, 0, 5, 7, 0, 2**32 - 1] and ngram_lm.from_steps(sent, sizes).tolist() == values.tolist()
    none = np.zeros(0, "<u4")
    assert ngram_lm.from_steps(ngram_lm.steps(none.astype(np.int64), none).astype("<u4"), none).tolist() == []


def test_words_whose_hashes_share_bits():
    """An unseen pair of words is told from a seen one, and a context without successors leaves no probability of 0."""
    import numpy as np
    import pyarrow as pa

    words = np.random.default_rng(1).integers(0, 2**63, 400_000).astype(np.uint64)
    part = ngram_lm.arrays.mix(words ^ np.uint64(0xABCDEF)) >> np.uint64(32)
    order = np.argsort(part)
    same = int(np.flatnonzero(part[order][1:] == part[order][:-1])[0])
    a, b = words[order[same]], words[order[same + 1]]
    words = np.array([ngram_lm.END, 5, a, b, 6], np.uint64)
    # h a x, x b | held out: h b x, where h b is unseen
    sizes, index, held = np.array([4, 3, 4]), np.array([1, 2, 4, 0, 4, 3, 0, 1, 3, 4, 0]), np.array([False, False, True])
    training = np.bincount(index[:7], minlength=5)

    def rows(payloads):
        return pa.RecordBatch.from_arrays([pa.array([0, 0]), pa.array([0, 1]), pa.array(payloads, pa.binary())], names=["shard", "block", "payload"])

    # Two equal blocks, so that neither has anything alone.
    sent = [ngram_lm.pack(words, training.astype("<u4"))] * 2
    (answer,) = ngram_lm._sum_words([rows(sent)], shards=1)
    total, distinct = answer.column("total")[0].as_py(), answer.column("distinct")[0].as_py()
    blocks = [ngram_lm.Block(words, sizes, index, held, True) for _ in range(2)]
    for block, payload in zip(blocks, answer.column("payload").to_pylist()):
        block.words_known([payload], 1, total, distinct, 4)
    for _ in range(2):
        (answer,) = ngram_lm._count_shards([rows([block.extend(1, total)[0][1] for block in blocks])])
        for block, payload in zip(blocks, answer.column("payload").to_pylist()):
            block.counted([payload])
    texts = [(i, t) for n in range(2) for i, t in ((7 * n, "h a x"), (7 * n, "x b"), (7 * n + 2, "h b x"))]
    held_ids = [i for i in range(10_000) if zlib.crc32(str(i).encode()) % 7 == 2]
    learned = [i for i in range(10_000) if zlib.crc32(str(i).encode()) % 7 != 2]
    texts = [(held_ids[k] if t == "h b x" else learned[k], t) for k, (_, t) in enumerate(texts)]
    want = dict(brute_counted(texts, 3))
    found = np.concatenate([block.sums(block.log_p) for block in blocks])
    assert found.tolist() == pytest.approx([want[i] for i, _ in texts], rel=1e-12)


def test_weight_without_successors():
    import numpy as np

    assert ngram_lm.counted_weight(np.array([0, 3, 3]), np.array([0, 0, 1])).tolist() == [1.0, 1.0, 0.25]


def test_orders_by_packed_keys():
    import numpy as np

    draw = np.random.default_rng(3)
    for keys in (draw.integers(0, 50, 1000), draw.integers(0, 2**62, 1000) // 2**60 * 2**60, np.zeros(0, np.int64)):
        assert ngram_lm.order_of(keys).tolist() == np.argsort(keys, kind="stable").tolist()
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
        found = ngram_lm.distinct_of(keys)
        assert found[0].tolist() == first.tolist() and found[1].tolist() == place.tolist()
    for keys in (draw.integers(0, 2**48, 1000), draw.integers(0, 4, 1000) * 3, (1 << 47) + draw.integers(0, 9, 1000), np.zeros(0, np.int64)):
        keys = keys.astype(np.uint64)
        for shards in (1, 9, 2**12, 2**40):
            of = draw.integers(0, shards, len(keys))
            assert ngram_lm.shard_order(of, keys).tolist() == np.lexsort((keys, of)).tolist()


def test_trie_finds_what_it_holds():
    import numpy as np
    from quarryline.llm.eliasfano import EliasFano, MappedArrays, NgramTrie

    draw = np.random.default_rng(5)
    for universe in (1, 40, 10_000, 1 << 40):
        held = np.sort(draw.integers(0, universe, 300)).astype(np.uint64)
        n, width, low, high = EliasFano.encode(held, universe)
        sequence = EliasFano(n, width, *MappedArrays([low, high]).views)
        asked = np.concatenate([held, draw.integers(0, universe, 300).astype(np.uint64)])
        at = np.searchsorted(held, asked)
        assert sequence.successor(asked).tolist() == at.tolist()
        want = np.where((at < 300) & (held[np.minimum(at, 299)] == asked), at, -1)
        assert sequence.find(asked).tolist() == want.tolist()
        begin, end = np.minimum(at, 299), np.minimum(at + draw.integers(0, 2, 600), 300)
        assert sequence.find(asked, begin, end).tolist() == np.where(end > begin, want, -1).tolist()
    # Contexts in any order, some of them twice, some unknown.
    keys = np.sort(draw.integers(0, 1 << 48, 90)).astype(np.uint64)
    context, word = np.repeat(keys[::2], 3), np.tile(np.array([1, 5, 2**32 - 1], np.uint64), 45)
    trie = NgramTrie(context, word, np.arange(135) % 7 + 1)
    value = {(c, w): i % 7 + 1 for i, (c, w) in enumerate(zip(context.tolist(), word.tolist()))}
    asked = [(int(draw.choice(keys)), int(draw.choice([0, 1, 5, 6, 2**32 - 1]))) for _ in range(500)]
    found = trie.value(*(np.array(c, np.uint64) for c in zip(*asked)), chunk=64)
    assert found.tolist() == [value.get(a, 0) for a in asked]


def test_blocks_are_not_exchanged(spark, folder):
    """The texts' blocks meet their answers where they lie, and no table stays behind."""
    before = len(spark.catalog.listTables())
    found = ngram_lm.score_corpus(spark.read.parquet(f"{folder}/documents.parquet"), training.held_out(7, 2), order=3, counted=True)
    assert len(spark.catalog.listTables()) == before and found.count() > 0
    lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
    lines = lines[: next((i for i, line in enumerate(lines) if "Initial Plan" in line), len(lines))]
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    scans = [i for i, line in enumerate(lines) if "Scan parquet" in line and "tokens" in line]
    assert scans
    for i in scans:
        assert "Bucketed: true" in lines[i]
        while "CoGroups" not in lines[i]:
            i = next(j for j in range(i - 1, -1, -1) if depth[j] < depth[i])
            assert "Exchange" not in lines[i]
