import hashlib
import re

import pytest

from quarryline.llm import decontaminate
from odd_rows import no_docs, odd_docs  # noqa: F401

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = " ".join(f"word{i}" for i in range(20))


def words(text):
    return WORDS.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i : i + 13]), set()).add("" if name is None else str(name))
    out = []
    for i, text in docs:
        w, hit, names = words(text), set(), set()
        for size in {len(p) for p in windows}:
            for a in range(len(w) - size + 1):
                if (found := windows.get(tuple(w[a : a + size]))) is not None:
                    hit.update(range(a, a + size))
                    names |= found
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


@pytest.fixture
def benchmark(spark):
    items = [(10, PASSAGE), (9, "Short item"), (9, "Short item"), (7, None), (8, ""), (6, "..."), (None, "lonely"), (5, PASSAGE[40:])]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("part_bytes", [1 << 20, 60])
def test_against_brute_force(spark, benchmark, part_bytes):
    items, table = benchmark
    docs = [
        (1, f"start {PASSAGE.upper()} end"), (2, "a short-item here, short item"), (3, None), (4, ""), (5, PASSAGE[:60]),
        (6, "filler " * 500 + PASSAGE), (7, f"{PASSAGE} {PASSAGE}\n{PASSAGE}"), (8, "lonely"), (9, "short"), (10, "item short"), (11, "é " * 30),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = decontaminate.find_contamination(df, table, part_bytes=part_bytes)
    rows = [
        (r.c0, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.n_hit > 0 and 20 * r.n_hit >= r.n_words)
        for r in found.collect()
    ]
    assert sorted(rows, key=repr) == brute(docs, items)


def test_stripping_and_dropping(spark, benchmark):
    _, table = benchmark
    docs = spark.createDataFrame([(1, f"Étude: {PASSAGE}!", "x"), (2, "clean text", "y"), (3, None, None)], "doc_id long, text string, items string")
    stripped = {r.doc_id: r.text for r in decontaminate.strip_contamination(docs, table).collect()}
    assert stripped == {1: "Étude: !", 2: "clean text", 3: None}
    kept = decontaminate.drop_contaminated(docs, table)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_odd_rows(odd_docs, no_docs, benchmark, spark):
    _, table = benchmark
    assert decontaminate.report(odd_docs, table).count() == odd_docs.count()
    assert decontaminate.report(no_docs, table).count() == 0
    none = decontaminate.report(odd_docs, table.limit(0)).collect()
    assert len(none) == odd_docs.count() and not any(r.contaminated for r in none)
