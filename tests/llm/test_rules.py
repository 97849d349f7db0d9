"""Line rules and counts against plain Python, and small cases of each rule."""

import re
from collections import Counter

import pytest
from odd_rows import labels, no_docs, odd_docs  # noqa: F401

from quarryline.llm import rules

WORDS = re.compile(r"[^ \t-\r]+")


def counts(text):
    text = text or ""
    words, lines = WORDS.findall(text), [x for x in text.split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    hit = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit)


def judged(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in rules.judge(docs).collect()}


def test_counts_against_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    found = rules.judge(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        n = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])


def test_overlapping_and_adjacent_repeats(spark):
    texts = ["a a a a", "a b c a b c", "a b c x b c x b", "a b", "a b c", "\ta  b c\x0bd ", "a b c d a b c e b c d"]
    for i, r in judged(spark, texts).items():
        assert (r.n_words, r.word_chars, r.n_repeat_words) == tuple(counts(texts[i])[k] for k in (0, 1, 4))


SENTENCE = "every{0} word{0} of{0} this{0} line{0} is{0} new{0} and{0} so{0} it{0} stays{0}."


@pytest.mark.parametrize(
    "bad",
    [
        "Home | About | Products | News | Contact | Help",  # a menu
        "Start > Shop > Shoes > Men > Size > Blue.",  # a trail that ends in a stop
        "BUY!! NOW!! AND!! SAVE!! MONEY!! TODAY!!",
        "some$$$ words%%% are### broken*** here&&& again.$$$",
        "no stop at the end of this line",
        "All rights reserved.",
        "Please read our Privacy Policy before you go on.",
    ],
)
def test_a_failing_line_goes_and_the_rest_stays(spark, bad):
    good = [SENTENCE.format(i) for i in range(6)]
    r = judged(spark, ["\n".join([*good[:3], f"  {bad} ", *good[3:]])])[0]
    assert r.clean_text == "\n".join(good) and (r.n_lines, r.n_kept_lines) == (7, 6) and r.kept


def test_a_text_that_loses_too_much_is_rejected(spark):
    good = [SENTENCE.format(i) for i in range(6)]
    bad = [SENTENCE.format(100 + i)[:-1] for i in range(6)]
    rows = judged(spark, ["\n".join(good + bad[:4]), "\n".join(good[:4] + bad), "\n".join(bad), "Privacy policyholders read moreover."])
    assert [rows[i].kept for i in range(3)] == [True, False, False]
    assert rows[3].n_kept_lines == 1  # phrases are whole words


def test_odd_rows(odd_docs, no_docs):
    rows = rules.judge(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    for i in (3, 4, 5):
        assert (by_id[i].n_words, by_id[i].n_lines, by_id[i].kept, by_id[i].base_failed) == (0, 0, False, True)
    assert by_id[6].n_repeat_words == 90_000 and by_id[6].base_failed
    assert rules.judge(no_docs).collect() == []
