"""Splitting: worked examples, properties, and the column forms."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle import differences, duck
from quarryline.constants import SEPARATORS
from quarryline.operators import chunking
from quarryline.operators.chunking import WORDS, chunk_spans
from quarryline.plans.catalog import QUERIES, _chunk_rows, _samples
from quarryline.plans.oracles import ORACLES


def cut(text, size, overlap, separators=SEPARATORS, unit="characters"):
    return [c for c in (text[a:b].strip() for a, b in chunk_spans(text, separators, size, overlap, unit)) if c]


def test_short_text_is_one_chunk():
    assert cut("one two", 20, 5) == ["one two"]


@pytest.mark.parametrize("text", ["", "   ", "\n\n \n"])
def test_blank_text_has_no_chunk(text):
    assert cut(text, 20, 5) == []


def test_paragraphs_before_lines_before_words():
    text = "aaaa bbbb\ncccc\n\ndddd eeee ffff gggg"
    assert cut(text, 16, 0) == ["aaaa bbbb\ncccc", "dddd eeee ffff", "gggg"]


def test_words_overlap():
    assert cut("aa bb cc dd ee", 8, 4) == ["aa bb cc", "cc dd", "dd ee"]


def test_long_word_becomes_windows():
    assert [len(c) for c in cut("x" * 2000, 512, 50)] == [512, 512, 512, 512, 152]


@pytest.mark.parametrize(("n", "count"), [(512, 1), (513, 2)])
def test_size_boundary(n, count):
    assert len(cut("x" * n, 512, 50)) == count


def test_characters_outside_the_basic_plane():
    assert cut("é😀" * 6, 5, 1) == ["é😀é😀é", "é😀é😀é", "é😀é😀"]


def test_language_boundary_first():
    text = "import a\ndef f():\n  return 1\ndef g():\n  return 2"
    assert cut(text, 24, 0, ["\nclass ", "\ndef "] + SEPARATORS) == [
        "import a", "def f():\n  return 1", "def g():\n  return 2",
    ]


def test_size_in_words():
    assert cut("a b c d e f g", 3, 1, unit=WORDS) == ["a b c", "c d e", "e f g"]


def test_words_parted_by_tabs_only():
    text = "\t".join(f"w{i}" for i in range(1000))
    chunks = cut(text, 800, 0, unit=WORDS)
    assert [len(c.split()) for c in chunks] == [800, 200] and " ".join(" ".join(chunks).split()) == text.replace("\t", " ")


def by_pieces(text, separators, size, overlap):
    """Sequential form of the merge: hold pieces, emit when full, keep a tail."""
    if separators[0] == "" or not any(s and s in text for s in separators):
        pieces, left = list(text), []
    else:
        at = next(i for i, s in enumerate(separators) if s and s in text)
        head, *tail = text.split(separators[at])
        pieces, left = [p for p in [head, *(separators[at] + t for t in tail)] if p], separators[at + 1 :]
    out, held = [], []

    def emit():
        if held:
            out.append("".join(held))

    for piece in pieces:
        if len(piece) >= size and left:
            emit()
            held.clear()
            out.extend(by_pieces(piece, left, size, overlap))
            continue
        if sum(map(len, held)) + len(piece) > size:
            emit()
            while held and (sum(map(len, held)) > overlap or sum(map(len, held)) + len(piece) > size):
                held.pop(0)
        held.append(piece)
    emit()
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab \n", max_size=120), st.integers(4, 30), st.integers(0, 2))
def test_same_as_sequential_merge(text, size, overlap):
    expected = [c.strip() for c in by_pieces(text, SEPARATORS, size, overlap)] if text else []
    assert cut(text, size, overlap) == [c for c in expected if c]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200), st.integers(6, 40), st.integers(0, 5))
def test_spans_cover_the_text(text, size, overlap):
    spans = chunk_spans(text, SEPARATORS, size, overlap)
    assert all(0 < b - a <= size for a, b in spans)
    assert [a for a, _ in spans] == sorted({a for a, _ in spans})
    reached = 0
    for a, b in spans:
        assert a <= reached
        reached = b
    assert reached == len(text)


def test_fixed_windows(spark):
    lengths = [0, 1, 50, 51, 461, 462, 463, 511, 512, 513, 974, 975, 2000]
    df = spark.createDataFrame([(n, "".join(chr(97 + i % 26) for i in range(n))) for n in lengths], "n int, text string")
    for r in df.select("n", "text", chunking.fixed_windows("text").alias("w")).collect():
        count = max(-(-(r.n - 50) // 462), 1) if r.n else 0
        assert r.w == [r.text[462 * i : 462 * i + 512] for i in range(count)]


def test_fixed_windows_reject_wide_overlap():
    with pytest.raises(ValueError):
        chunking.fixed_windows("text", 10, 6)


def test_chunk_rows(spark):
    df = spark.createDataFrame([(7, "x" * 600, "c"), (8, "", "c"), (9, None, "c")], "original_index bigint, text string, lang string")
    out = chunking.chunk_rows(df, chunking.recursive_chunks("text", chunking.language_separators("lang")))
    assert [(r.chunk_id, len(r.chunk), r.lang) for r in out.orderBy("chunk_id").collect()] == [
        ("7_0", 512, "c"), ("7_1", 138, "c"),
    ]
    assert out.where(F.sha2("chunk", 256) != F.col("code_hash")).count() == 0


@pytest.mark.parametrize("name", ["chunk_recursive_rows", "chunk_by_lang_rows"])
def test_the_replay_sees_what_a_splitter_loses(spark, folder, name):
    chunks = QUERIES[name](spark, folder)
    broken = {
        "a chunk in the middle": chunks.where("NOT (chunk_no = 1 AND original_index % 10 = 3)"),
        "the last chunk of a long text": chunks.where("chunk_no < 12"),
        "the overlap": _chunk_rows(_samples(spark, folder), chunking.recursive_chunks("text", chunking.language_separators("lang"), overlap=0)),
        "a little of the size": _chunk_rows(_samples(spark, folder), chunking.recursive_chunks("text", chunking.language_separators("lang"), size=500)),
    }
    with duck(folder) as con:
        assert differences(chunks, con, ORACLES[name]) is None
        for what, rows_without in broken.items():
            assert differences(rows_without, con, ORACLES[name]) is not None, what
