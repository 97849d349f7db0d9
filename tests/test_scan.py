"""Lexical states against a scanner that goes character by character, and cuts that never fall inside a string or bracket."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.functions import scan as scan_fn


def sequential(text, family):
    """(part, depth) of each character, the plain way."""
    part, i, n = [0] * len(text), 0, len(text)

    def mark(to, kind):
        nonlocal i
        for j in range(i, min(to, n)):
            part[j] = kind
        i = min(to, n)

    def quoted(quote, kind, over_lines):
        j = i + len(quote)
        while j < n:
            if text[j] == "\\":
                j += 2
            elif text[j] == "\n" and not over_lines:
                return mark(j, kind)
            elif text.startswith(quote, j):
                return mark(j + len(quote), kind)
            else:
                j += 1
        mark(n, kind)

    while i < n:
        c, two = text[i], text[i : i + 2]
        if family == "python" and text[i : i + 3] in ('"""', "'''"):
            quoted(text[i : i + 3], 2, True)
        elif family != "other" and c in "\"'":
            quoted(c, 1, False)
        elif family == "braces" and c == "`":
            quoted("`", 2, True)
        elif (family == "python" and c == "#") or (family == "braces" and two == "//"):
            end = text.find("\n", i)
            mark(n if end < 0 else end, 2)
        elif family == "braces" and two == "/*":
            end = text.find("*/", i + 2)
            mark(n if end < 0 else end + 2, 2)
        else:
            i += 1
    depth, depths = 0, []
    for c, p in zip(text, part):
        if family != "other" and not p:
            depth += (c in "([{") - (c in ")]}")
        depths.append(depth)
    return part, depths


def scanned(texts, family):
    held = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(held), np.uint8), np.r_[0, np.cumsum([len(h) for h in held])].astype(np.int64)
    return data, offsets, *scan_fn.scan(data, offsets, family)


#: Characters that mean something, so that short texts reach every state.
SIGNS = st.text(alphabet="'\"`\\/*#\n([{)]}a é", max_size=200)


@pytest.mark.parametrize("family", ["python", "braces", "other"])
@settings(max_examples=250, deadline=None)
@given(texts=st.lists(SIGNS, min_size=1, max_size=4))
def test_same_as_a_sequential_scanner(family, texts):
    data, offsets, part, depth = scanned(texts, family)
    for text, a, b in zip(texts, offsets, offsets[1:]):
        want_part, want_depth = sequential(text, family)
        lead = np.flatnonzero((data[a:b] & 0xC0) != 0x80)
        hidden = part[a:b][lead] > 0
        assert hidden.tolist() == [p > 0 for p in want_part]
        assert depth[a:b][lead].tolist() == want_depth
        if family == "braces":
            assert part[a:b][lead].tolist() == want_part


@settings(max_examples=150, deadline=None)
@given(text=SIGNS.map(lambda t: t.replace("a", "\ndef f(x):\n  return x\n")), size=st.integers(1, 60))
def test_spans_part_the_text_at_allowed_places(text, size):
    data, _, part, depth = scanned([text], "python")
    spans = scan_fn.nested_spans(data, part, depth, [b"class ", b"def "], size)
    want_part, want_depth = sequential(text, "python")
    assert "".join(text[a:b] for a, b, _ in spans) == text and all(0 < b - a <= size for a, b, _ in spans)
    for (a, b, level), last in zip(spans, [False] * (len(spans) - 1) + [True]):
        if last:
            break
        places = [p for p in range(a + 1, a + size + 1) if text[p - 1] == "\n" and not want_part[p - 1]]
        outer = [p for p in places if want_depth[p - 1] <= 0]
        declared = [p for p in outer if text.startswith(("class ", "def "), p)]
        best = next((i, max(c)) for i, c in enumerate([declared, outer, places, [a + size]]) if c)
        assert (level, b) == best


@pytest.fixture(scope="module")
def found(spark):
    rows = [
        (1, "python", 'def one(a):\n  """if x: def no(): import nothing"""\n  # for while def neither()\n  if a and "or": return a\nimport os\n'),
        (2, "javascript", "import x from 'lib'\n// function no() {} if\nfunction yes() { return `if ${a} function no2() {}` || 'for' }\n/* import y from 'z' */\n"),
        (3, "c", '#include "a.h"\n/* #include "b.h" */\nint main(void) { if (x) { puts("while(1) {"); } }\n'),
        (4, None, "def f import g if 'x"),
        (5, "python", None),
        (6, "python", ""),
    ]
    df = spark.createDataFrame(rows, "id int, lang string, text string")
    got = df.select(
        "id", "text", scan_fn.only_code("text", "lang").alias("shown"), scan_fn.code_functions("text", "lang").alias("functions"),
        scan_fn.code_imports("text", "lang").alias("imports"), scan_fn.code_complexity("text", "lang").alias("complexity"),
        scan_fn.nested_chunks("text", "lang", 40).alias("spans"),
    )
    return {r.id: r for r in got.collect()}


def test_only_code_counts(found):
    assert found[1].functions == ["one"] and found[1].imports == ["os"] and found[1].complexity == 3
    assert found[2].functions == ["yes"] and found[2].imports == ["x", "lib"] and found[2].complexity == 1
    assert found[3].imports == ["a.h"] and found[3].functions == ["main", "if"] and found[3].complexity == 2
    assert found[4].functions == ["f"] and found[4].imports == ["g"] and found[4].complexity == 2
    assert found[5].shown is None and found[5].spans == [] and found[6].shown == "" and found[6].spans == []


def test_masked_text_keeps_its_lines_and_length(found):
    for i in (1, 2, 3, 4):
        assert len(found[i].shown) == len(found[i].text)
        assert [p for p, c in enumerate(found[i].shown) if c == "\n"] == [p for p, c in enumerate(found[i].text) if c == "\n"]


def test_a_long_file(spark):
    body = "def f(a):\n    return [\n" + "".join(f"        '{i}',\n" for i in range(40)) + "    ]\n"
    df = spark.createDataFrame([("python", body * 300)], "lang string, text string")
    spans = df.select(F.inline(scan_fn.nested_chunks("text", "lang", 700))).collect()
    assert len(spans) == 300 and {s.level for s in spans} == {0} and {s.end - s.start for s in spans} == {len(body)}
