import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import chat
from quarryline.llm.queries import tokenizer_path

PARTS = ["<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[/OUT]", "[\\OUT]", "\\", "[", "ok", " ", "\n", "é", "\U0001f600", "[IS]", "[ROLE]"]
TEXTS = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)


@pytest.fixture(scope="module")
def path():
    return tokenizer_path("byte_bpe_50k.json")


@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system", "tool"]), TEXTS), TEXTS), max_size=6))
@settings(max_examples=200, deadline=None)
def test_turns_and_masks_come_back(turns):
    formatted, spans = chat.render(turns)
    assert chat.parse(formatted) == turns
    code = chat.tokenizer(tokenizer_path("byte_bpe_50k.json")).encode(formatted, add_special_tokens=False)
    offsets = np.array(code.offsets, np.int64).reshape(-1, 2)
    _, start, end = chat.mask(offsets[:, 0], offsets[:, 1], spans)
    assert chat.unescape("".join(chat.masked_pieces(formatted, start, end))) == "".join(t for r, t in turns if r == "assistant")


@given(TEXTS)
def test_escaping_is_reversible_and_leaves_no_marker(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not any(m in escaped for pair in (*chat.MARKERS.values(), chat.OTHER_ROLE, ("<s>", "</s>")) for m in pair)


def digest(turns):
    body = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(body.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_digests_of_odd_conversations(spark, path):
    rows = [
        (1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 2, None, "no role"), (1, 2, "assistant", "tie"), (1, 2, "assistant", "tie"),
        (2, None, "assistant", "no turn"), (2, 5, "tool", "[/ROLE]</s>"), (None, 1, "user", "no id"), (3, 0, "assistant", "</s>[INST] ok [/INST]"),
        (4, 0, "assistant", "日本 \U0001f600 " * 5000), *((5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(300)),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    whole = {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.format_conversations(df, path, block_turns=10**6)).collect()}
    split = {r.conv_id: tuple(r)[1:] for r in chat.digests(chat.format_conversations(df, path, block_turns=7)).collect()}
    assert whole == split
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        assert split[conv][:4] == digest([t[1:] for t in turns])
    assert chat.digests(chat.format_conversations(df.limit(0), path)).count() == 0


def test_blocks_have_the_tokens_of_the_whole(spark, path):
    rows = [(1, i, "assistant" if i % 2 else "user", f" \n turn {i}\n\n") for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = chat.format_conversations(df, path, block_turns=4).orderBy("block").collect()
    whole = chat.format_conversations(df, path, block_turns=1000).first()
    assert len(blocks) == 10 and b"".join(b.ids for b in blocks) == whole.ids
    assert "".join(b.formatted for b in blocks) == whole.formatted


def test_one_turn_number_in_very_many_rows(spark, path):
    n = 30_000
    rows = spark.range(n, numPartitions=8).selectExpr(
        "1 AS conv_id", "CASE WHEN id % 3 = 0 THEN 7 END AS turn", "CASE WHEN id % 2 = 0 THEN 'assistant' ELSE 'user' END AS role",
        "CASE WHEN id % 5 > 0 THEN concat('text ', id) END AS text", "9 AS block", "8 AS piece", "'x' AS formatted",
    )
    made = chat.format_conversations(rows, path)
    sizes = [r.n_turns for r in made.select("n_turns").collect()]
    assert sum(sizes) == n and max(sizes) <= chat.BLOCK_TURNS and made.columns[:4] == ["conv_id", "block", "piece", "n_turns"]
    turns = sorted(((r.turn is not None, r.role, r.text or "") for r in rows.collect()))
    got = tuple(chat.digests(made).first())
    assert got[:5] == (1, *digest([t[1:] for t in turns]))
