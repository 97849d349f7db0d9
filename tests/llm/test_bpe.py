import base64
import hashlib

import numpy as np
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from quarryline.llm import arrays, bpe
from quarryline.llm.queries import tokenizer_path
from odd_rows import no_docs, odd_docs  # noqa: F401

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = tokenizer_path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = st.text(alphabet=st.one_of(st.sampled_from(list("astrevlmd'’ \n\t 1é!中S")), st.characters(exclude_categories=["Cs", "Cn"])), max_size=40)


@given(st.lists(TEXTS, min_size=1, max_size=5))
@settings(max_examples=250, deadline=None)
def test_pieces_are_the_matches_of_the_pattern(texts):
    data, offsets = arrays.text_bytes(pa.array(texts))
    starts, bounds = bpe.pieces(data, offsets)
    raw = data.tobytes()
    cut = [*starts.tolist(), len(raw)]
    found = [[raw[x:y].decode() for x, y in zip(cut[a:b], cut[a + 1 : b + 1])] for a, b in zip(bounds, bounds[1:])]
    assert found == [regex.findall(public_tokenizers.PATTERN, t) for t in texts]


@given(st.lists(TEXTS, min_size=1, max_size=4))
@settings(max_examples=150, deadline=None)
def test_ids_are_those_of_the_library(library, texts):
    own = bpe.vocabulary(PATH)
    for text, ids in zip(texts, own.encode(*arrays.text_bytes(pa.array(texts)))):
        ids = np.frombuffer(ids, "<u4")
        assert ids.tolist() == library.encode_ordinary(text)
        assert own.decode(ids)[0].tobytes() == text.encode()


def test_long_pieces(library):
    own = bpe.vocabulary(PATH)
    for text in ("a" * 5000, "ab" * 4000 + "é" * 999, "'s" * 2000, " " * 3000 + "x", "1" * 2500):
        assert np.frombuffer(own.encode(*arrays.text_bytes(pa.array([text])))[0], "<u4").tolist() == library.encode_ordinary(text)


def test_documents(spark, folder, library):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    want = {}
    for r in docs.select("doc_id", "text").collect():
        ids = np.array(library.encode_ordinary(r.text or ""), "<u4").tobytes()
        want[r.doc_id] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in bpe.round_trip(docs, PATH).collect()} == want


def test_encode_and_decode_as_operators(odd_docs, no_docs):
    encoded = bpe.encode(odd_docs, PATH)
    assert encoded.columns == ["c0", "c1", "c2", "c3", "c4", "n_tokens", "ids", "offsets"]
    for r in encoded.collect():
        ids, offsets = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.offsets, "<u4").tolist()
        body = (r.c1 or "").encode()
        assert r.n_tokens == len(ids) == len(offsets)
        assert b"".join(body[a:b] for a, b in zip(offsets, [*offsets[1:], len(body)])) == body
    decoded = bpe.decode(encoded.select("c1", "ids"), PATH).collect()
    assert all(bytes(r.decoded).decode() == (r.c1 or "") for r in decoded) and len(decoded) == odd_docs.count()
    assert bpe.round_trip(no_docs, PATH).count() == 0
