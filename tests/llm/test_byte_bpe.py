from functools import lru_cache
from hashlib import sha256

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cardlens.llm.byte_bpe import encode_decode, encoder, read_ranks
from text_tables import by_id, docs  # noqa: F401

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
MIXED = st.text(st.sampled_from("aeioutnhs ,.'\n\t\x85\x1c09éß漢😀"), max_size=120) | st.text(max_size=60)


@lru_cache
def library():
    return tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={}
    )


@pytest.fixture
def reference():
    return library()


@settings(max_examples=400, deadline=None)
@given(MIXED)
def test_same_tokens_as_the_library(text):
    bpe = encoder(PATH, PATTERN)
    ids = bpe.encode(text)
    assert ids == library().encode_ordinary(text)
    assert bpe.decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(MIXED)
def test_stretches_keep_the_pieces(text):
    stretches = encoder(PATH, PATTERN).stretches
    first, *others = stretches.cut(text)
    pieces = stretches.pieces(first)
    for other in others:
        pieces += stretches.pieces(" " + other)
    assert pieces == stretches.pieces(text)


@pytest.mark.parametrize("text", ["a" * 30000, " " * 30000, "ab" * 9000, "the" * 5000, "\n" * 9000])
def test_very_long_pieces(text, reference):
    assert encoder(PATH, PATTERN).encode(text) == reference.encode_ordinary(text)


def test_rows(docs, by_id, reference):
    texts = [(1, "The cat <|endoftext|> sat."), (2, None), (3, ""), (4, "é" * 5000), (None, "x")]
    got = by_id(
        encode_decode(docs(texts), PATH, PATTERN), "n_tokens", "ids", "ids_sha256", "decoded_sha256"
    )
    for i, text in texts:
        ids = reference.encode_ordinary(text or "")
        listed = " ".join(map(str, ids)).encode()
        expected = (len(ids), ids, sha256(listed).hexdigest(), sha256((text or "").encode()).hexdigest())
        assert got[i] == expected


def test_repeated_rows_and_no_rows(docs):
    assert encode_decode(docs([(1, "a b"), (1, "a b")]), PATH, PATTERN).count() == 2
    assert encode_decode(docs([]), PATH, PATTERN).count() == 0
