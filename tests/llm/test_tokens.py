import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import registry, tokens

PIECES = ["<|endoftext|>", "\n\n", "  ", "'s", "'ll", " \n", " ", " ", "don't", "é", "日本"]
TEXTS = st.lists(
    st.lists(st.sampled_from([*"ab, .\n\t' 1sS\r!?é\x85\x1c", *PIECES]), max_size=30).map("".join),
    max_size=6,
)


@pytest.fixture(scope="module")
def encoder():
    return tokens.Encoder(registry.tokenizer_path())


def library(encoder, texts):
    found = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    return [len(e.ids) for e in found], [i for e in found for i in e.ids]


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_ids_are_the_librarys(encoder, texts):
    assert encoder.in_pieces
    counts, ids = encoder.encode(pa.array(texts, pa.string()))
    assert (counts.tolist(), ids.tolist()) == library(encoder, texts)


def test_null_is_empty_and_memory_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    texts = [None, "one two three four five six seven", "", "eight nine ten eleven twelve"]
    counts, ids = encoder.encode(pa.array(texts))
    assert (counts.tolist(), ids.tolist()) == library(encoder, [t or "" for t in texts])


@pytest.mark.parametrize("text", ["word, other. é\n" * 400, "x" * 3000, " " * 2000 + "a\n" * 500])
def test_long_texts_are_cut_at_safe_places(encoder, monkeypatch, text):
    monkeypatch.setattr(tokens, "BATCH_BYTES", 500)
    counts, ids = encoder.encode(pa.array([text]))
    assert (counts.tolist(), ids.tolist()) == library(encoder, [text])


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_counts_of_whole_texts(name):
    made = tokens.Encoder(registry.tokenizer_path(name), keep_ids=False)
    texts = ["Hello there, World.", "", "a  b\n\nc <|endoftext|> d"]
    counts, ids = made.encode(pa.array(texts))
    assert counts.tolist() == library(made, texts)[0]
    assert ids is None or not len(ids)


@pytest.mark.parametrize("kind", [lambda a, b: np.zeros(len(a), np.uint64), lambda a, b: b - a])
def test_equal_hashes_fall_back_to_whole_texts(encoder, monkeypatch, kind):
    """All pieces with one hash, and those of one length: bytes tell them apart."""
    encoder._forget()
    monkeypatch.setattr(
        tokens, "quick_hashes", lambda data, a, b: kind(a, b).astype(np.uint64)
    )
    for texts in (["one three", "five sixty seventy"], ["one two six", "the fat cat"]):
        counts, ids = encoder.encode(pa.array(texts))
        assert (counts.tolist(), ids.tolist()) == library(encoder, texts)
    encoder._forget()


def test_pieces_met_again_are_remembered(encoder, monkeypatch):
    encoder._forget()
    monkeypatch.setattr(tokens, "REMEMBERED", 40)
    for k in range(30):
        texts = [f"the same old words and new{k} other{k}, words{k}.", "the same"]
        counts, ids = encoder.encode(pa.array(texts))
        assert (counts.tolist(), ids.tolist()) == library(encoder, texts)
        assert len(encoder.hashes) <= 40
    known = bytes(encoder.bytes)
    assert b" same" in known and b" old" in known and b" new3 " not in known
    encoder._forget()


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_decoded_texts_are_the_librarys(name):
    made, read = tokens.Encoder(registry.tokenizer_path(name)), tokens.decoder(registry.tokenizer_path(name))
    texts = ["Hello there, World.", "", "a  b\n\nc <|endoftext|> d", "日本 é \x00 ­ ÿ Ā", "x" * 50]
    counts, ids = made.encode(pa.array(texts))
    ends = np.cumsum(counts)
    expected = [
        read.tokenizer.decode(ids[a:b].tolist(), skip_special_tokens=False)
        for a, b in zip(ends - counts, ends, strict=True)
    ]
    assert read.decode(ids, counts) == expected
    if read.by_bytes:
        assert expected == texts
