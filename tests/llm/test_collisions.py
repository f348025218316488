"""Texts that a polynomial modulo a power of two can't tell apart."""

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import (
    decontaminate,
    line_dedup,
    ngram_join,
    quality_rules,
    registry,
    token_counts,
    token_files,
    tokens,
    words,
)
from tidemark.workspace import Workspace

LETTERS = [("a", "b"), ("e", "t"), ("0", "1")]


def morse(size, one, two):
    return "".join(one if k.bit_count() % 2 == 0 else two for k in range(size))


def pair(size, letters):
    one, two = letters
    return morse(size, one, two), morse(size, two, one)


@pytest.mark.parametrize("power", range(8, 15))
@pytest.mark.parametrize("letters", LETTERS)
def test_hashes_differ(power, letters):
    texts = pair(1 << power, letters)
    offsets, data = words.text_bytes(pa.array(texts))
    found = words.find_words(offsets, data).hashes()
    assert found[0] != found[1]
    spans = words.span_hashes(data, offsets[:-1], offsets[1:])
    assert spans[0] != spans[1]
    # as sequences of words too
    told = [" ".join(t) for t in texts]
    found = words.find_words(*words.text_bytes(pa.array(told)))
    n = 1 << power
    _, windows = found.windows(found.hashes(), n)
    assert len(windows) == 2 and windows[0] != windows[1]


def test_products_and_sums_modulo_the_prime(monkeypatch):
    rng = np.random.Generator(np.random.PCG64(3))
    p = words.PRIME
    a = np.append(rng.integers(0, p, 500, dtype=np.uint64), np.array([0, p - 1, p - 1], np.uint64))
    b = np.append(rng.integers(0, p, 500, dtype=np.uint64), np.array([p - 1, p - 1, 1], np.uint64))
    assert words._product(a, b).tolist() == [
        int(x) * int(y) % p for x, y in zip(a, b, strict=True)
    ]
    data = rng.integers(0, 256, 700).astype(np.uint8)
    first = rng.integers(0, 600, 90)
    last = first + rng.integers(0, 100, 90)
    base = words._BASES["byte"]
    expected = [
        sum((int(v) + 1) * pow(base, i, p) for i, v in enumerate(data[x:y])) % p
        for x, y in zip(first, last, strict=True)
    ]
    for safe in (1 << 24, 64):
        monkeypatch.setattr(words, "_SAFE", safe)
        assert words._spans(data, "byte", first, last).tolist() == expected


@pytest.mark.parametrize("letters", LETTERS)
def test_ids_are_the_texts_own(letters):
    encoder = tokens.Encoder(registry.tokenizer_path())
    for text in pair(1024, letters):
        _, ids = encoder.encode(pa.array([text]))
        own = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == own


@pytest.fixture(scope="module")
def docs(spark):
    texts = [t for letters in LETTERS for t in pair(1024, letters)]
    filler = " ".join(f"word{k}" for k in range(12))
    texts += [f"{filler}\n{texts[0]}\n{texts[1]}"]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_operators_tell_them_apart(spark, docs):
    texts = {r.doc_id: r.text for r in docs.collect()}
    with Workspace(spark) as w:
        joined = ngram_join.ngram_components(docs, w).collect()
        assert all(r.component_id == r.doc_id and r.n_shingles >= 1 for r in joined)

        quality = quality_rules.with_quality(docs).select("quality.*").collect()
        assert all(r.n_dup_lines == 0 for r in quality)

        path = registry.tokenizer_path()
        encoder = tokens.Encoder(path)
        counted = token_counts.with_token_counts(docs, path).collect()
        for r in counted:
            own = encoder.tokenizer.encode(texts[r.doc_id], add_special_tokens=False)
            assert r.tokens.n_tokens == len(own.ids)

        files = token_files.write_token_files(docs, path, w)
        read = token_files.read_token_files(files).collect()
        assert len({r.ids_crc32 for r in read}) == len(texts)

        lines = line_dedup.summary(line_dedup.repeated_lines(docs.filter("doc_id < 6"), w))
        assert all(r.removed == "" for r in lines.collect())

        benchmark = docs.filter("doc_id = 0").withColumnRenamed("doc_id", "item_id")
        found = decontaminate.with_contamination(docs, benchmark, w, name="found")
        hit = {r.doc_id for r in found.filter("found.n_hit > 0").collect()}
        assert hit == {0, 6}


def test_windows_with_one_hash_keep_their_words(spark, monkeypatch):
    rows = pa.table(
        {"n": [1, 1, 1], "hash": [5, 5, 5], "words": [b"a", b"b", b"a"], "item": ["x", "y", "z"]}
    )
    (found,) = decontaminate._test_sets(rows)
    assert found.items == [{b"a": ["x", "z"], b"b": ["y"]}]
