"""Repeated passages against counting every string."""

import hashlib
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.llm import registry, suffix_dedup
from tidemark.workspace import Workspace

SF_DIR = "/root/testdata/sf0.01"


def brute(texts, length):
    """Per text (n_bytes, n_removed, n_spans, kept)."""
    raws = [(t or "").encode() for t in texts]
    seen = {}
    for raw in raws:
        for i in range(len(raw) - length + 1):
            gram = hashlib.blake2b(raw[i : i + length], digest_size=16).digest()
            seen[gram] = seen.get(gram, 0) + 1
    out = []
    for raw in raws:
        flags = bytearray(len(raw))
        end = 0
        for i in range(len(raw) - length + 1):
            gram = hashlib.blake2b(raw[i : i + length], digest_size=16).digest()
            if seen[gram] > 1:
                for k in range(max(i, end), i + length):
                    flags[k] = 1
                end = i + length
        kept = bytes(b for b, f in zip(raw, flags, strict=True) if not f)
        spans = sum(f and not (k and flags[k - 1]) for k, f in enumerate(flags))
        out.append((len(raw), sum(flags), spans, kept))
    return out


def found(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    df = df.withColumns({c: F.lit(c) for c in ("uid", "repeats_", "key", "odd.name", "spans")})
    with Workspace(spark) as w:
        rows = suffix_dedup.with_repeats(df, w, name="r", **options).select("id", "r.*").collect()
    for r in rows:
        assert r.n_removed == sum(s.hi - s.lo for s in r.spans)
    rows = {r.id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows}
    return [rows[k] for k in range(len(texts))]


def prose(rng, n, words=3000):
    return " ".join(f"w{rng.randrange(words)}é" if rng.random() < 0.1 else f"w{rng.randrange(words)}" for _ in range(n))


def mixture(rng):
    passage = prose(rng, 120)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(12)]
    for k in range(6):
        a, b = sorted(rng.sample(range(len(passage)), 2))
        cut = passage[a:b]
        texts.append(prose(rng, rng.randint(0, 60)) + cut + prose(rng, rng.randint(0, 60)))
        texts.append(cut + passage[b - 1 :] + passage[:40])
    words = texts[3].split(" ")
    for k in (10, len(words) // 2):
        near = list(words)
        near[min(k, len(near) - 1)] = "other"
        texts.append(" ".join(near))
    texts += ["a" * 900, "a" * 399, "b" * 400, "b" * 400, "ab" * 500, "", None, texts[0], texts[0]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", range(2))
def test_mixtures(spark, seed):
    texts = mixture(random.Random(seed))
    assert found(spark, texts) == brute(texts, 400)


def test_hot_anchors_small_blocks_and_parts_of_long_texts(spark):
    """Every group split down to single places, and texts read in parts."""
    texts = mixture(random.Random(9))
    expected = brute(texts, 400)
    assert found(spark, texts, most=1, block_bytes=1) == expected
    assert found(spark, texts, most=2, widths=(40, 1), slice_bytes=1000) == expected


def test_shorter_passages(spark):
    texts = [prose(random.Random(k % 3), 9) + str(k) for k in range(9)] + ["x" * 70, "y"]
    assert found(spark, texts, length=40) == brute(texts, 40)


def test_suffix_arrays_decide(spark, monkeypatch):
    """Overlaps of texts that differ around them come from the arrays alone."""
    rng = random.Random(4)
    passage = prose(rng, 130)
    texts = [prose(rng, 40) + passage + prose(rng, 40) for _ in range(3)]
    expected = brute(texts, 400)
    assert all(r[1] >= 400 for r in expected)
    with Workspace(spark) as w:
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        pieces = suffix_dedup.with_repeats(df, w, widths=()).select("repeats.n_removed")
        assert sorted(r[0] for r in pieces.collect()) != sorted(r[1] for r in expected)
    assert found(spark, texts) == expected


def test_empty_table_and_texts_without_repeats(spark):
    df = spark.createDataFrame([(1, "x" * 399), (2, None)], "id long, text string")
    with Workspace(spark) as w:
        out = suffix_dedup.without_repeats(df, w)
        assert sorted(map(tuple, out.collect())) == [(1, "x" * 399), (2, None)]
        assert suffix_dedup.with_repeats(df.filter("false"), w).count() == 0
        twice = spark.createDataFrame([("é" * 300,)] * 2, "text string")
        assert {r.text for r in suffix_dedup.without_repeats(twice, w).collect()} == {""}


def test_whole_table(spark):
    rows = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    expected = {
        r["doc_id"]: (n, removed, spans, hashlib.sha256(kept).hexdigest())
        for r, (n, removed, spans, kept) in zip(rows, brute([r["text"] for r in rows], 400), strict=True)
    }
    out = registry.queries()["op13_suffix_dedup"](spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == expected
    assert sum(r.n_removed > 0 for r in out) > 50
