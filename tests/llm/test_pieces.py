"""Candidates of the n-gram join: linked sets share a piece, and little else connects."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from tidemark.llm import ngram_join
from tidemark.workspace import Workspace


def near_pair(rng, percent):
    """Two sets just similar enough, as sorted hashes."""
    size = rng.choice([1, 2, 4, 5, 9, 30, 200])
    common = {rng.getrandbits(64) for _ in range(size)}
    differ = len(common) * (100 - percent) // percent
    left = rng.randint(0, differ)
    a = common | {rng.getrandbits(64) for _ in range(left)}
    b = common | {rng.getrandbits(64) for _ in range(differ - left)}
    assert 100 * len(a & b) >= percent * len(a | b)
    return [np.array(sorted(s), np.uint64) for s in (a, b)]


@pytest.mark.parametrize("percent", [75, 80, 95])
@pytest.mark.parametrize("more", [1, 1.25])
def test_linked_sets_share_one_of_the_keys_they_need(monkeypatch, percent, more):
    monkeypatch.setattr(ngram_join, "MORE_PIECES", more)  # with 1 many have too few
    rng = random.Random(percent)
    for _ in range(300):
        pair = near_pair(rng, percent)
        keys, sides, need = ngram_join._piece_keys(pair, percent)
        order = {k: rng.random() for k in set(keys.tolist())}
        first = []
        for side in range(4):
            own = sorted(keys[sides == side].tolist(), key=order.get)
            assert len(set(own)) == len(own)
            first.append(set(own[: int(need.ravel()[side])]))
        assert (first[0] | first[1]) & (first[2] | first[3])


def test_common_phrases_make_no_large_block(spark):
    """Pairs of near copies, of which some documents share rare phrases, are blocks each."""
    rng = random.Random(5)
    phrases = [[f"p{k}x{j}" for j in range(5)] for k in range(300)]
    rows = []
    for pair in range(30):
        words = [f"d{pair}w{k}" for k in range(1000)]
        rows.append((2 * pair, " ".join(words)))
        own = [words[50 * k : 50 * k + 50] for k in range(20)]
        own = [w for block in own for w in (*block, *phrases[rng.randrange(300)])]
        rows.append((2 * pair + 1, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with Workspace(spark) as w:
        blocks = ngram_join._candidates(df, w, 5, 75)[3]
        assert blocks.groupBy("root").count().agg({"count": "max"}).first()[0] <= 4


def test_packed_parts_do_not_grow_with_the_buckets():
    rng = random.Random(6)
    texts = [" ".join(str(rng.getrandbits(40)) for _ in range(300)) for _ in range(400)]
    batch = pa.record_batch({"doc_id": pa.array(range(400), pa.int64()), "text": texts})
    every = SimpleNamespace(value=(10, np.full(16, 2**64 - 1, np.uint64)))

    def sizes(bits):
        rows = pa.Table.from_batches(ngram_join._pack(5, bits, every)([batch])).to_pylist()
        return sum(len(r["hashes"]) for r in rows), sum(len(r["owners"]) for r in rows)

    assert sizes(6) == sizes(12) == (4 * 400 * 296, 16 * 400)


@pytest.mark.parametrize("bits", [6, 12])
def test_shared_shingles_are_counted_across_parts(monkeypatch, bits):
    monkeypatch.setattr(ngram_join, "PART_ROWS", 8)
    rng = random.Random(bits)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(5, 30))) for _ in range(60)]
    texts += [" ".join(f"{k}w{j}" for j in range(40)) for k in range(3)]
    batch = pa.record_batch({"doc_id": pa.array(range(63), pa.int64()), "text": texts})
    every = SimpleNamespace(value=(10, np.full(16, 2**64 - 1, np.uint64)))
    packed = pa.Table.from_batches(ngram_join._pack(5, bits, every)([batch]))
    counted = [
        ngram_join._count_shared(packed.filter(pa.compute.equal(packed["bucket"], b)))
        for b in pa.compute.unique(packed["bucket"]).to_pylist()
    ]
    counted = pa.concat_tables(counted)
    found = set()
    for part in pa.compute.unique(counted["part"]).to_pylist():
        rows = counted.filter(pa.compute.equal(counted["part"], part))
        found |= set(ngram_join._enough(rows, 80)["class"].to_pylist())
    sets = {ngram_join.class_of(s): s for s in ngram_join.shingle_sets(pa.array(texts), 5)}
    held = [set(s.tolist()) for s in sets.values()]
    for (name, own), mine in zip(sets.items(), held, strict=True):
        others = set().union(*(s for s in held if s is not mine))
        if 100 * len(mine & others) >= 80 * len(own):
            assert name in found
        elif len(own) == 36:
            assert name not in found
