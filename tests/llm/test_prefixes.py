"""Edges found within a batch do not meet in one group, and buckets grow with the input."""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from tidemark.llm import ngram_join


def test_local_edges_travel_apart(monkeypatch):
    monkeypatch.setattr(ngram_join, "EDGE_ROWS", 4)
    base = np.arange(1, 41, dtype=np.uint64) << np.uint64(54)
    sets = [np.append(base, np.uint64(2**64 - 1 - k)) for k in range(20)]
    batch = pa.record_batch(
        {"class": pa.array(range(20), pa.int64()), "shingles": [s.tobytes() for s in sets]}
    )
    level = SimpleNamespace(value=np.zeros(ngram_join.COUNTERS, np.uint8))
    rows = [r for b in ngram_join._prefixes(level, 80, 8)([batch]) for r in b.to_pylist()]
    edges = [r for r in rows if r["bucket"] is None]
    assert all(not r["keys"] and len(r["a"]) <= 8 * 4 for r in edges)
    assert all(r["keys"] and not r["a"] for r in rows if r["bucket"] is not None)
    assert max(r["bucket"] for r in rows if r["bucket"] is not None) < 256
    found = pa.Table.from_batches(
        ngram_join._edges([pa.RecordBatch.from_pylist([{c: r[c] for c in "ab"} for r in edges])])
    )
    assert {x for r in found.to_pylist() for x in r.values()} == set(range(20))


def test_buckets_grow():
    assert ngram_join._key_bits(0) == 6
    assert ngram_join._key_bits(1 << 28) == 8
