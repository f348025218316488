import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import rans, token_files


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 70000), max_size=3000), st.integers(1, 50))
def test_round_trip(ids, repeat):
    ids = np.array(ids * repeat, np.uint32)
    names = np.arange(3)
    lengths = np.array([0, len(ids) // 2, len(ids) - len(ids) // 2])
    raw = token_files.pack(names, np.array([True, False, False]), lengths, ids)
    names2, null, lengths2, ids2 = token_files.unpack(raw)
    assert names2.tolist() == [0, 1, 2] and null.tolist() == [True, False, False]
    assert lengths2.tolist() == lengths.tolist()
    assert np.array_equal(ids, ids2)


@pytest.fixture(scope="module")
def block():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 400_000), 60_000).astype(np.uint32)
    coder = rans.Coder(rans.Table.fit(np.bincount(ids)))
    return ids, coder, coder.encode(ids)


def test_segments_decode_alone(block):
    ids, coder, raw = block
    count = coder.segments(raw)
    assert count > 2
    parts = [coder.decode_segment(raw, k) for k in reversed(range(count))]
    assert np.array_equal(np.concatenate(parts[::-1]), ids)


def test_size_is_near_the_entropy(block):
    ids, _, raw = block
    p = np.bincount(ids) / len(ids)
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * len(ids) / 8
    assert len(raw) < 1.1 * entropy + 60_000


def test_changed_bytes_are_found(block):
    _, coder, raw = block
    for at in (len(raw) // 2, len(raw) - 5):
        broken = bytearray(raw)
        broken[at] ^= 1
        with pytest.raises((rans.CorruptFile, IndexError)):
            coder.decode(bytes(broken))


def test_changed_files_are_found():
    raw = token_files.pack(
        np.arange(1), np.zeros(1, bool), np.array([5]), np.array([1, 2, 1, 1, 2], np.uint32)
    )
    for at in range(0, len(raw), 7):
        broken = bytearray(raw)
        broken[at] ^= 64
        with pytest.raises(Exception):
            token_files.unpack(bytes(broken))


def test_tables_sum_up_with_many_rare_symbols():
    counts = np.ones(60_000, np.int64)
    counts[7] = 10**9
    table = rans.Table.fit(counts)
    assert table.freq.sum() == 1 << table.bits and table.freq.min() == 1
    again = rans.Table.unpack(table.pack())
    assert np.array_equal(again.freq, table.freq) and np.array_equal(again.symbols, table.symbols)
