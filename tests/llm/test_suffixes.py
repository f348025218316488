"""Two-stage suffix sorting against plain sorting."""

import numpy as np
import pytest

from tidemark.llm import suffixes


def case(seed):
    rng = np.random.Generator(np.random.PCG64(seed))
    letters = int(rng.integers(1, 5))
    texts = []
    for _ in range(int(rng.integers(1, 8))):
        t = rng.integers(0, letters, int(rng.integers(1, 60))).astype(np.uint8)
        if texts and rng.random() < 0.5:
            old = texts[int(rng.integers(len(texts)))]
            t = np.concatenate([t[: len(t) // 3], old, t[len(t) // 3 :]])
        texts.append(t * (255 // letters) + (255 % letters))
    return texts


@pytest.mark.parametrize("seed", range(60))
def test_suffixes_and_prefixes(seed):
    texts = case(seed)
    data = np.concatenate(texts)
    lengths = np.array([len(t) for t in texts])
    start, end = suffixes.bounds_of(lengths)
    raw = data.tobytes()
    expected = sorted(range(len(raw)), key=lambda i: (raw[i : end[i]], i))
    found = suffixes.suffix_array(data, lengths)
    assert found.tolist() == expected
    shared, above = suffixes.common_prefixes(data, lengths, found)
    for a, b in zip(expected, expected[1:]):
        n = 0
        while a + n < end[a] and b + n < end[b] and raw[a + n] == raw[b + n]:
            n += 1
        assert (shared[b], above[b]) == (n, a)
    for length in (1, 3, 9):
        grams = {}
        for i in range(len(raw)):
            if i + length <= end[i]:
                grams.setdefault(raw[i : i + length], []).append(i)
        twice = {i for places in grams.values() if len(places) > 1 for i in places}
        assert set(np.flatnonzero(suffixes.repeated(data, lengths, length)).tolist()) == twice


def test_only_suffixes_smaller_than_their_successors_are_sorted(monkeypatch):
    """Without the induced ones the order is lost: the second stage makes it."""
    data = np.frombuffer(b"mississippi banana bandana", np.uint8)
    flags = suffixes.smaller_than_successor(data, np.full(len(data), len(data)))
    raw = data.tobytes()
    assert flags.tolist() == [raw[i:] < raw[i + 1 :] for i in range(len(raw))]
    assert 0 < flags.sum() < len(raw) / 2
