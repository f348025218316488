"""Suffix array of a block of texts by two-stage sorting, and common prefixes.

Texts lie behind each other; a suffix ends with its text, and the end sorts before every
byte, that of an earlier text first. Only suffixes smaller than their successor (the
suffix one byte on) are sorted directly. The others are induced: scanning the buckets of
first bytes in order, the suffix before each scanned one joins the bucket of its own
first byte if it is larger than the scanned one.
"""

from __future__ import annotations

import numpy as np


def bounds_of(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of the text that each byte is in."""
    ends = np.cumsum(lengths)
    return np.repeat(ends - lengths, lengths), np.repeat(ends, lengths)


def smaller_than_successor(data: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Flags per suffix; the last one of a text is larger than what follows it."""
    n = len(data)
    order = np.full(n, -1, np.int8)
    order[:-1] = np.sign(data[1:].astype(np.int16) - data[:-1])
    order[np.flatnonzero(np.arange(1, n + 1) == end)] = -1
    # Among equal bytes, the first different one decides.
    decided = np.where(order != 0, np.arange(n), n)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    return order[decided] > 0


def suffix_array(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All suffixes of the texts in order; every text has a byte at least."""
    start, end = bounds_of(lengths)
    small = np.flatnonzero(smaller_than_successor(data, end))
    text = data.tobytes().decode("latin-1")
    keys = [text[a:b] for a, b in zip(small.tolist(), end[small].tolist(), strict=True)]
    # Stable: equal suffixes, of different texts, stay in the order of their texts.
    small = small[sorted(range(len(keys)), key=keys.__getitem__)]
    del keys
    cuts = np.searchsorted(data[small], np.arange(257))

    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def hand_out(suffixes: np.ndarray, byte: np.ndarray) -> None:
        order = np.argsort(byte, kind="stable")
        suffixes, byte = suffixes[order], byte[order]
        for first in np.flatnonzero(np.diff(byte, prepend=-1)):
            last = np.searchsorted(byte, byte[first], "right")
            waiting[byte[first]].append(suffixes[first:last])

    ends = np.cumsum(lengths)
    hand_out(ends - 1, data[ends - 1].astype(np.int16))
    out = []
    for c in range(256):
        bucket = []
        # A suffix that starts with the same byte again joins behind those scanned.
        now = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        while len(now):
            bucket.append(now)
            now = now[now > start[now]] - 1
            now = now[data[now] == c]
        bucket.append(small[cuts[c] : cuts[c + 1]])
        waiting[c] = []
        bucket = np.concatenate(bucket)
        out.append(bucket)
        before = bucket[bucket > start[bucket]] - 1
        byte = data[before].astype(np.int16)
        larger = byte > c
        if larger.any():
            hand_out(before[larger], byte[larger])
    return np.concatenate(out)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number (zeros behind the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data), "<u8", padded.data, 0, (1,)).copy()


def common_prefixes(data: np.ndarray, lengths: np.ndarray, suffixes: np.ndarray):
    """Per place the length its suffix shares with the one before it in order, and the
    place of that one (-1 for the first).

    Where the bytes before both suffixes agree, the length is one less than that of the
    place before; only at the other places bytes are compared.
    """
    start, end = bounds_of(lengths)
    places = np.arange(len(data))
    above = np.full(len(data), -1, np.int64)
    above[suffixes[1:]] = suffixes[:-1]
    inner = (above >= 0) & (places > start) & (above > start[above])
    same = np.zeros(len(data), bool)
    same[inner] = data[places[inner] - 1] == data[above[inner] - 1]
    compared = np.flatnonzero(~same & (above >= 0))
    limit = np.minimum(end[compared] - compared, end[above[compared]] - above[compared])
    words = _words(data)
    found = np.zeros(len(compared), np.int64)
    active = np.arange(len(compared))
    while len(active):
        a = compared[active] + found[active]
        b = above[compared[active]] + found[active]
        x = words[a] ^ words[b]
        low = (x & (~x + np.uint64(1))).astype(np.float64)
        equal = np.where(x == 0, 8, np.log2(np.maximum(low, 1)).astype(np.int64) // 8)
        found[active] += equal
        active = active[(equal == 8) & (found[active] < limit[active])]
    shared = np.zeros(len(data), np.int64)
    shared[compared] = np.minimum(found, limit)
    # The place each length counts down from.
    source = np.maximum.accumulate(np.where(same, 0, places))
    return shared[source] - (places - source) * same, above


def repeated(data: np.ndarray, lengths: np.ndarray, length: int) -> np.ndarray:
    """Flags of the places whose next ``length`` bytes start at another place too."""
    suffixes = suffix_array(data, lengths)
    shared, above = common_prefixes(data, lengths, suffixes)
    out = np.zeros(len(data), bool)
    long = np.flatnonzero(shared >= length)
    out[long] = True
    out[above[long]] = True
    return out
