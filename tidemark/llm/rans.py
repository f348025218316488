"""Static range asymmetric numeral systems over many interleaved lanes.

A block holds up to BLOCK symbols. Lane i codes the symbols i, i + lanes, ...;
every state stays in [2**31, 2**63) and gives out or takes in 32 bits at most
per symbol. Encoding runs backwards, so decoding reads the words forwards.
Every SEGMENT steps the block keeps a checkpoint, the lanes' states and the
place in the words, from which that segment decodes alone; each segment has a
checksum of its symbols.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

U64 = np.uint64
BLOCK = 1 << 20
LANES = 2048
SEGMENT = 128
_LOW = U64(1 << 31)
_WORD = U64(0xFFFFFFFF)


class CorruptFile(ValueError):
    pass


@dataclass
class Table:
    """Frequencies that sum to 2**bits, of the symbols that occur."""

    symbols: np.ndarray
    freq: np.ndarray
    bits: int

    @classmethod
    def fit(cls, counts: np.ndarray) -> Table:
        symbols = np.flatnonzero(counts)
        counts = counts[symbols]
        bits = max(20, int(2 * len(symbols)).bit_length())
        whole = 1 << bits
        freq = np.maximum(1, counts * (whole / max(1, counts.sum()))).astype(np.int64)
        over = int(freq.sum()) - whole
        if over < 0:
            freq[np.argmax(freq)] -= over
        elif over > 0:  # the rarest were raised to 1; the most frequent give way
            order = np.argsort(-freq, kind="stable")
            room = freq[order] - 1
            before = np.cumsum(room) - room
            freq[order] -= np.clip(over - before, 0, room)
        return cls(symbols.astype(np.uint32), freq.astype(np.uint32), bits)

    @property
    def starts(self) -> np.ndarray:
        return (np.cumsum(self.freq, dtype=np.int64) - self.freq).astype(U64)

    def pack(self) -> bytes:
        head = struct.pack("<BI", self.bits, len(self.symbols))
        return head + zlib.compress(
            np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4").tobytes()
            + self.freq.astype("<u4").tobytes()
        )

    @classmethod
    def unpack(cls, raw: bytes) -> Table:
        bits, n = struct.unpack_from("<BI", raw)
        both = np.frombuffer(zlib.decompress(raw[5:]), "<u4")
        return cls(np.cumsum(both[:n], dtype=np.uint32), both[n:], bits)


class Coder:
    """Encodes and decodes blocks with one table."""

    def __init__(self, table: Table):
        self.table = table
        self.bits = U64(table.bits)
        self.freq = table.freq.astype(U64)
        self.starts = table.starts
        self.rank: np.ndarray | None = None
        self.slots: np.ndarray | None = None

    def encode(self, ids: np.ndarray) -> bytes:
        if self.rank is None:
            self.rank = np.zeros(int(self.table.symbols[-1]) + 1, np.int64)
            self.rank[self.table.symbols] = np.arange(len(self.table.symbols))
        ranks = self.rank[ids]
        n = len(ids)
        lanes = 1 << min(LANES.bit_length() - 1, max(0, (n // 512).bit_length() - 1))
        steps = -(-n // lanes)
        limit = U64(63) - self.bits
        x = np.full(lanes, _LOW)
        chunks, states, emitted, used = [], [], [], 0
        for t in reversed(range(steps)):
            s = ranks[t * lanes : (t + 1) * lanes]
            f, now = self.freq[s], x[: len(s)]
            full = now >= (f << limit)
            out = now[full]
            chunks.append((out & _WORD).astype(np.uint32))
            used += len(out)
            now = np.where(full, now >> U64(32), now)
            high = now // f
            x[: len(s)] = (high << self.bits) + (now - high * f) + self.starts[s]
            if t % SEGMENT == 0:
                states.append(x.copy())
                emitted.append(used)
        words = np.concatenate(chunks[::-1])
        places = used - np.array(emitted[::-1])
        span = SEGMENT * lanes
        checks = [zlib.crc32(ids[k : k + span].astype("<u4")) for k in range(0, n, span)]
        head = struct.pack("<IIII", n, lanes, SEGMENT, len(words))
        return b"".join(
            [
                head,
                places.astype("<u4").tobytes(),
                np.array(checks, "<u4").tobytes(),
                np.concatenate(states[::-1]).astype("<u8").tobytes(),
                words.astype("<u4").tobytes(),
            ]
        )

    def segments(self, block: bytes) -> int:
        n, lanes, segment, _ = struct.unpack_from("<IIII", block)
        return -(-n // (lanes * segment))

    def decode_segment(self, block: bytes, k: int) -> np.ndarray:
        """Symbols of one segment, from its checkpoint on."""
        if self.slots is None:
            self.slots = np.repeat(
                np.arange(len(self.freq), dtype=np.uint32), self.table.freq
            )
        n, lanes, segment, n_words = struct.unpack_from("<IIII", block)
        count = -(-n // (lanes * segment))
        places = np.frombuffer(block, "<u4", count, 16)
        checks = np.frombuffer(block, "<u4", count, 16 + 4 * count)
        at = 16 + 8 * count
        x = np.frombuffer(block, "<u8", lanes, at + 8 * lanes * k).copy()
        words = np.frombuffer(block, "<u4", n_words, at + 8 * lanes * count)
        mask = U64((1 << self.table.bits) - 1)
        first, last = k * segment * lanes, min(n, (k + 1) * segment * lanes)
        out = np.empty(last - first, np.uint32)
        place = int(places[k])
        for a in range(0, last - first, lanes):
            now = x[: min(lanes, last - first - a)]
            slot = now & mask
            s = self.slots[slot]
            out[a : a + len(now)] = s
            now = self.freq[s] * (now >> self.bits) + slot - self.starts[s]
            low = np.flatnonzero(now < _LOW)
            more = words[place : place + len(low)]
            if len(more) < len(low):
                raise CorruptFile("a segment ends early")
            now[low] = (now[low] << U64(32)) | more.astype(U64)
            place += len(low)
            x[: len(now)] = now
        # Where a segment ends the next one's checkpoint stands, or the start of encoding.
        after = _LOW
        if k + 1 < count:
            after = np.frombuffer(block, "<u8", lanes, at + 8 * lanes * (k + 1))
        if place != (places[k + 1] if k + 1 < count else n_words) or (x != after).any():
            raise CorruptFile("a segment ends in another state")
        ids = self.table.symbols[out]
        if zlib.crc32(ids.astype("<u4")) != checks[k]:
            raise CorruptFile("a segment's checksum differs")
        return ids

    def decode(self, block: bytes) -> np.ndarray:
        return np.concatenate(
            [self.decode_segment(block, k) for k in range(self.segments(block))]
        )
