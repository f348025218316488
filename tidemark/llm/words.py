"""Words and word windows of Arrow text columns, vectorised in numpy.

Texts stay UTF-8 bytes. A word is a maximal run of word bytes inside one text;
every byte of a multi-byte character is a word byte. Hashes are polynomials modulo
the prime 2**61 - 1, spread over 64 bits at the end: two different spans of n values
have equal ones for at most n of the 2**61 bases. A power of two as modulus has no such
bound: strings that repeat in the manner of Thue and Morse are equal under it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64

#: Text bytes handled at once; numpy needs about sixty bytes for each of them.
SLICE_BYTES = 1 << 19


def byte_set(ranges: str) -> np.ndarray:
    """A table of 256 flags: all bytes but those in ``ranges`` (a character set)."""
    table = np.ones(256, bool)
    table[[ord(c) for c in ranges]] = False
    return table


#: `[^\x20\x09-\x0D]+`
BLANK = "\x09\x0a\x0b\x0c\x0d\x20"
SPACED = byte_set(BLANK)
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after lower-casing A-Z
ALNUM = byte_set(
    "".join(map(chr, [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
)
_UPPER = np.arange(ord("A"), ord("Z") + 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[_UPPER] += 32

#: A prime, so that few bases make two given spans equal.
PRIME = (1 << 61) - 1
_P, _31, _30 = U64(PRIME), U64(31), U64(30)
_LOW31, _LOW30 = U64((1 << 31) - 1), U64((1 << 30) - 1)
_BASES = {"byte": 0x0A3B1E6C2D94F857, "word": 0x13F0C5D97B6A8E21}
_powers: dict[str, tuple[np.ndarray, ...]] = {}


def _reduced(x: np.ndarray) -> np.ndarray:
    """Any 64-bit values modulo PRIME."""
    x = (x & _P) + (x >> U64(61))
    return np.minimum(x, x - _P)  # below PRIME the difference wraps round


def _times_2_31(x: np.ndarray) -> np.ndarray:
    """x * 2**31 for x below PRIME, where 2**61 is one; below 2**62."""
    return ((x & _LOW30) << _31) + (x >> _30)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo PRIME, by limbs of 30 and 31 bits."""
    a1, a0, b1, b0 = a >> _31, a & _LOW31, b >> _31, b & _LOW31
    middle = a1 * b0 + a0 * b1  # below 2**62
    # 2**61 and 2**62, then 2**32 and 2**61: below 2**64 together
    return _reduced(((a1 * b1) << U64(1)) + a0 * b0 + _times_2_31(middle))


def _power_tables(kind: str, n: int) -> tuple[np.ndarray, ...]:
    """The first n powers of the base and of its inverse modulo PRIME, and the high and
    low limbs of the former."""
    have = _powers.get(kind)
    if have is None or len(have[0]) < n:
        size = 1 << max(n - 1, (1 << 16) - 1).bit_length()
        base = _BASES[kind]
        tables = []
        for b in (base, pow(base, -1, PRIME)):
            table = np.ones(size, U64)
            done = 1
            while done < size:  # by doubling: the powers so far times base**done
                factor = np.full(done, pow(b, done, PRIME), U64)
                table[done : 2 * done] = _product(table[:done], factor)
                done *= 2
            tables.append(table)
        up, down = tables
        have = _powers[kind] = (up, down, up >> _31, up & _LOW31)
        if size > 8 * SLICE_BYTES:  # one huge text: don't keep its tables
            del _powers[kind]
    return tuple(table[:n] for table in have)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x + U64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values without repeats (by sorting, which is faster here than hashing)."""
    ordered = np.sort(values)
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered[new]


#: Values summed up before their sums could leave 64 bits.
_SAFE = 1 << 24


def _running(terms: np.ndarray) -> np.ndarray:
    out = np.zeros(len(terms) + 1, U64)
    np.cumsum(terms, out=out[1:])
    return out


def _running_reduced(limb: np.ndarray) -> np.ndarray:
    """Running sums of small values modulo PRIME, whatever their number."""
    out = np.zeros(len(limb) + 1, U64)
    for a in range(0, len(limb), _SAFE):
        part = np.cumsum(limb[a : a + _SAFE])
        out[a + 1 : a + 1 + len(part)] = _reduced(_reduced(part) + out[a])
    return out


def _spans(values: np.ndarray, kind: str, first: np.ndarray, last: np.ndarray):
    """Hashes of values[first:last], whatever their place; values fit 8 bits if
    ``kind`` is byte, else 64.

    The difference of two running sums holds the span's values times powers from
    ``first`` on; the inverse power takes these to zero.
    """
    up, down, up_high, up_low = _power_tables(kind, len(values) + 1)
    if kind == "byte":
        terms = values.astype(U64)
        terms += U64(1)
        high, low = terms * up_high[:-1], terms * up_low[:-1]  # below 2**40
    else:
        terms = _product(_reduced(values), up[:-1])
        high, low = terms >> _31, terms & _LOW31
    if len(values) <= _SAFE:
        high, low = _running(high), _running(low)
        high, low = high[last] - high[first], low[last] - low[first]
    else:
        high, low = _running_reduced(high), _running_reduced(low)
        high, low = high[last] + _P - high[first], low[last] + _P - low[first]
    total = _reduced(_times_2_31(_reduced(high)) + _reduced(low))
    return _product(total, down[first])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    return offsets - lo, data[lo:hi]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``limit`` text bytes, one row at least."""
    col = batch.column(column)
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    at = np.frombuffer(col.buffers()[1], np.int64)
    at = at[col.offset : col.offset + len(col) + 1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(at, at[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


@dataclass
class Words:
    """Words of consecutive texts.

    Word i takes bytes start[i]:end[i]; text d has the words bound[d]:bound[d+1].
    """

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bound: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bound)

    def text_of(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self) -> np.ndarray:
        return mix(_spans(self.data, "byte", self.start, self.end))

    def block_hashes(self) -> np.ndarray:
        """Hashes of the words by blocks of eight bytes, cheaper where words are short.

        Other ones than ``hashes``: compare them with each other only.
        """
        return block_hashes(self.data, self.start, self.end)

    def windows(self, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of n words inside one text."""
        stop = np.repeat(self.bound[1:], self.counts)
        first = np.arange(len(hashes))
        first = first[first + n <= stop]
        return first, mix(_spans(hashes, "word", first, first + n), n)


def find_words(offsets: np.ndarray, data: np.ndarray, table: np.ndarray = SPACED) -> Words:
    inside = table[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return Words(data, offsets, start, end, np.searchsorted(start, offsets))


def lines(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all \\n-split lines, and the first line of each text."""
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([offsets[:-1], breaks + 1])
    # A text that starts where another ends sorts behind that text's last line.
    owner = np.concatenate(
        [np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1]
    )
    order = np.lexsort((start, owner))
    start, owner = start[order], owner[order]
    bound = np.searchsorted(owner, np.arange(len(offsets)))
    end = np.empty_like(start)
    end[:-1] = start[1:] - 1
    last = bound[1:] - 1
    end[last] = offsets[1:]
    return start, end, bound


_ODD = 0x9E3779B97F4A7C15
_odd_powers: list[np.ndarray] = []


def quick_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of spans, modulo 2**64: cheap, but made spans can have equal
    ones, so bytes must be compared before two spans count as equal."""
    n = len(data) + 1
    if not _odd_powers or len(_odd_powers[0]) < n:
        tables = []
        for b in (_ODD, pow(_ODD, -1, 1 << 64)):
            table = np.full(max(n, 1 << 16), b, U64)
            table[0] = 1
            tables.append(np.cumprod(table))
        _odd_powers[:] = tables
    up, down = _odd_powers
    sums = _running(data * up[: n - 1])
    return mix((sums[end] - sums[start]) * down[start], 2)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of any spans."""
    return mix(_spans(data, "byte", start, end), 1)


_BYTES_OF = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)
#: Longer spans are hashed as polynomials, not block by block.
_BLOCK_SPAN = 64


def block_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of spans: each block of eight is mixed into the last ones' hash.

    Two spans of one length up to eight bytes never have equal ones, as ``mix`` is a bijection.
    """
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    blocks = np.ndarray(len(data) + 1, "<u8", padded.data, 0, (1,))
    size = end - start
    first = blocks[start] & _BYTES_OF[np.minimum(size, 8)]
    out = mix(first ^ (size.astype(U64) * U64(_ODD)), 7)
    more = np.flatnonzero((size > 8) & (size <= _BLOCK_SPAN))
    at = 8
    while len(more):
        block = blocks[start[more] + at] & _BYTES_OF[np.minimum(size[more] - at, 8)]
        out[more] = mix(out[more] ^ block, 7)
        at += 8
        more = more[size[more] > at]
    large = np.flatnonzero(size > _BLOCK_SPAN)
    if len(large):
        out[large] = span_hashes(data, start[large], end[large])
    return out
