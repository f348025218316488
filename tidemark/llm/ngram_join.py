"""N-gram Jaccard join: documents linked by their word shingles, as components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import signature_tree
from tidemark.llm.batches import bound_batches, give_back, tidy
from tidemark.llm.components import connected_components
from tidemark.llm.words import LOWER, distinct, find_words, mix, slices, text_bytes
from tidemark.workspace import Workspace

#: Shingles a bucket of the sharing count is planned for.
BUCKET_ROWS = 1 << 22
#: Counters of the frequency sketch, which is broadcast: 1 MB at any input size.
COUNTERS = 1 << 18
PARTS = 1024
#: The largest bitmap of documents to look at again: 2**24 bits are 2 MB.
MOST_BITS = 24
#: Classes with a block that are broadcast, 24 bytes each; more are joined by shuffle.
MOST_KNOWN = 1 << 20
#: Classes one signature tree holds, and their shingles; larger blocks are cut.
CELL_ROWS, CELL_ITEMS = 4096, 1 << 22


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Per text the sorted hashes of its distinct n-word shingles, A-Z lower-cased.

    A text with fewer words has one shingle, all of them; without words, none.
    """
    offsets, data = text_bytes(column)
    words = find_words(offsets, LOWER[data])
    hashes = words.hashes()
    first, windows = words.windows(hashes, n)
    bound = np.searchsorted(first, words.bound)
    counts = words.counts
    out = [distinct(windows[a:b]) for a, b in zip(bound[:-1], bound[1:], strict=True)]
    short = np.flatnonzero((counts > 0) & (counts < n))
    for k in sorted(set(counts[short].tolist())):
        first, windows = words.windows(hashes, k)
        at = dict(zip(first.tolist(), windows, strict=True))
        for d in short[counts[short] == k]:
            out[d] = np.array([at[int(words.bound[d])]], np.uint64)
    return out


def class_of(shingles: np.ndarray) -> int:
    """A 63-bit name of a set; 0 to 2**63 - 1."""
    digest = hashlib.blake2b(shingles.tobytes(), digest_size=8).digest()
    return int.from_bytes(digest, "little") >> 1


def _membership(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(part["text"], n)
                yield pa.record_batch(
                    {
                        "doc_id": part["doc_id"],
                        "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "class": pa.array(
                            [class_of(s) if len(s) else None for s in sets], pa.int64()
                        ),
                    }
                )

    return run


#: Shingles that are packed together.
PART_ROWS = 1 << 19

_PACK = "bucket int, part long, sent binary, hashes binary, owners binary"
_OWNERS = np.dtype([("class", np.int64), ("n", np.uint32), ("known", np.uint32)])
_COUNTED = "part long, slots binary, counts binary, owners binary"


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last place, exclusive, of each run of equal values, none of them -1."""
    first = np.flatnonzero(np.diff(values, prepend=-1))
    return zip(first.tolist(), np.append(first[1:], len(values)).tolist(), strict=True)


def _binaries(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _pack(n: int, bits: int, once):
    """Per part and bucket: entries of each of the part's classes, and their hashes.

    A shingle that two classes of the part share counts as shared at once and
    travels as a marker; so a hot shingle sends one entry per part at most,
    however many documents hold it. Names travel once, with the part's first bucket:
    the more buckets there are, the fewer entries of a class are in each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        total = 0
        for batch in batches:
            for part in slices(_filtered(batch, once), "text"):
                for s in shingle_sets(part["text"], n):
                    if len(s) and (name := class_of(s)) not in sets:
                        sets[name] = s
                        total += len(s)
                if total >= PART_ROWS:
                    yield packed(sets)
                    sets, total = {}, 0
        if sets:
            yield packed(sets)

    def packed(sets: dict[int, np.ndarray]) -> pa.RecordBatch:
        names = np.fromiter(sets, np.int64, len(sets))
        sizes = np.array([len(s) for s in sets.values()])
        owner = np.repeat(np.arange(len(names)), sizes)
        cut = np.concatenate(list(sets.values())) >> np.uint64(32 - bits)
        order = np.argsort(cut)
        ordered = cut[order]
        same = np.zeros(len(cut), bool)
        same[1:] = ordered[1:] == ordered[:-1]
        marker = ordered[1:][same[1:] & ~same[:-1]]
        same[:-1] |= same[1:]
        shared = np.empty(len(cut), bool)
        shared[order] = same
        owners = np.zeros(len(names), _OWNERS)
        owners["class"], owners["n"] = names, sizes
        owners["known"] = np.bincount(owner[shared], minlength=len(names))
        # By owner, and after the next line by bucket first; short numbers sort fastest.
        keys = np.concatenate([cut[~shared], marker])
        owner = np.concatenate([owner[~shared], np.full(len(marker), len(names))])
        bucket = (keys >> np.uint64(32)).astype(np.uint16 if bits <= 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        keys, owner, bucket = keys[order], owner[order], bucket[order].astype(np.int64)
        rest = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        # The same again when a lost task is repeated.
        part = class_of(names)
        rows = []
        for a, b in _runs(bucket):
            sent = np.bincount(owner[a:b], minlength=len(names) + 1).astype(np.uint32)
            known = owners.tobytes() if not rows else b""
            rows.append((int(bucket[a]), part, sent.tobytes(), rest[a:b].tobytes(), known))
        return _binaries(rows, _PACK)

    return run


def _count_shared(table: pa.Table) -> pa.Table:
    """Per part, which of its classes have shingles of the bucket that others hold too,
    and how many."""
    sent = [np.frombuffer(x.as_py(), np.uint32) for x in table["sent"]]
    hashes = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in table["hashes"]])
    bound = np.cumsum([0, *map(len, sent)])
    every = np.concatenate(sent)
    entry = hashes.astype(np.uint64) << np.uint64(32)
    entry |= np.repeat(np.arange(len(every), dtype=np.uint64), every)
    entry.sort()
    key = entry >> np.uint64(32)
    same = key[1:] == key[:-1]
    found = np.zeros(len(entry), bool)
    found[1:] |= same
    found[:-1] |= same
    at = (entry[found] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    shared = np.bincount(at, minlength=len(every)).astype(np.uint32)
    del entry, key, same, found, at, hashes, every
    give_back()
    rows = []
    both = zip(table["part"].to_pylist(), table["owners"].to_pylist(), strict=True)
    for (part, owners), a, b in zip(both, bound[:-1], bound[1:], strict=True):
        counts = shared[a : b - 1]  # without the markers
        slots = np.flatnonzero(counts)
        if len(slots) or owners:
            slots32 = slots.astype(np.uint32)
            rows.append((part, slots32.tobytes(), counts[slots].tobytes(), owners))
    batch = _binaries(rows or [(0, b"", b"", b"")], _COUNTED)
    return pa.Table.from_batches([batch.slice(0, len(rows))])


def _enough(table: pa.Table, percent: int) -> pa.Table:
    """Classes of a part of which others hold ``percent`` of the shingles at least."""
    owners = next(np.frombuffer(x.as_py(), _OWNERS) for x in table["owners"] if len(x.as_py()))
    shared = owners["known"].astype(np.int64)
    for slots, counts in zip(table["slots"], table["counts"], strict=True):
        shared[np.frombuffer(slots.as_py(), np.uint32)] += np.frombuffer(counts.as_py(), np.uint32)
    live = shared * 100 >= owners["n"].astype(np.int64) * percent
    return pa.table({"class": pa.array(owners["class"][live])})


def _slots(ids: np.ndarray, bits: int) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64), 3) >> np.uint64(64 - bits)).astype(np.int64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy(zero_copy_only=False)


def _bitmap(live: DataFrame) -> tuple[int, np.ndarray]:
    """A bitmap of hashed doc_ids, sixteen bits for each up to MOST_BITS in all.

    It tells which texts need no second look. With more ids than it has room
    for it passes more texts, never fewer; the driver gets one row per word of
    it that isn't empty.
    """
    count = live.count()
    bits = min(MOST_BITS, max(10, (16 * count).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _slots(_ids(batch["doc_id"]), bits)
            yield pa.record_batch({"word": pa.array(at >> 6), "bit": pa.array(at & 63)})

    found = (
        live.mapInArrow(tidy(words), "word long, bit long")
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit as int))")).alias("bits"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits, bitmap.view(np.uint64)


def _filtered(batch: pa.RecordBatch, chosen) -> pa.RecordBatch:
    bits, bitmap = chosen.value
    at = _slots(_ids(batch["doc_id"]), bits)
    hit = (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
    return batch.filter(pa.array(hit == 1))


def _sets(n: int, chosen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(_filtered(batch, chosen), "text"):
                sets = {class_of(s): s for s in shingle_sets(part["text"], n) if len(s)}
                yield pa.record_batch(
                    {
                        "class": pa.array(list(sets), pa.int64()),
                        "n": pa.array([len(s) for s in sets.values()], pa.int64()),
                        "shingles": pa.array([s.tobytes() for s in sets.values()], pa.binary()),
                    }
                )

    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for s in batch["shingles"]:
            at = np.frombuffer(s.as_buffer(), np.uint64) >> np.uint64(64 - 18)
            total += np.bincount(at.astype(np.int64), minlength=COUNTERS)
    if total.any():
        parts = total.reshape(PARTS, -1).astype(np.uint32)
        yield pa.record_batch(
            {
                "part": pa.array(np.arange(PARTS, dtype=np.int32)),
                "counts": pa.array([p.tobytes() for p in parts], pa.binary()),
            }
        )


def _add(key, table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.uint32).astype(np.int64) for x in table["counts"])
    return pa.table(
        {"part": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()])}
    )


def _frequency(sets: DataFrame) -> np.ndarray:
    """Per counter a level: 0 up to twice the mean load, then its logarithm.

    Every task sends its counters in PARTS pieces, each of which is summed up
    in a group of its own: a kilobyte per task. The driver gets two megabytes.
    """
    sums = sets.select("shingles").mapInArrow(tidy(_tally), "part int, counts binary")
    sums = sums.groupBy("part").applyInArrow(
        lambda key, table: _add(key, table), "part int, counts binary"
    ).toArrow()
    counts = np.zeros((PARTS, COUNTERS // PARTS), np.int64)
    for part, raw in zip(sums["part"].to_pylist(), sums["counts"], strict=True):
        counts[part] = np.frombuffer(raw.as_py(), np.int64)
    counts = counts.ravel()
    mean = max(1.0, counts.mean())
    return np.maximum(0, np.log2(np.maximum(counts, 1) / mean)).astype(np.uint8)


def _chains(keys: np.ndarray, names: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int):
    """Join what shares a key and may be of similar size, to the first of its run.

    Entries of a key are put in order of size. Where the next one's least size
    is too large for the largest so far, nothing before links with anything
    behind; the run ends. Returns key, first name, least and largest size of
    each run, and the edges (name, first name).
    """
    order = np.lexsort((high, low, keys))
    keys, names, low, high = (x[order] for x in (keys, names, low, high))
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    if len(keys):
        # The largest size so far within each key: keys are told apart by an offset.
        lift = np.cumsum(new) * (int(high.max()) + 1)
        top = np.maximum.accumulate(high + lift) - lift
        new[1:] |= percent * low[1:] > 100 * top[:-1]
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    head = names[first][run]
    other = names != head
    most = np.maximum.reduceat(high, first) if len(first) else high
    return keys[first], names[first], low[first], most, names[other], head[other]


def _distinct_edges(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


#: Shingles of stored sets for which a bucket of rare ones is planned, and the fewest bits.
KEY_ROWS, KEY_BITS = 1 << 20, 6
#: Rows of edges that leave a task at once.
EDGE_ROWS = 1 << 16


_ENTRY = "bucket int, keys binary, names binary, low binary, high binary, a binary, b binary"


def _key_bits(total: int) -> int:
    """Bits of the number of buckets, which grows with the shingles of the stored sets."""
    return min(20, max(KEY_BITS, math.ceil(math.log2(max(1, total / KEY_ROWS)))))


def _entries(
    keys: np.ndarray, names: np.ndarray, size: np.ndarray, percent: int, key_bits: int
) -> Iterator[pa.RecordBatch]:
    """Rows of what shares a key: edges of the classes at hand, and entries by bucket.

    Classes that share a key and are of similar size are joined here; one of them
    travels on with the key and the range of their sizes. The edges are rows
    without a bucket.
    """
    *entry, a, b = _chains(keys, names, size, size, percent)
    edges = _distinct_edges(a, b)
    entry[2:] = [x.astype(np.uint32) for x in entry[2:]]

    def row(bucket: int | None, part: list[np.ndarray]) -> pa.RecordBatch:
        return _binaries([(bucket, *[v.tobytes() for v in part])], _ENTRY)

    for k in range(0, len(edges[0]), EDGE_ROWS):
        yield row(None, [x[:0] for x in entry] + [x[k : k + EDGE_ROWS] for x in edges])
    bucket = (entry[0] >> np.uint64(64 - key_bits)).astype(np.int64)
    for x, y in _runs(bucket):
        yield row(int(bucket[x]), [v[x:y] for v in entry] + [v[:0] for v in edges])


def _prefixes(level, percent: int, key_bits: int = KEY_BITS):
    """Per batch and bucket the shingles of which linked sets share one.

    A set must share one of its rarest shingles with any set it links to.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = level.value
        for batch in batches:
            names, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            sizes = [np.zeros(0, np.int64)]
            for name, s in zip(batch["class"].to_pylist(), batch["shingles"], strict=True):
                h = np.frombuffer(s.as_buffer(), np.uint64)
                take = len(h) - -(-percent * len(h) // 100) + 1
                order = np.lexsort((h, levels[(h >> np.uint64(64 - 18)).astype(np.int64)]))
                keys.append(h[order[:take]])
                names.append(np.full(take, name))
                sizes.append(np.full(take, len(h)))
            columns = (np.concatenate(x) for x in (keys, names, sizes))
            yield from _entries(*columns, percent, key_bits)

    return run


#: The percentages for which pieces have several shingles each and are rarely empty.
PIECES = range(75, 100)
#: Pieces of a set for each that must be alike, so that common ones can be left out.
MORE_PIECES = 1.25
#: Stands for the need of all pieces of a set.
_ALL = (1 << 32) - 1

_PIECE = "bucket int, part long, keys binary, at binary, owners binary"
_KNOWN = "part long, keys binary, at binary, count binary, alone binary, owners binary"
_SIDES = np.dtype([("class", np.int64), ("n", np.uint32), ("need", np.uint32, 2)])


def _size_bands(most: int, percent: int) -> np.ndarray:
    """Least sizes of bands: what links a set of a band is in that or the next one, if
    it isn't smaller. The last is above ``most``."""
    least = [1, 2]
    while least[-1] <= most:
        least.append(max(least[-1] + 1, 100 * (least[-1] - 1) // percent + 1))
    return np.array(least)


def _piece_keys(
    sets: list[np.ndarray], percent: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the pieces of sets, the side (twice the set, plus 0 or 1) each is of, and
    how many of its rarest keys each side needs.

    With c common elements, linked sets differ in c * (100 - percent) / percent at most.
    The hashes of all elements are cut in more pieces than that: by a number for each
    band of sizes, so sets are cut for their own band and, as the larger of two, for
    the one below. So some pieces are alike, and of any set's keys no more than that
    number are not found in the other. Put in the same order, the first of one more
    hold a common one. Empty pieces have no key, but in a set that has too few others;
    such a set needs all of its keys.
    """
    size = np.array([len(s) for s in sets], np.int64)
    least = _size_bands(int(size.max(initial=1)), percent)
    differ = (least[1:] - 1) * (100 - percent) // percent
    pieces = np.where(differ > 0, np.ceil(MORE_PIECES * (differ + 1)), 1).astype(np.uint64)
    own = np.searchsorted(least, size, "right") - 1
    data = np.concatenate([np.zeros(0, np.uint64), *sets])
    high, mixed = data >> np.uint64(32), mix(data, 5)
    owner = np.repeat(np.arange(len(sets)), size)
    need = np.zeros((len(sets), 2), np.uint32)
    keys, sides = [], []

    def named(total: np.ndarray, piece: np.ndarray, band: np.ndarray) -> np.ndarray:
        return mix(total ^ mix(piece + (band.astype(np.uint64) << np.uint64(32)), 7), 9)

    for side in (0, 1):
        band = np.maximum(own - side, 0)
        piece = (high * pieces[band][owner]) >> np.uint64(32)
        new = np.ones(len(data), bool)
        new[1:] = (piece[1:] != piece[:-1]) | (owner[1:] != owner[:-1])
        if side:
            new &= own[owner] > 0
        first = np.flatnonzero(new)
        if not len(first):
            continue
        found = owner[first]
        keys.append(named(np.add.reduceat(mixed, first), piece[first], band[found]))
        sides.append(2 * found + side)
        need[:, side] = np.minimum(size * (100 - percent) // percent, differ[band]) + 1
        few = np.bincount(found, minlength=len(sets)) < need[:, side]
        few &= own >= side
        need[few, side] = _ALL
        for k in np.flatnonzero(few):
            empty = np.setdiff1d(np.arange(pieces[band[k]], dtype=np.uint64), piece[first[found == k]])
            keys.append(named(np.zeros(len(empty), np.uint64), empty, np.full(len(empty), band[k])))
            sides.append(np.full(len(empty), 2 * k + side))
    return (
        np.concatenate([np.zeros(0, np.uint64), *keys]),
        np.concatenate([np.zeros(0, np.int64), *sides]),
        need,
    )


def _pieces(percent: int, key_bits: int):
    """Per part and bucket the keys of pieces, and of which of the part's sets they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in batch["shingles"]]
            names = batch["class"].to_numpy()
            cut = np.cumsum([len(s) for s in sets]) // PART_ROWS
            for a, b in _runs(cut):
                yield packed(names[a:b], sets[a:b])

    def packed(names: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        keys, at, need = _piece_keys(sets, percent)
        owners = np.zeros(len(names), _SIDES)
        owners["class"], owners["n"], owners["need"] = names, [len(s) for s in sets], need
        bucket = (keys >> np.uint64(64 - key_bits)).astype(np.int64)
        order = np.lexsort((at, bucket))
        keys, at, bucket = keys[order], at[order].astype(np.uint32), bucket[order]
        part = class_of(names)
        rows = []
        for a, b in _runs(bucket):
            known = owners.tobytes() if not rows else b""
            rows.append((int(bucket[a]), part, keys[a:b].tobytes(), at[a:b].tobytes(), known))
        return _binaries(rows, _PIECE)

    return run


def _count_keys(table: pa.Table) -> pa.Table:
    """Per part the keys of a bucket that come several times, how often they do, and the
    sides that have a key alone."""
    keys = [np.frombuffer(x.as_py(), np.uint64) for x in table["keys"]]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    new = np.ones(len(every), bool)
    new[1:] = every[order][1:] != every[order][:-1]
    times = np.diff(np.append(np.flatnonzero(new), len(every)))
    count = np.empty(len(every), np.uint32)
    count[order] = times[np.cumsum(new) - 1]
    del every, order, new, times
    bound = np.cumsum([0, *map(len, keys)])
    rows = []
    for k, (part, owners) in enumerate(
        zip(table["part"].to_pylist(), table["owners"].to_pylist(), strict=True)
    ):
        own = count[bound[k] : bound[k + 1]]
        at = np.frombuffer(table["at"][k].as_py(), np.uint32)
        some = own > 1
        columns = (keys[k][some], at[some], own[some], at[~some])
        rows.append((part, *[c.tobytes() for c in columns], owners))
    return pa.Table.from_batches([_binaries(rows, _KNOWN)])


def _rarest(table: pa.Table, percent: int, key_bits: int) -> pa.Table:
    """Entries and edges by the rarest keys of every side, as many as it needs."""

    def column(name, dtype):
        return np.concatenate([np.frombuffer(x.as_py(), dtype) for x in table[name]])

    owners = next(np.frombuffer(x.as_py(), _SIDES) for x in table["owners"] if len(x.as_py()))
    keys, at = column("keys", np.uint64), column("at", np.uint32).astype(np.int64)
    alone = np.bincount(column("alone", np.uint32), minlength=2 * len(owners))
    order = np.lexsort((keys, column("count", np.uint32), at))
    keys, at = keys[order], at[order]
    once = np.ones(len(keys), bool)  # two parts may be the same
    once[1:] = (keys[1:] != keys[:-1]) | (at[1:] != at[:-1])
    keys, at = keys[once], at[once]
    before = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=2 * len(owners)))])
    rank = np.arange(len(keys)) - before[at] + alone[at]
    keep = rank < owners["need"].astype(np.int64).ravel()[at]
    keys, of = keys[keep], at[keep] >> 1
    size = owners["n"][of].astype(np.int64)
    batches = list(_entries(keys, owners["class"][of], size, percent, key_bits))
    empty = _binaries([(None, *[b""] * 6)], _ENTRY).slice(0, 0)
    return pa.Table.from_batches([*batches, empty])


def _meet(table: pa.Table, percent: int) -> pa.Table:
    """Edges between classes that share a shingle of the bucket and may be alike in size."""

    def column(name, dtype):
        return np.concatenate([np.frombuffer(x.as_py(), dtype) for x in table[name]])

    low, high = (column(c, np.uint32).astype(np.int64) for c in ("low", "high"))
    *_, a, b = _chains(column("keys", np.uint64), column("names", np.int64), low, high, percent)
    a, b = _distinct_edges(a, b)
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed edges as rows."""
    for batch in batches:
        for a, b in zip(batch["a"], batch["b"], strict=True):
            yield pa.record_batch(
                {c: np.frombuffer(x.as_buffer(), np.int64) for c, x in (("a", a), ("b", b))}
            )


def _link_cell(percent: int):
    def run(table: pa.Table) -> pa.Table:
        # Of a class that came twice, either will do.
        both = zip(table["class"].to_pylist(), table["shingles"], strict=True)
        by_name = {name: np.frombuffer(s.as_py(), np.uint64) for name, s in both}
        names, sets = np.fromiter(by_name, np.int64, len(by_name)), list(by_name.values())
        label = signature_tree.link(sets, percent)
        linked = names != names[label]
        return pa.table(
            {"a": pa.array(names[linked]), "b": pa.array(names[label][linked])}
        )

    return run


def _count_cell(percent: int):
    """Per class of a cell with links the class of its label, and the copies it links to.

    Two classes that meet in several cells count in one: that of the later of
    their bands, and of both their chunks.
    """

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, band, x, y = (k.as_py() for k in key)
        names, once = np.unique(table["class"].to_numpy(), return_index=True)
        table = table.take(once)
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in table["shingles"]]
        side = table["c"].to_numpy() if x != y else np.full(len(names), -1)
        late = table["own"].to_numpy() == band
        label, links = signature_tree.count_links(
            sets, percent, table["copies"].to_numpy(), late, side
        )
        some = links > 0
        return pa.table(
            {
                "a": pa.array(names[some]),
                "b": pa.array(names[label][some]),
                "links": pa.array(links[some]),
            }
        )

    return run


def _parts_of(count: str, items: str, rows: int, most: int) -> Column:
    """How many cells' worth of classes and shingles there are."""
    return F.greatest(F.ceil(F.col(count) / rows), F.ceil(F.col(items) / most))


def _cells(
    sets: DataFrame,
    blocks: DataFrame,
    workspace: Workspace,
    percent: int,
    cell_rows: int,
) -> DataFrame:
    """Sets by cell. Two sets of a block that can link meet in some cell.

    ``blocks`` has node, root and the copies of the node. With every set go its
    own band and its chunk.

    A block of up to ``cell_rows`` classes with up to CELL_ITEMS shingles is one
    cell. A larger one is cut by size: sets a band or more apart are too unequal, so
    each goes to its own band's cell and to the next one's. A cell still too large is
    cut into chunks, and pairs of chunks are its cells.
    """
    ratio = math.log(1.04 * 100 / percent)
    sizes = sets.groupBy(F.col("class").alias("node")).agg(F.max("n").alias("n"))
    count = (
        blocks.join(sizes, "node")
        .groupBy(F.col("root").alias("block"))
        .agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("items"))
        .select("block", _parts_of("count", "items", cell_rows, CELL_ITEMS).alias("size"))
    )
    known = blocks.select(F.col("node").alias("class"), F.col("root").alias("block"), "copies")
    known = workspace.store(known.join(count, "block"), "known")
    if known.count() <= MOST_KNOWN:
        known = F.broadcast(known)
    sized = sets.join(known, "class")
    small = sized.filter("size <= 1").select(
        "block", F.lit(0).alias("band"), F.lit(0).alias("x"), F.lit(0).alias("y"),
        "class", "shingles", "copies", F.lit(0).alias("own"), F.lit(0).alias("c"),
    )
    if count.filter("size > 1").isEmpty():
        return small
    band = F.floor(F.log("n") / ratio).cast("int")
    large = (
        sized.filter("size > 1")
        .withColumn("own", band)
        .withColumn("band", F.explode(F.array(F.col("own"), F.col("own") + 1)))
    )
    half = _parts_of("count", "items", max(1, cell_rows // 2), max(1, CELL_ITEMS // 2))
    chunks = (
        large.groupBy("block", "band")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("n").alias("items"))
        .select("block", "band", half.cast("int").alias("k"))
    )
    x = F.pmod(F.xxhash64("class"), "k").cast("int")
    large = (
        large.join(chunks, ["block", "band"])
        .withColumn("c", x)
        .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        .select(
            "block", "band", F.least("c", "o").alias("x"), F.greatest("c", "o").alias("y"),
            "class", "shingles", "copies", "own", "c",
        )
    )
    return small.unionByName(large)


def _candidates(
    docs: DataFrame, workspace: Workspace, n: int, percent: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents with their classes, classes, sets that may link, and blocks of those."""
    spark = docs.sparkSession
    bound_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    members = workspace.store(
        docs.mapInArrow(tidy(_membership(n)), "doc_id long, n_shingles long, class long"), "members"
    )
    classes = (
        members.filter("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("least"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    bits = min(20, max(6, math.ceil(math.log2(max(1, total / BUCKET_ROWS)))))
    # Copies in other parts would count as other classes; a few that pass do no harm.
    least = F.coalesce("least", F.lit(0)).alias("doc_id")
    once = spark.sparkContext.broadcast(_bitmap(workspace.store(classes.select(least), "once")))
    enough = (
        docs.mapInArrow(tidy(_pack(n, bits, once)), _PACK)
        .groupBy("bucket")
        .applyInArrow(lambda key, table: _count_shared(table), _COUNTED)
        .groupBy("part")
        .applyInArrow(lambda key, table: _enough(table, percent), "class long")
        .distinct()
    )
    live = workspace.store(classes.join(enough, "class").select(least), "live")
    # One document stands for a class; a few others that pass do no harm.
    chosen = spark.sparkContext.broadcast(_bitmap(live))
    sets = workspace.store(
        docs.mapInArrow(tidy(_sets(n, chosen)), "class long, n long, shingles binary"), "sets"
    )
    bits = _key_bits(sets.agg(F.sum("n")).first()[0] or 0)
    if percent in PIECES:
        entries = (
            sets.mapInArrow(tidy(_pieces(percent, bits)), _PIECE)
            .groupBy("bucket")
            .applyInArrow(lambda key, table: _count_keys(table), _KNOWN)
            .groupBy("part")
            .applyInArrow(lambda key, table: _rarest(table, percent, bits), _ENTRY)
        )
    else:
        level = spark.sparkContext.broadcast(_frequency(sets))
        entries = sets.mapInArrow(tidy(_prefixes(level, percent, bits)), _ENTRY)
    entries = workspace.store(entries, "entries")
    met = (
        entries.filter("bucket IS NOT NULL")
        .groupBy("bucket")
        .applyInArrow(lambda key, table: _meet(table, percent), "a long, b long")
    )
    local = entries.filter("bucket IS NULL").select("a", "b")
    candidates = met.unionByName(local.mapInArrow(tidy(_edges), "a long, b long"))
    blocks = workspace.store(connected_components(candidates, workspace), "blocks")
    return members, classes, sets, blocks


def _named(classes: DataFrame, links: DataFrame, workspace: Workspace) -> DataFrame:
    """Classes with the least doc_id reachable by links."""
    roots = connected_components(links, workspace)
    groups = workspace.store(
        classes.join(roots, classes["class"] == roots["node"], "left").select(
            "class", "least", "copies", F.coalesce("root", "class").alias("root")
        ),
        "groups",
    )
    least = groups.groupBy("root").agg(F.min("least").alias("component_id"))
    return groups.join(least, "root").select("class", "copies", "component_id")


def ngram_components(
    docs: DataFrame,
    workspace: Workspace,
    n: int = 5,
    percent: int = 80,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Documents with shingle counts and components: doc_id, n_shingles, component_id.

    ``docs`` needs doc_id (long) and text; other columns are ignored. Texts are
    linked when 100 * common >= percent * all of their distinct n-word
    shingles. component_id is the smallest doc_id reachable by links.

    Null and blank texts have no shingles and link with nothing, not even with
    each other. Repeated rows come out repeated. A null doc_id is never the
    smallest of a component that has another. An empty table gives no rows.

    Equal sets are one class from the start. Classes whose shingles are mostly
    their own cannot link: a count over all shingles finds, per class, how many
    some other class holds. The others are cut in pieces of a few shingles and share
    one of their rarest pieces with every partner, where a single shingle would
    connect them to much else; classes so connected form blocks, and inside a block
    signature trees find the links.
    """
    members, classes, sets, blocks = _candidates(docs, workspace, n, percent)
    blocks = blocks.withColumn("copies", F.lit(1).cast("long"))
    links = (
        _cells(sets, blocks, workspace, percent, cell_rows)
        .groupBy("block", "band", "x", "y")
        .applyInArrow(lambda key, table: _link_cell(percent)(table), "a long, b long")
    )
    named = _named(classes, links, workspace).select("class", "component_id")
    return members.join(named, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def ngram_links(
    docs: DataFrame,
    workspace: Workspace,
    n: int = 5,
    percent: int = 80,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """The whole join: doc_id, n_shingles, component_id, and n_links.

    n_links is the number of other rows a row links with, in the sense of
    ``ngram_components``, whose columns and rules for nulls and repeated rows
    are the same. Rows of one doc_id count each, equal texts link, and a row
    without shingles has no links. Every pair of classes that may link is
    verified, also where both hang together already.
    """
    members, classes, sets, blocks = _candidates(docs, workspace, n, percent)
    copies = classes.select(F.col("class").alias("node"), "copies")
    found = workspace.store(
        _cells(sets, blocks.join(copies, "node"), workspace, percent, cell_rows)
        .groupBy("block", "band", "x", "y")
        .applyInArrow(
            lambda key, table: _count_cell(percent)(key, table), "a long, b long, links long"
        ),
        "found",
    )
    links = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    named = _named(classes, found.select("a", "b"), workspace).join(links, "class", "left")
    return members.join(named, "class", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).alias("n_links"),
    )
