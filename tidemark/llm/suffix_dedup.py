"""Bytes inside passages that occur twice anywhere, found by suffix arrays.

Two equal strings of LENGTH bytes must meet in one suffix array, whatever texts they are
in. Each place of a text (where such a string starts) has an anchor: of the 32-byte
strings inside, the first one with the least hash. Equal strings have equal anchors at
equal distances, so places are grouped by anchor. A run of neighbouring places with one
anchor is a piece of text, some 185 places long.

Pieces that occur once under an anchor of their own are done, and so are equal pieces,
which are counted, not gathered. Where different pieces share an anchor, one of each
goes to a block of whole anchors, and the block's suffix array shows which places
another one repeats. An anchor with very many different pieces is split: places at
about the same distance from the anchor have most of their string in common, so pieces
are cut into bands of distance and grouped by that common string as well; bands get
narrower until groups are small, at the end one place wide.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.batches import bound_batches, tidy
from tidemark.llm.columns import free_name, quoted
from tidemark.llm.suffixes import repeated
from tidemark.llm.words import SLICE_BYTES, mix, text_bytes
from tidemark.workspace import Workspace

LENGTH = 400
GRAM = 32
#: Bytes of pieces one suffix array holds; a key's pieces are never parted.
BLOCK_BYTES = 1 << 18
#: Different pieces of one anchor up to which they aren't split.
MOST_PIECES = 256
#: Widths of the bands of distance, one after another; at 1 equal strings are equal pieces.
WIDTHS = (92, 23, 6, 1)

_ODD = [np.uint64(x) for x in (
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
)]

PIECE = "struct<start int, n smallint, back smallint, key bigint, name binary>"


def text_id(text: Column) -> Column:
    """A name of 16 bytes for equal texts."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    words = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data).data, 0, (1,)).copy()
    m = len(data) - GRAM + 1
    h = words[:m] * _ODD[0]
    for k, odd in enumerate(_ODD[1:], 1):
        h ^= h >> np.uint64(29)
        h += words[8 * k : 8 * k + m] * odd
    return mix(h)


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, width)
    upto = np.minimum.accumulate(padded, axis=1).ravel()
    since = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(since[:n], upto[width - 1 : width - 1 + n])


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of places with one anchor: first place, number, anchor, key of the anchor.

    Places are those at which ``length`` bytes of one text start.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none
    hashes = _gram_hashes(data)
    high = np.uint64(0xFFFFFFFF00000000)
    places = np.arange(len(hashes), dtype=np.uint64)
    least = _sliding_least((hashes & high) | places, length - GRAM + 1)
    anchor = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # A text's places end ``length`` bytes before the text.
    edge = np.zeros(len(anchor) + 1, np.int64)
    last = np.maximum(offsets[1:] - length + 1, offsets[:-1])
    some = last > offsets[:-1]
    np.add.at(edge, offsets[:-1][some], 1)
    np.add.at(edge, last[some], -1)
    inside = np.cumsum(edge[:-1]) > 0
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    end = np.append(first[1:], len(anchor))
    first, end = first[inside[first]], end[inside[first]]
    at = anchor[first]
    return first, end - first, at, hashes[at].astype(np.int64)


def _name(piece: bytes) -> bytes:
    return hashlib.blake2b(piece, digest_size=12).digest()


def _chunks(offsets: np.ndarray, length: int, limit: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Texts in parts of about ``limit`` bytes: first text, its first byte, offsets.

    A longer text comes in parts that overlap by ``length`` - 1 bytes, so that each of
    its places is in one of them.
    """
    d, n = 0, len(offsets) - 1
    while d < n:
        e = max(int(np.searchsorted(offsets, offsets[d] + limit, "right")) - 1, d + 1)
        if e > d + 1 or offsets[e] - offsets[d] <= limit:
            yield d, 0, offsets[d : e + 1]
        else:
            for a in range(int(offsets[d]), int(offsets[e]), limit):
                b = min(a + limit + length - 1, int(offsets[e]))
                yield d, a - int(offsets[d]), np.array([a, b])
        d = e


def _pieces_of(length: int, slice_bytes: int):
    """Per text its pieces, without their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, data = text_bytes(batch["text"])
            parts, counts = [], np.zeros(batch.num_rows, np.int64)
            for d, shift, bound in _chunks(offsets, length, slice_bytes):
                part = data[bound[0] : bound[-1]]
                first, n, at, key = runs_of(part, bound - bound[0], length)
                raw = part.tobytes()
                ends = first + n + length - 1
                names = [_name(raw[a:b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                owner = np.searchsorted(bound - bound[0], first, "right") - 1
                np.add.at(counts, d + owner, 1)
                start = first - (bound - bound[0])[owner] + shift
                parts.append((start, n, at - first, key, names))
            columns = [np.concatenate([p[k] for p in parts]) if parts else [] for k in range(4)]
            runs = pa.StructArray.from_arrays(
                [
                    pa.array(columns[0], pa.int32()),
                    pa.array(columns[1], pa.int16()),
                    pa.array(columns[2], pa.int16()),
                    pa.array(columns[3], pa.int64()),
                    pa.array([x for p in parts for x in p[4]], pa.binary()),
                ],
                ["start", "n", "back", "key", "name"],
            )
            ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.record_batch(
                {"uid": batch["uid"], "runs": pa.ListArray.from_arrays(pa.array(ends), runs)}
            )

    return run


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted pieces of each text."""
    for batch in batches:
        offsets, data = text_bytes(batch["text"])
        for d, wanted in enumerate(batch["wanted"].to_pylist()):
            base, rows = int(offsets[d]), []
            for w in wanted:
                a = base + w["start"]
                piece = data[a : a + w["n"] + length - 1].tobytes()
                rows.append({**{k: w[k] for k in ("key", "name", "weight", "n", "back")}, "piece": piece})
            yield pa.RecordBatch.from_pylist(rows, schema=_PIECES)


_PIECES = pa.schema(
    [
        ("key", pa.int64()), ("name", pa.binary()), ("weight", pa.int64()),
        ("n", pa.int16()), ("back", pa.int16()), ("piece", pa.binary()),
    ]
)
_PIECES_DDL = "key long, name binary, weight long, n smallint, back smallint, piece binary"
_MARKS = pa.schema(
    [("key", pa.int64()), ("name", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32())]
)
_MARKS_DDL = "key long, name binary, lo int, hi int"


def _searched(length: int, block_bytes: int):
    """Places of the pieces that another piece of their block repeats, as ranges.

    Rows come in order of their keys; a block ends where a key does.
    """

    def search(rows: list[dict]) -> pa.RecordBatch:
        lengths = np.array([len(r["piece"]) for r in rows])
        data = np.frombuffer(b"".join(r["piece"] for r in rows), np.uint8)
        flags = np.zeros(len(data) + 1, np.int8)
        flags[:-1] = repeated(data, lengths, length)
        # A piece's last bytes are no places, so ranges don't run into the next piece.
        turns = np.flatnonzero(np.diff(flags, prepend=0))
        lo, hi = turns[::2], turns[1::2]
        first = np.cumsum(lengths) - lengths
        of = np.searchsorted(first, lo, "right") - 1
        return pa.RecordBatch.from_arrays(
            [
                pa.array([rows[k]["key"] for k in of], pa.int64()),
                pa.array([rows[k]["name"] for k in of], pa.binary()),
                pa.array(lo - first[of], pa.int32()),
                pa.array(hi - first[of], pa.int32()),
            ],
            schema=_MARKS,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= block_bytes and row["key"] != held[-1]["key"]:
                    yield search(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["piece"])
        if held:
            yield search(held)

    return run


def _bands(length: int, width: int):
    """Pieces cut into bands of ``width`` distances, under keys of their common string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                piece, n, back = r["piece"], r["n"], r["back"]
                rows = []
                for band in range((back - n + 1) // width, back // width + 1):
                    near, far = band * width, band * width + width - 1
                    lo, hi = max(back - far, 0), min(back - near, n - 1)
                    core = piece[max(back - near, 0) : back - far + length]
                    part = piece[lo : hi + length]
                    key = hashlib.blake2b(
                        f"{r['key']}:{width}:{band}:".encode() + core, digest_size=8
                    ).digest()
                    rows.append(
                        {
                            "key": int.from_bytes(key, "little", signed=True),
                            "name": _name(part), "weight": r["weight"], "n": hi - lo + 1,
                            "back": back - lo, "piece": part,
                            "of_key": r["key"], "of_name": r["name"], "at": lo,
                        }
                    )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([*_PIECES, ("of_key", pa.int64()), ("of_name", pa.binary()), ("at", pa.int32())])
    return run


_BANDS_DDL = f"{_PIECES_DDL}, of_key long, of_name binary, at int"


def _marks(
    pieces: DataFrame, workspace: Workspace, length: int, most: int, widths: tuple[int, ...],
    block_bytes: int,
) -> DataFrame:
    """Repeated places (key, name, lo, hi) of stored pieces that differ in (key, name).

    A piece that stands for several (weight) is repeated as a whole; it still shows
    which places of others are. Groups of more than ``most`` pieces are cut into bands
    of the next width. Only the number of pieces to cut reaches the driver.
    """
    whole = pieces.filter("weight > 1").select(
        "key", "name", F.lit(0).alias("lo"), F.col("n").cast("int").alias("hi")
    )
    if not widths:  # one place each: different pieces are different strings
        return whole
    sizes = pieces.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("size"))
    # Alone in its group, a piece has no other to be compared with.
    sizes = workspace.store(sizes.filter("size > 1"), "sizes")
    sized = pieces.join(sizes, F.col("key") == F.col("k")).select(*pieces.columns, "size")
    small = sized.filter(F.col("size") <= most).drop("size")
    found = (
        small.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(tidy(_searched(length, block_bytes)), _MARKS_DDL)
    )
    found = whole.unionByName(found)
    if sizes.filter(F.col("size") > most).isEmpty():
        return found
    hot = sized.filter(F.col("size") > most).select(*pieces.columns)
    cut = workspace.store(hot.mapInArrow(tidy(_bands(length, widths[0])), _BANDS_DDL), "bands")
    parts = cut.groupBy("key", "name").agg(
        F.sum("weight").alias("weight"),
        *[F.first(c).alias(c) for c in ("n", "back", "piece")],
    )
    parts = workspace.store(parts, "parts")
    inner = _marks(parts, workspace, length, most, widths[1:], block_bytes)
    inner = workspace.store(inner, "marks").toDF("k", "m", "lo", "hi")
    back = cut.join(inner, (F.col("key") == F.col("k")) & (F.col("name") == F.col("m"))).select(
        F.col("of_key").alias("key"),
        F.col("of_name").alias("name"),
        (F.col("at") + F.col("lo")).alias("lo"),
        (F.col("at") + F.col("hi")).alias("hi"),
    )
    return found.unionByName(back)


def _merged(length: int):
    """Ranges of places as spans of bytes that neither touch nor overlap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for places in batch["places"].to_pylist():
                places.sort(key=lambda p: p["lo"])
                spans = []
                for p in places:
                    lo, hi = p["lo"], p["hi"] + length - 1
                    if spans and lo <= spans[-1]["hi"]:
                        spans[-1]["hi"] = max(hi, spans[-1]["hi"])
                    else:
                        spans.append({"lo": lo, "hi": hi})
                out.append(spans)
            kind = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
            yield pa.record_batch({"uid": batch["uid"], "spans": pa.array(out, kind)})

    return run


def repeated_spans(
    docs: DataFrame,
    workspace: Workspace,
    text: str = "text",
    length: int = LENGTH,
    most: int = MOST_PIECES,
    widths: tuple[int, ...] = WIDTHS,
    block_bytes: int = BLOCK_BYTES,
    slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Per different text with a repeated passage (uid, spans): the spans of its UTF-8
    bytes that strings of ``length`` bytes starting anywhere else cover, in order.

    ``uid`` is ``text_id`` of the text. Equal texts repeat each other. Null, empty and
    shorter texts have no spans; long ones are read in overlapping parts, so their
    length sets no limit. An empty table gives an empty one.
    """
    bound_batches(docs.sparkSession)
    texts = docs.select(quoted(text).cast("string").alias("text")).filter(
        F.octet_length("text") >= length
    )
    texts = texts.select(text_id(F.col("text")).alias("uid"), "text")
    # Equal texts have equal pieces: one list of them goes on, with their number.
    found = texts.mapInArrow(
        tidy(_pieces_of(length, slice_bytes)), f"uid binary, runs array<{PIECE}>"
    )
    runs = workspace.store(
        found.groupBy("uid").agg(F.count(F.lit(1)).alias("copies"), F.first("runs").alias("runs")),
        "runs",
    )
    places = runs.select("uid", "copies", F.explode("runs").alias("r")).select("uid", "copies", "r.*")
    names = workspace.store(
        places.groupBy("key", "name").agg(
            F.sum("copies").alias("weight"),
            F.min(F.struct("uid", "start", "n", "back")).alias("one"),
        ),
        "names",
    )
    # Pieces of anchors with different ones: the bytes of one of each are needed.
    shared = workspace.store(
        names.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("size"))
        .filter("size > 1").select("k"),
        "shared",
    )
    compared = names.join(shared, F.col("key") == F.col("k"), "left_semi")
    wanted = workspace.store(
        compared.groupBy(F.col("one.uid").alias("u")).agg(
            F.collect_list(
                F.struct("one.start", "one.n", "one.back", "key", "name", "weight")
            ).alias("wanted")
        ),
        "wanted",
    )
    held = texts.join(wanted, F.col("uid") == F.col("u")).select("uid", "text", "wanted")
    held = held.dropDuplicates(["uid"])
    pieces = workspace.store(
        held.mapInArrow(tidy(lambda batches: _cut(batches, length)), _PIECES_DDL), "pieces"
    )
    # Pieces that occur once are where their name says; repeated ones are everywhere.
    marks = _marks(pieces, workspace, length, most, widths, block_bytes)
    once = names.filter("weight = 1").select(
        F.col("key").alias("k"), F.col("name").alias("m"), "one"
    )
    single = marks.join(once, (F.col("key") == F.col("k")) & (F.col("name") == F.col("m"))).select(
        F.col("one.uid").alias("uid"),
        (F.col("one.start") + F.col("lo")).alias("lo"),
        (F.col("one.start") + F.col("hi")).alias("hi"),
    )
    often = workspace.store(
        names.filter("weight > 1").select(F.col("key").alias("k"), F.col("name").alias("m")), "often"
    )
    whole = places.join(
        often, (F.col("key") == F.col("k")) & (F.col("name") == F.col("m")), "left_semi"
    ).select("uid", F.col("start").alias("lo"), (F.col("start") + F.col("n")).alias("hi"))
    lists = single.unionByName(whole).groupBy("uid").agg(
        F.collect_list(F.struct("lo", "hi")).alias("places")
    )
    spans = "uid binary, spans array<struct<lo int, hi int>>"
    return workspace.store(lists.mapInArrow(tidy(_merged(length)), spans), "spans")


def with_repeats(
    docs: DataFrame,
    workspace: Workspace,
    text: str = "text",
    name: str = "repeats",
    **options,
) -> DataFrame:
    """``docs`` with a struct ``name`` behind its columns: n_bytes, n_removed, n_spans,
    spans (of bytes, [lo, hi)) and kept (the other bytes, one after another).

    Rows stay as they are, repeated ones too; a null text counts as empty. ``kept`` is
    binary, as a span may begin inside a character. Options are those of
    ``repeated_spans``. A column called ``name`` gives way.
    """
    spans = repeated_spans(docs, workspace, text, **options)
    uid, found = free_name(docs, "__uid"), free_name(docs, "__spans")
    spans = spans.toDF(uid, found)
    content = F.coalesce(quoted(text).cast("string"), F.lit(""))
    data, size = content.cast("binary"), F.octet_length(content)
    joined = docs.join(spans, text_id(content) == quoted(uid), "left")
    cut = F.coalesce(quoted(found), F.array().cast("array<struct<lo:int,hi:int>>"))
    # Around the spans: from the end of one, or the start, to the next, or the end.
    lows = F.concat(F.array(F.lit(0)), F.transform(cut, lambda s: s["hi"]))
    highs = F.concat(F.transform(cut, lambda s: s["lo"]), F.array(size))
    parts = F.transform(
        F.arrays_zip(lows.alias("lo"), highs.alias("hi")),
        lambda p: F.hex(F.substring(data, p["lo"] + 1, p["hi"] - p["lo"])),
    )
    kept = F.when(F.size(cut) == 0, data).otherwise(F.unhex(F.array_join(parts, "")))
    removed = F.aggregate(cut, F.lit(0), lambda n, s: n + s["hi"] - s["lo"])
    columns = [quoted(c) for c in docs.columns if c != name]
    return joined.select(
        *columns,
        F.struct(
            size.cast("long").alias("n_bytes"),
            removed.cast("long").alias("n_removed"),
            F.size(cut).cast("long").alias("n_spans"),
            cut.alias("spans"),
            kept.alias("kept"),
        ).alias(name),
    )


def without_repeats(docs: DataFrame, workspace: Workspace, text: str = "text", **options):
    """``docs`` with only the kept bytes in ``text``; bytes that a cut leaves of a
    character become replacement characters. Nulls stay null."""
    name = free_name(docs, "__repeats")
    found = with_repeats(docs, workspace, text, name, **options)
    kept = F.decode(quoted(name)["kept"], "UTF-8")
    changed = F.when(quoted(name)["n_removed"] > 0, kept).otherwise(quoted(text))
    return found.select(*[changed.alias(c) if c == text else quoted(c) for c in docs.columns])
