"""Token ids in compressed files that decode in parallel, and back.

A file holds consecutive documents: one frequency table, an index of documents
and blocks of ids (see rans). Files are rows (part, seq, n_docs, n_tokens,
payload) of a table that Spark writes, so any store Spark reaches will do; the
documents of (part, seq) come before those of any later pair.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.batches import bound_batches, tidy
from tidemark.llm.rans import BLOCK, Coder, CorruptFile, Table
from tidemark.llm.tokens import BATCH_BYTES, encoder
from tidemark.llm.words import slices
from tidemark.workspace import Workspace

#: Ids after which a file is closed (behind a whole document).
FILE_TOKENS = 1 << 21
_MAGIC = b"TMTK\x01\x00\x00\x00"
FILES = "part int, seq int, n_docs long, n_tokens long, payload binary"


def pack(names: np.ndarray, null: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: magic; sizes of the sections; table, index and blocks; a checksum."""
    index = zlib.compress(
        null.astype(np.uint8).tobytes()
        + names.astype("<i8").tobytes()
        + lengths.astype("<u8").tobytes(),
        1,
    )
    table, blocks = b"", []
    if len(ids):
        fitted = Table.fit(np.bincount(ids))
        coder = Coder(fitted)
        table = fitted.pack()
        blocks = [coder.encode(ids[k : k + BLOCK]) for k in range(0, len(ids), BLOCK)]
    sizes = np.array([len(table), len(index), *map(len, blocks)], "<u8")
    head = _MAGIC + struct.pack("<QQ", len(names), len(blocks)) + sizes.tobytes()
    check = struct.pack("<I", zlib.crc32(head + table + index))
    return b"".join([head, check, table, index, *blocks])


def unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names, null flags, lengths and ids of a file's documents."""
    if raw[:8] != _MAGIC:
        raise CorruptFile("not a token file")
    n, n_blocks = struct.unpack_from("<QQ", raw, 8)
    sizes = np.frombuffer(raw, "<u8", 2 + n_blocks, 24).astype(np.int64)
    at = 24 + 8 * len(sizes)
    (check,) = struct.unpack_from("<I", raw, at)
    ends = at + 4 + np.cumsum(sizes)
    parts = [raw[b - s : b] for s, b in zip(sizes.tolist(), ends.tolist(), strict=True)]
    if zlib.crc32(raw[:at] + parts[0] + parts[1]) != check:
        raise CorruptFile("the checksum of table and index differs")
    index = zlib.decompress(parts[1])
    null = np.frombuffer(index, np.uint8, n).astype(bool)
    names = np.frombuffer(index, "<i8", n, n)
    lengths = np.frombuffer(index, "<u8", n, 9 * n).astype(np.int64)
    ids = np.zeros(0, np.uint32)
    if n_blocks:
        coder = Coder(Table.unpack(parts[0]))
        ids = np.concatenate([coder.decode(b) for b in parts[2:]])
    if len(ids) != lengths.sum():
        raise CorruptFile("the index and the blocks differ in length")
    return names, null, lengths, ids


def _write(path: str, end_id: int, file_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        names, lengths, ids, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            column = pa.concat_arrays(names)
            null = np.array(column.is_null())
            counts = np.concatenate(lengths)
            payload = pack(
                np.array(column.fill_null(0)), null, counts, np.concatenate(ids)
            )
            row = [part, seq, len(counts), int(counts.sum()), payload]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                names=["part", "seq", "n_docs", "n_tokens", "payload"],
            )

        for batch in batches:
            for piece in slices(batch, "text", BATCH_BYTES):
                counts, found = encoder(path).encode(piece["text"])
                names.append(piece["doc_id"])
                lengths.append(counts + 1)
                ids.append(np.insert(found, np.cumsum(counts), end_id))
                held += len(ids[-1])
                if held >= file_tokens:
                    yield close()
                    seq, held = seq + 1, 0
                    names, lengths, ids = [], [], []
        if names:
            yield close()

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    workspace: Workspace,
    end_id: int = 2,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode every text, append ``end_id``, and write files in doc_id order.

    ``path`` is a file of the tokenizers library; special tokens are not added.
    ``docs`` needs doc_id (long) and text; other columns are left out. A null
    text has the end id only; a null doc_id comes first; rows with one doc_id
    follow each other by a hash of their text, so reruns agree. An empty table gives
    no files.

    Rows are dealt by ranges of doc_id and that hash, so that different texts of one
    doc_id spread over tasks; each task encodes its range in order and closes a file
    every ``file_tokens`` ids, so it holds one file at most.
    """
    bound_batches(docs.sparkSession)
    ordered = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
        )
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )
    files = ordered.mapInArrow(tidy(_write(path, end_id, file_tokens)), FILES)
    return workspace.store(files, "token-files")


def _offsets(files: DataFrame) -> DataFrame:
    """Ids before each file: part, seq, before. One row per file or part here."""
    sizes = files.select("part", "seq", "n_tokens")
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("all"))
    parts = parts.select("part", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    within = sizes.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return within.join(parts, "part").select(
        "part", "seq", (F.col("base") + F.col("own")).alias("before")
    )


def _read(with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("part", "seq", "payload"))
            for part, seq, payload in zip(*columns, strict=True):
                names, null, lengths, ids = unpack(payload)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                n = len(names)
                out = {
                    "part": pa.array(np.full(n, part, np.int32)),
                    "seq": pa.array(np.full(n, seq, np.int32)),
                    "doc_id": pa.array(names, mask=null),
                    "at": pa.array(starts),
                    "n_tokens": pa.array(lengths),
                }
                raw = memoryview(ids.astype("<u4").tobytes())
                spans = zip((4 * starts).tolist(), (4 * ends).tolist(), strict=True)
                out["ids_crc32"] = pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64())
                if with_ids:
                    edges = pa.array(np.append(starts, len(ids)).astype(np.int32))
                    out["ids"] = pa.ListArray.from_arrays(edges, pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_pydict(out)

    return run


def read_token_files(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """Documents of token files: doc_id, start, n_tokens, ids_crc32 (and ids).

    start counts the ids of all documents before; the checksum is that of the
    ids as little-endian unsigned 32-bit integers, the end id included. A file
    that was changed raises CorruptFile.
    """
    fields = "part int, seq int, doc_id long, at long, n_tokens long, ids_crc32 long"
    fields += ", ids array<int>" * with_ids
    rows = files.select("part", "seq", "payload").mapInArrow(tidy(_read(with_ids)), fields)
    columns = ["n_tokens", "ids_crc32", *["ids"] * with_ids]
    return rows.join(_offsets(files), ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), *columns
    )
