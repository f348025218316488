"""Benchmark decontamination: documents against a broadcast set of test windows."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.annotate import annotate
from tidemark.llm.batches import bound_batches, tidy
from tidemark.llm.columns import free_name, own, quoted
from tidemark.llm.words import ALNUM, LOWER, find_words, slices, text_bytes
from tidemark.workspace import Workspace

WINDOW = 13
#: Windows of test items broadcast at once, some 150 bytes each.
MAX_WINDOWS = 400_000
#: Bits of the first, small lookup table.
_FILTER_BITS = 20

FIELDS = (
    "n_words long, n_hit long, n_items long, items array<string>, "
    "items_sha256 string, contaminated boolean, spans array<struct<start: int, end: int>>"
)


@dataclass
class TestSet:
    """Windows of one length: sorted hashes, and by words the items that have each."""

    length: int
    hashes: np.ndarray
    items: list[dict[bytes, list[str]]]
    table: np.ndarray


def _phrase(data: bytes, words, first: int, n: int) -> bytes:
    """The words of a window, joined by single blanks."""
    spans = zip(words.start[first : first + n], words.end[first : first + n], strict=True)
    return b" ".join(data[a:b] for a, b in spans)


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, data = text_bytes(part["text"])
                data = LOWER[data]
                words = find_words(offsets, data, ALNUM)
                raw, hashes, counts = data.tobytes(), words.hashes(), words.counts
                rows = []
                for n in sorted({min(window, int(c)) for c in counts if c}):
                    first, found = words.windows(hashes, n)
                    of = words.text_of()[first]
                    own = np.minimum(counts[of], window) == n
                    for f, h, d in zip(first[own], found[own], of[own], strict=True):
                        rows.append(
                            (
                                n,
                                int(h.astype(np.int64)),
                                _phrase(raw, words, f, n),
                                part["item_id"][int(d)].as_py(),
                            )
                        )
                columns = list(zip(*rows, strict=True)) or [[], [], [], []]
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    names=["n", "hash", "words", "item"],
                )

    return run


def _test_sets(table: pa.Table) -> list[TestSet]:
    out = []
    lengths = np.array(table["n"], np.int64)
    for n in sorted(set(lengths.tolist())):
        rows = table.filter(pa.array(lengths == n))
        by_hash: dict[int, dict[bytes, set[str]]] = {}
        columns = (rows[c].to_pylist() for c in ("hash", "words", "item"))
        for h, words, item in zip(*columns, strict=True):
            by_hash.setdefault(h % 2**64, {}).setdefault(words, set()).add(item)
        keys = sorted(by_hash)
        hashes = np.array(keys, np.uint64)
        table_ = np.zeros(1 << _FILTER_BITS, bool)
        table_[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        out.append(
            TestSet(
                n,
                hashes,
                [{w: sorted(found) for w, found in by_hash[k].items()} for k in keys],
                table_,
            )
        )
    return out


def _scan(part: pa.RecordBatch, tests: list[TestSet], found_before: str | None):
    """All columns of FIELDS; hits of earlier blocks of the benchmark are added."""
    offsets, data = text_bytes(part["text"])
    data = LOWER[data]
    words = find_words(offsets, data, ALNUM)
    hashes, counts, text_of = words.hashes(), words.counts, words.text_of()
    hit = np.zeros(len(hashes), bool)
    items: list[set[str]] = [set() for _ in counts]
    if found_before is not None:
        before = part[found_before]
        for d, old in enumerate(before.to_pylist()):
            items[d].update(old["items"])
            for span in old["spans"]:
                hit[words.bound[d] + span["start"] : words.bound[d] + span["end"]] = True
    raw = None
    for test in tests:
        first, windows = words.windows(hashes, test.length)
        maybe = test.table[(windows >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]
        first, windows = first[maybe], windows[maybe]
        at = np.searchsorted(test.hashes, windows)
        at[at == len(test.hashes)] = 0
        equal = test.hashes[at] == windows
        for f, k in zip(first[equal].tolist(), at[equal].tolist(), strict=True):
            raw = data.tobytes() if raw is None else raw
            found = test.items[k].get(_phrase(raw, words, f, test.length))
            if found is not None:
                hit[f : f + test.length] = True
                items[text_of[f]].update(found)
    sums = np.zeros(len(hit) + 1, np.int64)
    np.cumsum(hit, out=sums[1:])
    n_hit = sums[words.bound[1:]] - sums[words.bound[:-1]]
    spans: list[list[dict]] = [[] for _ in counts]
    for d in np.flatnonzero(n_hit):
        a, b = int(words.bound[d]), int(words.bound[d + 1])
        edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[a:b], [0]]).astype(np.int8)))
        spans[d] = [{"start": int(s), "end": int(e)} for s, e in edge.reshape(-1, 2)]
    named = [sorted(i) for i in items]
    digests = [hashlib.sha256(",".join(i).encode()).hexdigest() for i in named]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    return {
        "n_words": pa.array(counts, pa.int64()),
        "n_hit": pa.array(n_hit, pa.int64()),
        "n_items": pa.array([len(i) for i in named], pa.int64()),
        "items": pa.array(named, pa.list_(pa.string())),
        "items_sha256": pa.array(digests, pa.string()),
        "contaminated": pa.array((n_hit > 0) & (20 * n_hit >= counts)),
        "spans": pa.array(spans, kind),
    }


def with_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    workspace: Workspace,
    name: str = "found",
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` with a struct column of what the benchmark's texts have in common.

    A test item's windows are its runs of ``window`` consecutive words, or all
    its words if they are fewer. A document word inside any occurrence of a
    window is hit; ``spans`` are the runs of hit words. Equal hashes are
    verified word by word. A document is contaminated if a twentieth of its
    words or more is hit.

    Null, blank and symbol-only texts have no words, match nothing and are
    clean; a null item_id counts as the string "null". Repeated rows and items,
    nulls and further columns pass; empty tables on either side work.

    The windows are counted before they are broadcast. Beyond ``max_windows``
    the items are dealt into blocks of about that many, and the documents are
    scanned once for each block, carrying what the earlier ones found.
    """
    bound_batches(docs.sparkSession)
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text"
    )
    windows = workspace.store(
        items.mapInArrow(tidy(_item_windows(window)), "n int, hash long, words binary, item string"),
        "windows",
    )
    blocks = max(1, -(-windows.count() // max_windows))
    columns = [c for c in docs.columns if c != name]
    old = None
    for k in range(blocks):
        own = windows.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        tests = docs.sparkSession.sparkContext.broadcast(_test_sets(own.toArrow()))
        new = free_name(docs, name) if k < blocks - 1 else name

        def compute(part, tests=tests, old=old):
            return _scan(part, tests.value, old)

        scanned = annotate(docs, compute, FIELDS, new)
        docs = scanned.select(*map(quoted, columns), quoted(new))
        if k < blocks - 1:
            docs, old = workspace.store(docs, "scanned"), new
    return docs


def clean_documents(docs: DataFrame, benchmark: DataFrame, workspace: Workspace) -> DataFrame:
    """The documents that are not contaminated, with their own columns only."""
    name = free_name(docs, "__found")
    found = with_contamination(docs, benchmark, workspace, name)
    return found.filter(~F.col(f"{name}.contaminated")).select(*own(docs))


def _without_spans(part: pa.RecordBatch, found: str) -> dict[str, pa.Array]:
    offsets, data = text_bytes(part["text"])
    words = find_words(offsets, LOWER[data], ALNUM)
    raw = data.tobytes()
    out = []
    for d, report in enumerate(part[found].to_pylist()):
        if not report["spans"]:
            out.append(part["text"][d].as_py())
            continue
        at, kept = int(offsets[d]), []
        for span in report["spans"]:
            first = int(words.bound[d]) + span["start"]
            last = int(words.bound[d]) + span["end"] - 1
            kept.append(raw[at : int(words.start[first])])
            at = int(words.end[last])
        kept.append(raw[at : int(offsets[d + 1])])
        out.append(b"".join(kept).decode("utf-8"))
    return {"text": pa.array(out, pa.string())}


def without_spans(docs: DataFrame, benchmark: DataFrame, workspace: Workspace) -> DataFrame:
    """All documents, each without its hit words and what stands between them."""
    name = free_name(docs, "__found")
    found = with_contamination(docs, benchmark, workspace, name)
    new = free_name(found, "__cut")
    cut = annotate(found, lambda part: _without_spans(part, name), "text string", new)
    text = F.col(f"{new}.text").alias("text")
    return cut.select(*[text if c == "text" else quoted(c) for c in docs.columns])
