import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import words as w

TEXTS = st.lists(
    st.one_of(st.none(), st.text(alphabet="ab1 \n\t\x0b\x1fé日 .", max_size=30)), max_size=8
)
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    offsets, data = w.text_bytes(pa.array(texts, pa.string()))
    for table, pattern in ((w.SPACED, SPACED), (w.ALNUM, ALNUM)):
        found = w.find_words(offsets, data, table)
        raw = data.tobytes()
        spans = [raw[a:b].decode() for a, b in zip(found.start, found.end, strict=True)]
        expected = [pattern.findall(t or "") for t in texts]
        assert spans == [x for e in expected for x in e]
        assert found.counts.tolist() == [len(e) for e in expected]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_lines_are_those_of_split(texts):
    offsets, data = w.text_bytes(pa.array(texts, pa.string()))
    start, end, bound = w.lines(offsets, data)
    raw = data.tobytes()
    spans = [raw[a:b].decode() for a, b in zip(start, end, strict=True)]
    split = [(t or "").split("\n") for t in texts]
    assert spans == [x for s in split for x in s]
    assert np.diff(bound).tolist() == [len(s) for s in split]


def test_hashes_depend_on_content_only():
    texts = ["a bb a", "bb", "", None, "xx a bb a bb"]
    offsets, data = w.text_bytes(pa.array(texts))
    found = w.find_words(offsets, data)
    hashes = found.hashes()
    raw = data.tobytes()
    by_hash = {}
    for h, a, b in zip(hashes, found.start, found.end, strict=True):
        assert by_hash.setdefault(int(h), raw[a:b]) == raw[a:b]
    assert len(by_hash) == 3
    first, windows = found.windows(hashes, 3)
    assert first.tolist() == [0, 4, 5, 6]
    assert windows[0] == windows[2] != windows[1]


def test_slices_hold_whole_rows():
    batch = pa.record_batch({"text": ["a" * 10, None, "b" * 100, "", "c"], "k": [1, 2, 3, 4, 5]})
    parts = list(w.slices(batch, "text", 20))
    assert [p["k"].to_pylist() for p in parts] == [[1, 2], [3], [4, 5]]
    assert [p["k"].to_pylist() for p in w.slices(batch.slice(1, 3), "text", 1000)] == [[2, 3, 4]]
    assert list(w.slices(batch.slice(0, 0), "text")) == []


def test_block_hashes_are_equal_for_equal_words_only():
    rng = np.random.default_rng(8)
    spans = [bytes(rng.integers(0, 3, n).astype(np.uint8)) for n in [*range(1, 90)] * 6]
    spans += [s + b"\0" for s in spans] + [s[:-1] + b"\x01" for s in spans]
    end = np.cumsum([len(s) for s in spans])
    start = end - [len(s) for s in spans]
    data = np.frombuffer(b"".join(spans), np.uint8)
    found = w.block_hashes(data, start, end)
    assert len(set(found.tolist())) == len(set(spans))
    assert len(set(zip(found.tolist(), spans, strict=True))) == len(set(spans))
