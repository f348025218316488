"""The pipeline against plain Python, and on odd tables."""

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import registry
from tidemark.workspace import Workspace

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def rows(name):
    return pq.read_table(f"{SF_DIR}/{name}.parquet").to_pylist()


def grams(words, n):
    return [tuple(words[k : k + n]) for k in range(len(words) - n + 1)]


def good(text):
    """The quality rules, one word at a time."""
    words, chars = WORD.findall(text), sum(map(len, WORD.findall(text)))
    if len(words) < 10:
        return False
    for n, limit in ((5, 20), (8, 18), (12, 16)):
        found = grams(words, n)
        inside = {k + j for k, g in enumerate(found) if found.count(g) > 1 for j in range(n)}
        if n == 5 and 100 * len(inside) > 20 * len(words):
            return False
        if 100 * sum(len(words[k]) for k in inside) > limit * chars:
            return False
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeated = sum(len("".join(WORD.findall(x))) for x in lines if lines.count(x) > 1)
    return 100 * repeated <= 30 * chars


def without_copies(texts):
    sets = {}
    for doc, text in texts.items():
        words = WORD.findall(text.translate(_LOWER))
        sets[doc] = set(grams(words, min(5, len(words)))) if words else set()
    root = {d: d for d in sets}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {d: new if r == old else r for d, r in root.items()}
    return {d: t for d, t in texts.items() if root[d] == d}


def clean(texts):
    tests = set()
    for item in rows("benchmark"):
        words = ITEM.findall((item["text"] or "").translate(_LOWER))
        tests |= set(grams(words, min(13, len(words)))) if words else set()
    lengths = {len(t) for t in tests}
    out = {}
    for doc, text in texts.items():
        words = ITEM.findall(text.translate(_LOWER))
        hit = {
            k + j
            for n in lengths
            for k, g in enumerate(grams(words, n))
            if g in tests
            for j in range(n)
        }
        if not hit or 20 * len(hit) < len(words):
            out[doc] = text
    return out


@pytest.fixture(scope="module")
def stages(spark):
    with Workspace(spark) as w:
        docs, out = registry.table(spark, SF_DIR, "documents"), []
        for name, stage in corpus_pipeline.STAGES:
            docs = w.store(stage(spark, docs, SF_DIR), "stage")
            out.append((name, docs))
        yield out


def test_filtering_stages(stages):
    texts = {r["doc_id"]: r["text"] or "" for r in rows("documents")}
    steps = [
        lambda t: {d: x for d, x in t.items() if good(x)},
        without_copies,
        clean,
    ]
    for (name, docs), step in zip(stages, steps, strict=False):
        texts = step(texts)
        assert {r.doc_id: r.text or "" for r in docs.collect()} == texts, name


def test_all_but_the_last_return_documents(spark, stages):
    columns = registry.table(spark, SF_DIR, "documents").dtypes
    assert all(docs.dtypes == columns for _, docs in stages[:-1])


def test_mix_repeats_documents_of_its_predecessor(stages):
    before = {r.doc_id: r for r in stages[2][1].collect()}
    mix = stages[3][1].collect()
    assert all(before[r.doc_id] == r for r in mix)
    assert max(sum(r.doc_id == d for r in mix) for d in before) <= 3


def test_result_is_the_last_stage(spark, stages):
    found = sorted(map(tuple, corpus_pipeline.run(spark, SF_DIR).collect()))
    assert found == sorted(map(tuple, stages[-1][1].collect()))
    mix = sorted(r.doc_id for r in stages[3][1].collect())
    assert [r[0] for r in sorted(found, key=lambda r: r[1])] == mix


@pytest.mark.parametrize("k", range(4))
def test_odd_rows_pass_every_stage(spark, k):
    text = " ".join(f"w{i}" for i in range(30))
    docs = registry.table(spark, SF_DIR, "documents").limit(0)
    odd = spark.createDataFrame(
        [(1, text), (1, text), (None, text + " a"), (2, None), (3, ""), (4, text + " b c")],
        "doc_id long, text string",
    )
    odd = odd.withColumns({c: F.lit(None) for c in ("lang", "source", "__mix", "__id", "a.b")})
    name, stage = corpus_pipeline.STAGES[k]
    found = stage(spark, odd, SF_DIR)
    assert found.columns == odd.columns, name
    ids = sorted((r.doc_id or 0) for r in found.collect())
    if k == 0:
        assert ids == [0, 1, 1, 4]
    if k == 1:
        assert ids == [0, 1, 2, 3]
    if k == 2:
        assert ids == [0, 1, 1, 2, 3, 4]
    if k == 3:
        assert set(ids) <= {0, 1, 4} and ids
    assert stage(spark, docs, SF_DIR).count() == 0


def test_repeated_ids_keep_one_row_whatever_the_order(spark):
    text = " ".join(f"word{k}" for k in range(30))
    rows = [(1, f"{text} {k}", "a", None, k) for k in range(6)] + [(2, None, "b", "x", 1)]
    schema = "doc_id long, text string, source string, lang string, n_chars long"
    found = set()
    for parts in (1, 3, 5):
        docs = spark.createDataFrame(rows[::-1] if parts == 3 else rows, schema).repartition(parts)
        kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
        assert sorted(r.doc_id for r in kept) == [1, 2]
        found.add(next(r.text for r in kept if r.doc_id == 1))
    assert len(found) == 1


def test_only_the_result_is_left_in_the_shared_folder(spark, tmp_path, monkeypatch):
    from tidemark import workspace

    monkeypatch.setattr(workspace, "shared_root", lambda spark: str(tmp_path))
    result = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    left = [p for p in tmp_path.glob("*/*") if p.is_dir()]
    assert [p.name.split("-")[0] for p in left] == ["stage"]
    assert result.count() > 0
