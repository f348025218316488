"""Nulls, empty and very long texts, ties, repeated rows, empty tables, odd columns."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontaminate,
    html_text,
    line_dedup,
    mixing,
    ngram_join,
    quality_rules,
    registry,
    sharding,
    token_counts,
    token_files,
)
from tidemark.workspace import Workspace

LONG = " ".join(f"w{k % 997}" for k in range(120_000))
PROSE = " ".join(f"word{k}" for k in range(40))
NEAR = PROSE.replace("word39", "other")
ROWS = [
    (5, PROSE, "a", "x"), (5, PROSE, "a", "x"), (1, PROSE.upper(), "b", None),
    (2, NEAR, "a", "y"), (3, None, "a", "z"), (4, "", None, None), (6, " \n\t", None, "q"),
    (7, LONG, "b", "q"), (8, LONG, "b", "q"), (None, "no id here", "c", "q"),
    (None, None, None, None), (9, "one two", "a", ""), (10, "One TWO", "a", ""),
]
SCHEMA = "doc_id long, text string, source string, `odd.name` string"
CLASHES = ("quality", "found", "mix", "tokens", "__draw", "__held", "__range", "n_words", "block",
           "rate", "limit", "__rate", "__size", "quota", "copies")


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHES})


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


@pytest.fixture(scope="module")
def benchmark(spark):
    rows = [(1, PROSE.upper()), (None, "one, two"), (3, None), (4, ""), (1, PROSE)]
    return spark.createDataFrame(rows, "item_id long, text string").withColumn("found", F.lit(1))


@pytest.fixture
def workspace(spark):
    with Workspace(spark) as w:
        yield w


def by_id(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_quality(docs, none):
    found = quality_rules.with_quality(docs)
    assert set(found.columns) == set(docs.columns)
    kept = {r.doc_id for r in found.filter("quality.kept").collect()}
    assert kept == {1, 2, 5}
    assert found.filter("text IS NULL").select("quality.n_words").distinct().head()[0] == 0
    assert quality_rules.with_quality(none).count() == 0


def test_token_counts(docs, none):
    path = registry.tokenizer_path()
    found = token_counts.with_token_counts(docs, path)
    assert found.count() == len(ROWS)
    assert found.filter("text IS NULL").select("tokens.*").distinct().collect() == [(0, 0, False)]
    assert found.filter("doc_id = 7").head().tokens.over_limit
    assert token_counts.with_token_counts(none, path).count() == 0


def test_decontamination(spark, docs, none, benchmark, workspace):
    for most in (400_000, 7):  # one block, and many
        found = decontaminate.with_contamination(docs, benchmark, workspace, max_windows=most)
        hits = {(r.doc_id, r.found.n_hit, tuple(r.found.items)) for r in found.collect()}
        assert {h for h in hits if h[1]} == {
            (5, 40, ("1",)), (1, 40, ("1",)), (2, 39, ("1",)), (9, 2, ("null",)),
            (10, 2, ("null",)),
        }
        assert found.count() == len(ROWS)
    clean = decontaminate.clean_documents(docs, benchmark, workspace)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {3, 4, 6, 7, 8, None}
    cut = decontaminate.without_spans(docs, benchmark, workspace)
    assert cut.columns == docs.columns
    assert {(r.doc_id, r.text) for r in cut.filter("doc_id IN (2, 3, 9)").collect()} == {
        (2, " other"), (3, None), (9, ""),
    }
    assert decontaminate.clean_documents(none, benchmark, workspace).count() == 0
    empty = benchmark.filter("false")
    assert decontaminate.clean_documents(docs, empty, workspace).count() == len(ROWS)


@pytest.mark.parametrize("cell_rows", [4096, 1])
def test_ngram_join(docs, none, workspace, cell_rows):
    found = ngram_join.ngram_components(docs, workspace, cell_rows=cell_rows)
    assert by_id(found) == by_id_rows(
        [(5, 36, 1), (5, 36, 1), (1, 36, 1), (2, 36, 1), (3, 0, 3), (4, 0, 4), (6, 0, 6)]
        + [(7, 997, 7), (8, 997, 7), (None, 1, None), (None, 0, None), (9, 1, 9), (10, 1, 9)]
    )
    assert ngram_join.ngram_components(none, workspace).count() == 0


def by_id_rows(rows):
    return sorted(rows, key=repr)


def test_line_dedup(docs, none, workspace):
    found = line_dedup.repeated_lines(docs, workspace)
    goes = {(r.doc_id, r.line) for r in found.filter("exact OR near").collect()}
    # document 1 is in capitals; 2 comes before 5, 7 before 8
    assert goes == {(5, 0), (8, 0)}
    cut = line_dedup.without_repeated_lines(docs, workspace)
    assert cut.columns == docs.columns and cut.count() == len(ROWS)
    assert {r.text for r in cut.filter("doc_id IN (5, 8)").collect()} == {""}
    assert line_dedup.repeated_lines(none, workspace).count() == 0


def test_mixing(docs, none, workspace):
    found = mixing.with_mix(docs, workspace)
    assert found.count() == len(ROWS)
    sizes = {(r.doc_id, r.mix.size) for r in found.collect()}
    assert {(5, 40), (3, 0), (4, 0), (6, 0), (7, 120_000), (None, 3)} <= sizes
    assert all(r.mix.taken <= 3 * r.mix.size for r in found.collect())
    mixed = mixing.mixed(docs, workspace)
    assert mixed.columns == docs.columns
    total = found.agg(F.sum("mix.taken")).head()[0]
    assert mixed.agg(F.sum(mixing.word_count(F.col("text")))).head()[0] == total
    assert by_id(found.select("doc_id", "mix")) == by_id(
        mixing.with_mix(docs.repartition(5), workspace).select("doc_id", "mix")
    )
    assert mixing.with_mix(none, workspace).count() == mixing.mixed(none, workspace).count() == 0


def test_unequal_odds(spark, workspace):
    """Documents with higher inclusion odds are sampled more often."""
    rows = [(k, "w " * 10, "s" if k % 2 else "t") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    odds = F.when(F.col("doc_id") % 4 < 2, 9.0).otherwise(1.0)
    found = mixing.with_mix(docs, workspace, weights=(5, 1), odds=odds)
    small = found.filter("source = 't'")
    share = small.filter("mix.taken > 0").agg(F.avg((F.col("doc_id") % 4 < 2).cast("int")))
    assert share.head()[0] > 0.7
    taken, target = small.agg(F.sum("mix.taken"), F.first("mix.target")).head()
    assert abs(taken - target) <= 10


def test_sharding(docs, none, workspace):
    found = sharding.shard_rows(docs, workspace, shards=4)
    assert found.count() == len(ROWS)
    counts = [r["count"] for r in found.groupBy("shard").count().collect()]
    assert max(counts) - min(counts) <= 1
    assert found.groupBy("shard").agg(F.max("slot") + 1 == F.count("slot")).count() == 4
    assert found.filter("doc_id = 3").select("size", "text_crc32").head() == (16, 0)
    assert sharding.shard_rows(none, workspace).count() == 0
    assert sharding.shard_rows(docs, workspace).count() == len(ROWS)  # more shards than rows


def test_sharding_moves_copies_together(spark, workspace):
    rows = [(k, f"text {k % 40}" if k < 240 else f"single {k}") for k in range(1000)]
    rows += [(1000 + k, "hot") for k in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sharding.shard_rows(docs, workspace, shards=10)
    counts = {r["count"] for r in found.groupBy("shard").count().collect()}
    assert counts == {150}
    groups = sharding.cut_copies(found).filter("copies BETWEEN 2 AND 100").collect()
    assert len(groups) == 40 and sum(g.shards > 1 for g in groups) <= 4
    hot = sharding.cut_copies(found).filter("copies = 500").head()
    assert hot.shards <= 8  # of ten; each part of the group keeps together


def test_token_files(docs, none, workspace):
    path = registry.tokenizer_path()
    files = token_files.write_token_files(docs, path, workspace, file_tokens=1000)
    assert files.count() >= 2
    found = token_files.read_token_files(files, with_ids=True).collect()
    assert len(found) == len(ROWS)
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.doc_id for r in by_start] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10]
    at = 0
    for r in by_start:
        assert (r.start, r.n_tokens, r.ids[-1]) == (at, len(r.ids), 2)
        at += r.n_tokens
    assert [r.n_tokens for r in by_start if r.doc_id in (3, 4)] == [1, 1]
    empty = token_files.write_token_files(none, path, workspace)
    assert token_files.read_token_files(empty).count() == 0


def test_extraction(spark):
    rows = [(1, None), (2, ""), (3, "<p>a"), (3, "<p>a"), (None, "<article>" + "<p>x</p>" * 9000)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("main", F.lit(1))
    found = html_text.with_main_text(pages)
    texts = sorted((r.page_id or 0, r.main.text[:3], r.main.n_chars) for r in found.collect())
    assert texts == [(0, "x\nx", 17_999), (1, "", 0), (2, "", 0), (3, "a", 1), (3, "a", 1)]
    assert html_text.with_main_text(pages.filter("false")).count() == 0


def test_chat_with_long_turns(spark, workspace):
    rows = [(1, 0, "user", LONG), (1, None, "user", ""), (1, 1, "assistant", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = registry.tokenizer_path()
    found = chat.read_conversations(*chat.format_conversations(turns, path, workspace), path)
    assert found.select("n_turns", "loss_chars").head() == (3, 0)


def test_probability_follows_size(spark, workspace):
    """Over many seeds, how often documents are taken goes with their size; the largest
    are certain."""
    rows = [(k, "w " * (40 if k < 60 else 80 if k < 90 else 4000 if k == 90 else 10), "a") for k in range(120)]
    rows += [(k, "w " * 1000, "b") for k in range(120, 220)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    times = dict.fromkeys(range(120), 0)
    for seed in range(12):
        found = mixing.with_mix(df, workspace, weights=(1, 19), most=3, seed=str(seed))
        for r in found.filter("source = 'a'").collect():
            times[r.doc_id] += r.mix.copies
        assert abs(r.mix.target - sum(
            x.mix.taken for x in found.filter("source = 'a'").collect())) <= 80
    assert times[90] == 12
    small, middle, large = (
        sum(times[k] for k in ks) / len(ks) / 12
        for ks in (range(91, 120), range(60), range(60, 90))
    )
    assert 2.5 < middle / small < 6.5 and 1.5 < large / middle < 2.7


def test_token_files_of_one_id_keep_their_order(spark, workspace):
    rows = [(1, f"text {k}") for k in range(9)] + [(1, None), (None, "x"), (None, "y")]
    path, seen = registry.tokenizer_path(), set()
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        files = token_files.write_token_files(df, path, workspace)
        found = token_files.read_token_files(files).orderBy("start").collect()
        seen.add(tuple((r.doc_id, r.start, r.ids_crc32) for r in found))
    assert len(seen) == 1
