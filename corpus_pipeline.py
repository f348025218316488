"""The corpus pipeline: quality, near duplicates, decontamination, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    mixing,
    ngram_join,
    quality_rules,
    registry,
    token_files,
)
from tidemark.llm.columns import free_name, own, quoted
from tidemark.workspace import Workspace, cleared


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns.

    A null or empty text has too few words and goes; repeated rows are judged alike.
    An empty table stays empty, as in every stage.
    """
    name = free_name(docs, "__quality")
    found = quality_rules.with_quality(docs, name=name)
    return found.filter(f"{name}.kept").select(*own(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least doc_id.

    Rows of one doc_id count as one document: the one whose text has the least digest
    stays, of equal texts any in which the other columns' hash is least, so reruns
    agree. Rows without doc_id all stay, and so do null and empty texts.
    """
    groups = ngram_join.ngram_components(docs.select("doc_id", "text"), Workspace(spark))
    # Most documents are neither repeated nor a copy, and need no mark.
    marks = (
        groups.groupBy("doc_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("component_id").alias("component"))
        .withColumn("stays", F.col("doc_id") == F.col("component"))
        .filter("NOT stays OR rows > 1")
    )
    key, stays = free_name(docs, "__id"), free_name(docs, "__stays")
    named = marks.select(F.col("doc_id").alias(key), F.col("stays").alias(stays))
    marks = Workspace(spark).store(named, "marks")
    marked = docs.join(marks, docs["doc_id"] == marks[key], "left")
    single = marked.filter(F.col(key).isNull()).select(*own(docs))
    hashed = [quoted(f.name) for f in docs.schema if f.dataType.typeName() not in _UNHASHED]
    rank = F.struct(F.sha2(F.coalesce("text", F.lit("")), 256), F.xxhash64(*hashed))
    repeated = (
        marked.filter(stays)
        .groupBy(quoted(key))
        .agg(F.min_by(F.struct(*own(docs)), rank).alias("row"))
        .select("row.*")
    )
    return single.unionByName(repeated)


_UNHASHED = ("map", "variant")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate, with all their columns.

    Null and empty texts have no words and stay; without a benchmark all do.
    """
    benchmark = registry.table(spark, sf_dir, "benchmark")
    return decontaminate.clean_documents(docs, benchmark, Workspace(spark))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it, up to three times.

    A null source is a source of its own; texts without words have no size, and rows
    of a source that gets no words go.
    """
    return mixing.mixed(docs, Workspace(spark))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32.

    A document that the mix repeats is written as often; a null text has the end id
    alone. Rows of one doc_id lie next to each other.
    """
    files = token_files.write_token_files(docs, registry.tokenizer_path(), Workspace(spark))
    return token_files.read_token_files(files)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("token-ID / binary output", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each reading what the one before wrote."""
    docs, before = registry.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        workspace = Workspace(spark)
        with cleared():  # what the stage stored on its way
            docs = workspace.store(stage(spark, docs, sf_dir), "stage")
        if before is not None:
            before.clear()
        before = workspace
    return docs


ORACLE_SQL = None
