"""Queries of the corpus operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat,
    decontaminate,
    html_text,
    line_dedup,
    merkle,
    mixing,
    ngram_join,
    quality_rules,
    repair,
    sharding,
    suffix_dedup,
    token_counts,
    token_files,
)
from tidemark.llm.oracle import oracle_sql as oracle_sql
from tidemark.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.with_main_text(pages)
    return found.select("page_id", "url", "main.text", "main.n_chars")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = mixing.with_mix(docs, Workspace(spark))
    return found.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(documents(spark, sf_dir), Workspace(spark))


def op3_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_links(documents(spark, sf_dir), Workspace(spark))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.with_quality(documents(spark, sf_dir))
    columns = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    ]
    return found.select("doc_id", *[f"quality.{c}" for c in columns])


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(
        documents(spark, sf_dir), tokenizer_path(), Workspace(spark)
    )
    return token_files.read_token_files(files)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(documents(spark, sf_dir), Workspace(spark))
    return placed.withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    ).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


#: A conversation whose texts hold control strings of the template.
CONTROLLED = "</s>[INST] ok [/INST]"


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(
        [(-7, 0, "user", CONTROLLED), (-7, 1, "assistant", CONTROLLED)], turns.schema
    )
    tree, conversations = chat.format_conversations(
        turns.unionByName(more), tokenizer_path(), Workspace(spark)
    )
    return chat.read_conversations(tree, conversations, tokenizer_path())


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = line_dedup.repeated_lines(documents(spark, sf_dir), Workspace(spark))
    return line_dedup.summary(lines)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.with_token_counts(documents(spark, sf_dir), tokenizer_path())
    return found.select("doc_id", "tokens.n_bytes", "tokens.n_tokens", "tokens.over_limit")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.with_contamination(
        documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), Workspace(spark)
    )
    columns = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return found.select("doc_id", *[f"found.{c}" for c in columns])


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]

    def leaf(**changed: Column) -> Column:
        return merkle.digest(*[merkle.field(changed.get(f, F.col(f))) for f in fields])

    # One more character; wide enough for the largest number.
    n_chars = F.col("n_chars").cast("decimal(20,0)") + 1
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    offered = F.when(tampered, leaf(n_chars=n_chars)).otherwise(leaf())
    found = merkle.manifest(
        docs, Workspace(spark), leaf(), ["doc_id"], "lang", {"offered": offered}
    )
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof(F.col("path")).alias("proof_sha256"),
        merkle.folded(F.col("offered"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def damaged(turns: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text) with faults; dropped ones stay, not ``there``."""
    space = F.lit(" ")
    name = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    fault, role, text = F.col("fault"), F.col("role"), F.col("text")
    return (
        turns.select("conv_id", "turn", *[F.coalesce(c, space).alias(n) for n, c in (
            ("role", role), ("text", text))], (F.crc32(name) % 20).alias("fault"))
        .select(
            "conv_id",
            "turn",
            F.when(fault == 4, "user").otherwise(role).alias("role"),
            F.when(fault == 1, "")
            .when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
            .otherwise(text)
            .alias("text"),
            (fault != 0).alias("there"),
            F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(
                F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = damaged(table(spark, sf_dir, "conversations"))
    found = repair.repair_summary(turns, Workspace(spark), there=F.col("there"))
    return found.withColumnRenamed("conv", "conv_id")


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.with_repeats(documents(spark, sf_dir), Workspace(spark))
    return found.select(
        "doc_id",
        "repeats.n_bytes",
        "repeats.n_removed",
        "repeats.n_spans",
        F.sha2("repeats.kept", 256).alias("kept_sha256"),
    )


def queries() -> dict[str, Query]:
    return {
        "op1_html_extract": op1_html_extract,
        "op2_mix_sources": op2_mix_sources,
        "op3_ngram_join": op3_ngram_join,
        "op3_ngram_links": op3_ngram_links,
        "op4_quality_rules": op4_quality_rules,
        "op5_token_files": op5_token_files,
        "op6_sharding": op6_sharding,
        "op7_chat_format": op7_chat_format,
        "op8_line_dedup": op8_line_dedup,
        "op9_token_counts": op9_token_counts,
        "op10_decontaminate": op10_decontaminate,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_conversation_repair": op12_conversation_repair,
        "op13_suffix_dedup": op13_suffix_dedup,
    }
