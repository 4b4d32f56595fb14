"""The operators as registered queries over the whole tables, and their DuckDB statements.

A query calls its operator with production parameters and derives the columns to compare.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fairwake.llm.common import documents, scratch, tokenizer_path
from fairwake.llm.exact_dedup import exact_groups
from fairwake.llm.filter_audit import interactions
from fairwake.llm.html_text import extract_text
from fairwake.llm.langid import identify
from fairwake.llm.licenses import license_labels
from fairwake.llm.packing import pack
from fairwake.llm.pieces import decode, encode
from fairwake.llm.quality import quality
from fairwake.llm.secrets import secret_spans
from fairwake.llm.sharding import shard_rows
from fairwake.llm.simhash import near_groups
from fairwake.llm.statements import STATEMENTS
from fairwake.llm.token_files import checksums, read_ids, with_start, write_ids
from fairwake.llm.turn_repair import damaged, repaired

__all__ = ["QUERIES", "STATEMENTS"]

Query = Callable[[SparkSession, str], DataFrame]


def op1_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir), shards=8).withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(documents(spark, sf_dir))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per chunk: tokens, and what decoding them gives back."""
    model = tokenizer_path("piece_bpe_32k.model")
    texts = decode(encode(documents(spark, sf_dir), model), model)
    return texts.select(
        "doc_id",
        "chunk",
        "chunks",
        F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.select("page_id", "text", F.size(F.split("text", "\n")).cast("long").alias("n_lines"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(documents(spark, sf_dir).select("doc_id", "text", "lang"))
    return found.select(
        "doc_id",
        F.col("language.held_out").alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(documents(spark, sf_dir))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select(
        "doc_id", *(F.col(f"quality.{f}").alias(f) for f in fields), F.array_join("quality.failed", ",").alias("failed")
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "format")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path(), with_ids=False)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_labels(documents(spark, sf_dir))
    places = F.transform("base", lambda b: b["place"].cast("long"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        F.round("score", 9).alias("score"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(documents(spark, sf_dir), hash_all=True)
    return groups.withColumnRenamed("full_hash", "text_sha256")


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = documents(spark, sf_dir), scratch(spark, "token-files")
    write_ids(docs, tokenizer_path(), path)
    stored = read_ids(spark, path, docs.schema["doc_id"].dataType)
    return with_start(checksums(stored), stored).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repaired(damaged(turns))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_shards,
        op2_simhash,
        op3_sentencepiece,
        op4_html_text,
        op5_language_id,
        op6_quality_rules,
        op7_secret_scan,
        op8_packing,
        op9_license_scan,
        op10_exact_dedup,
        op11_token_files,
        op12_conversation_repair,
        op13_filter_audit,
    )
}
