"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessella.llm import bag_minhash, bpe_automaton, chat_format, decontamination, language_id, line_dedup, ppm, quality_additive, token_files, vantage_points


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Where a public vocabulary file is; the files stay outside the repository."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.report(_table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(_table(spark, sf_dir, "documents"))


def op3_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.report(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op4_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_points.report(_table(spark, sf_dir, "embeddings"))


def op5_quality_additive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_additive.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.report(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.createDataFrame([(-7, n, role, "</s>[INST] ok [/INST]") for n, role in enumerate(("user", "assistant"))], rows.schema)
    return chat_format.report(rows.unionByName(tricky))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(_table(spark, sf_dir, "documents"))


def op10_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.classes(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ppm": op1_ppm,
    "op2_language_id": op2_language_id,
    "op3_bpe_automaton": op3_bpe_automaton,
    "op4_vantage_points": op4_vantage_points,
    "op5_quality_additive": op5_quality_additive,
    "op6_token_files": op6_token_files,
    "op7_chat_format": op7_chat_format,
    "op8_decontamination": op8_decontamination,
    "op9_line_dedup": op9_line_dedup,
    "op10_bag_minhash": op10_bag_minhash,
}
