"""Corpus preparation in five stages: quality, line dedup, near-dedup, decontamination, tokens.

Each stage takes what the one before it kept. All but the last return the columns of `documents`:
quality drops documents that the additive model rejects; line dedup deletes later copies of repeated line runs and
documents that consist of them; near-dedup keeps the document with the least id of each class; decontamination
drops documents that hold a benchmark passage; the last stage encodes what is left.

With null ids, null texts, repeated rows and empty tables each stage does what its operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.llm import bag_minhash, bpe_automaton, decontamination, line_dedup, quality_additive
from tessella.llm.queries import tokenizer
from tessella.storage import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, trained on the labelled ones of all `documents`, doesn't reject."""
    model = quality_additive.train(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return quality_additive.keep(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs; n_chars follows the text."""
    cleaned = line_dedup.clean(docs)
    if "n_chars" not in docs.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class."""
    return bag_minhash.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"), remove="documents")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the digests of ids and decoded text."""
    encoded = bpe_automaton.encode(docs, tokenizer("word_bpe_49k.json"), decoded=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [("quality classifier", quality), ("line dedup", lines), ("minhash near-dedup", near_duplicates), ("benchmark decontamination", benchmark), ("bpe encoding and decoding", tokens)]

#: Near-duplicate classes and the classifier have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written and read again before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
