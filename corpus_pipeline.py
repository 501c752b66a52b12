"""Corpus pipeline: documents to tokens in five stages, each written as Parquet before the next one reads it.

quality rules, line dedup, SimHash near-dedup, benchmark decontamination, BPE. Every stage takes and returns whole
tables; all but the last return the columns of documents.

Rows without a doc_id are judged by the quality rules and searched for benchmark items; they take no part in what
compares documents with one another, so they stay there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airshed.llm import bpe_stream, decontam, line_runs, quality_rules, simhash
from airshed.llm.common import stage, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept_documents(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur across documents; ``n_chars`` follows the text."""
    lines = line_runs.dedup_lines(docs)
    after = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return lines.select(*[after[c].alias(c) if c in after else F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the least doc_id."""
    groups = simhash.simhash_components(docs)
    return docs.join(groups.where("doc_id != component_id").select("doc_id").distinct(), "doc_id", "left_anti") \
        .select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; a row without a doc_id is searched on its own, under its text's hash."""
    items, text_hash = table(spark, sf_dir, "benchmark"), F.xxhash64(F.coalesce("text", F.lit("")))
    nameless = docs.where("doc_id is null").select(text_hash.alias("key"), "text")
    found = [(False, decontam.find_items(docs, items)), (True, decontam.find_items(nameless, items, id_col="key"))]
    by_id, by_text = (rows.select(F.lit(no_id).alias("no_id"), F.col("doc_id").alias("key")) for no_id, rows in found)
    held = by_id.union(by_text).distinct().alias("held")
    doc_id = F.col("row.doc_id")
    key = F.coalesce(doc_id.cast("long"), F.xxhash64(F.coalesce("row.text", F.lit(""))))
    same = (doc_id.isNull() == F.col("held.no_id")) & (key == F.col("held.key"))
    return docs.alias("row").join(held, same, "left_anti")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return bpe_stream.token_digests(docs, bpe_stream.word_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("BPE encoding and decoding", token_stage),
]

# A fingerprint's majority over hashed shingles and the merges of BPE are beyond a SQL statement over these tables; the
# tests hold the result against a plain Python version of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
