"""The corpus pipeline: documents go through the stages in order, each written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from comptoir.llm import importance, ngram_join, packing, quality_rules, suffix_dedup
from comptoir.session import cut_lineage


def by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance model samples. Null and empty texts have log weight 0 and are judged by it; repeated
    rows go or stay together, and so do rows without an id that have one text. Without good labels all stay."""
    return importance.keep_sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule. Null and empty texts have no words and go; rows are judged one by one, whatever
    their ids, so repeated rows share one fate."""
    return quality_rules.keep_good(docs)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``number`` of its own for each row, the id where all rows have one that does not repeat.
    Else rows are numbered in the order of id (null last) and text."""
    unclear = docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1")
    if unclear.isEmpty():
        return docs.withColumn("number", F.col("doc_id").cast("long"))
    # with the place of the row, so that equal rows too can be dealt to several tasks
    ordered = docs.withColumn("number", F.monotonically_increasing_id()).orderBy(F.asc_nulls_last("doc_id"), "text", "number")
    return cut_lineage(ordered.withColumn("number", F.monotonically_increasing_id()))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates. Rows are judged one by one: those that
    share an id go only if their texts are near duplicates, and a row without an id goes for one that has one."""
    rows = _numbered(docs)
    first = ngram_join.near_duplicates(rows, "number").filter("number = class_id").select("number")
    return rows.join(first.hint("shuffle_merge"), "number", "left_semi").select(docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand earlier too; all documents stay, some with an empty text."""
    others = [c for c in docs.columns if c not in ("text", "n_chars")]
    left = suffix_dedup.remove_repeats(docs, carry=others)
    found = {c: F.col(f"row.`{c}`") for c in others} | {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return left.select(*[found[c].alias(c) for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in training sequences: a null or empty text is one piece, its end mark alone; repeated rows
    are packed each. An empty table gives no pieces."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", by_classifier),
    ("quality_rules", by_rules),
    ("ngram_jaccard_join", one_of_near_duplicates),
    ("suffix_array_dedup", without_repeats),
    ("best_fit_packing", packed),
]
#: SQL cannot express hashed models, suffix arrays and a tokenizer; tests/llm/test_pipeline.py has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
