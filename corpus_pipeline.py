"""Cleaning and packing of ``documents`` in stages; each works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import read_table, scratch_scope, written
from tidemark.llm.ngram_join import near_duplicates
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import keep_good
from tidemark.llm.recipes import keep_distinct_texts
from tidemark.llm.registry import SURROGATE_KEY, WORD_TOKENIZER
from tidemark.llm.surrogates import replace_personal_data
from tidemark.session import scratch_path
from tidemark.sources.storage import Storage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, read_table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space one stays."""
    return keep_distinct_texts(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates the document with the smallest id stays; those without an id do."""
    found = near_duplicates(docs, percent=75)
    dropped = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets are replaced by surrogates; ``n_chars`` follows the text."""
    replaced = replace_personal_data(docs, SURROGATE_KEY, plain_runs=False)
    changed = F.when(F.col("n_entities") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return replaced.withColumn("n_chars", changed).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of what is left in one place of a sequence."""
    return pack_documents(docs, WORD_TOKENIZER, end_id=2, size=4096, keep_ids=False, added_tokens=True)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Neither trained scores nor tokenizers can be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.

    What a stage writes for itself, and what the one before it wrote, goes when its result is written: of personal data
    and its surrogates nothing is left in the shared folder.
    """
    docs, before = read_table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        with scratch_scope(spark):
            docs = written(stage(spark, docs, sf_dir), name, path)
        if before:
            Storage(spark).delete(before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
