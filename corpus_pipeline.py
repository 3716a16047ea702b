"""A cleaning, mixing and packing run over ``documents``: each stage reads what its predecessor wrote.

Language identification drops what it rejects, copies and near copies leave one row each, sources are mixed to their
target weights (a document taken twice is there twice), and what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardloom.llm import exact_dedup, language_id, mixing, ngram_join, packing
from cardloom.llm.common import documents, stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each_component(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("source_mixing", mixed_sources),
    ("best_fit_packing", packed_sequences),
]

# Encoding and the learnt language model cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; the result of the last is not written here."""
    docs = documents(spark, sf_dir)
    for at, (_, step) in enumerate(STAGES):
        docs = step(spark, docs if at == 0 else stage(docs), sf_dir)
    return docs
