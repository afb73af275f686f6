"""The training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from liftkit.llm import chosen_path, exact_dedup, language_id, packing, source_mixing
from liftkit.llm.common import materialise, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the supported languages go."""
    found = language_id.identify(docs, declared_col="lang", host_col="source")
    return found.filter("_accepted").select(*[f"`{c}`" for c in docs.columns])


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return chosen_path.drop_near_duplicates(docs)


def source_mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeat to flatten their shares, at most twice; no document is left out."""
    return source_mixing.mix(docs, repeat_limit=source_mixing.REPEAT_LIMIT).select(*[f"`{c}`" for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_dedup_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("source_mixing", source_mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# language likelihoods, random permutations and the tokenizer have no SQL form
ORACLE_SQL = None
