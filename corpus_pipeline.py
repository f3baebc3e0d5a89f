"""Training-data pipeline over ``documents``: quality classifier, exact dedup, near
dedup, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the
documents it keeps with their columns, the last one the packed pieces.  ``run`` applies
them in order and writes each result to the shared work folder before the next reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veridq.llm import exact, gam, packing, setsketch
from veridq.llm.common import materialise, read
from veridq.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return gam.keep_good(docs, sf_dir)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact.keep_first(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return setsketch.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their place in a sequence."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("packing", pack),
]

#: The first, third and last stage have no SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
