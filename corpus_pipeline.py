"""The corpus pipeline: quality, near-duplicates, benchmark, mixture, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinnear.llm.mixing import mixed_documents
from kinnear.llm.quality import keep_good
from kinnear.llm.queries import token_index
from kinnear.llm.simhash import keep_one
from kinnear.llm.tables import stage, table
from kinnear.llm.winnow import drop_contaminated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; odd rows as in :func:`keep_good`."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group; odd rows as in :func:`keep_one`."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark; odd rows as in :func:`drop_contaminated`."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of the sources draws them; odd rows as in :func:`mixed_documents`."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row a document from the token files that this stage writes; odd rows as in :func:`token_index`."""
    return token_index(spark, docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
