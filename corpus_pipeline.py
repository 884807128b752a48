"""A training corpus from ``documents``: language, near duplicates, contamination, mixture, shards.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return the
columns of ``documents``; other columns of the input are not carried. Null texts and texts without a letter are
rejected by the first stage; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm.common import cut, table
from tessella.llm.decontamination import decontaminate
from tessella.llm.language import fold, identify
from tessella.llm.mixing import mixed_documents
from tessella.llm.near import keep_one
from tessella.llm.shards import shuffle_shards

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with calibrated confidence."""
    found = identify(docs.select(*DOCUMENT), fold("doc_id", 3) != 1, carry=DOCUMENT)
    return found.filter("NOT rejected").select(*DOCUMENT)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8 or more), the one with the least id."""
    return keep_one(docs.select(*DOCUMENT))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    found = decontaminate(docs.select(*DOCUMENT), table(spark, sf_dir, "benchmark"), carry=DOCUMENT)
    return found.filter("NOT contaminated").select(*DOCUMENT)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often, and with as many of their blocks, as the mix of their sources takes them."""
    return mixed_documents(docs.select(*DOCUMENT))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shuffled shards of the mix, with shard and slot of every row."""
    return shuffle_shards(docs.select(*DOCUMENT), carry=DOCUMENT)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: SQL can express neither a trained classifier nor the shuffles; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
