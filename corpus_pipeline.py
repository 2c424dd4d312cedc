"""The corpus pipeline: documents in, shards of a cleaned and mixed corpus out.

Each stage works on all rows its predecessor kept and returns the columns of
``documents``; the last adds ``shard`` and ``slot``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from churnlab.llm.common import saved, table
from churnlab.llm.decontaminate import without_contaminated
from churnlab.llm.mixing import mix_sources
from churnlab.llm.near_dup import one_of_each
from churnlab.llm.quality import judge_quality
from churnlab.llm.sharding import uniform_shards

N_SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules and perplexity bands keep."""
    return judge_quality(docs).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest id."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as before, shared out to the sources' target weights; a
    document that is taken more than once is there more than once."""
    return mix_sources(docs).select(docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into shards whose sizes differ by one at most."""
    return uniform_shards(docs, N_SHARDS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]

#: SimHash, the language model and the shuffle have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
