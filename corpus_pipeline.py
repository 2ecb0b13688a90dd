"""A corpus pipeline: documents in, filtered, mixed and sharded documents out.

Every stage is written as Parquet to the shared scratch folder and read back
before the next one starts, so a lost executor costs one stage's tasks only.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventide.llm.common import table  # noqa: E402
from eventide.llm.decontaminate import drop_leaks  # noqa: E402
from eventide.llm.mixing import mix  # noqa: E402
from eventide.llm.quality import keep_quality  # noqa: E402
from eventide.llm.sharding import assign_shards  # noqa: E402
from eventide.llm.simhash import keep_one  # noqa: E402
from eventide.session import materialize  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list."""
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their targets."""
    return mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the shard they go to."""
    return assign_shards(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate),
          ("mixture", mixture), ("shards", shards)]

# Learned rules and xxHash fingerprints cannot be written in SQL; the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
