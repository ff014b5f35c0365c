"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
kept, and returns a DataFrame; ``run`` writes each result as Parquet in the shared folder and
rereads it.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockhand.llm import decontaminate, jaccard_join, mixing, packing, quality
from dockhand.llm.common import settle
from dockhand.session import read_table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_quality(docs, read_table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near copies."""
    return jaccard_join.keep_one_per_component(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to their source's target rate, globally shuffled."""
    return mixing.poisson_mix(docs, replica="__replica").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids."""
    return packing.pack_tokens(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_benchmark),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", pack),
]

# Vector products, signature joins and tokenisation are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs
