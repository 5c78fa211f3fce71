"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. Between stages the documents are written as Parquet
and read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corate.llm import decontaminate, mixing, quality_rules, simhash, token_store
from corate.llm.common import documents, saved
from corate.llm.queries import TOKENIZERS

#: SimHash components and XXH64 fingerprints are not expressible in DuckDB SQL.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    judged = quality_rules.judge(docs)
    back = dict(zip(judged.columns, docs.columns))  # carried columns come first
    return judged.where("kept").select(*[judged[a].alias(b) for a, b in back.items()])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, at most 4 bits)."""
    return simhash.deduplicate(docs, shingle=4, max_bits=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by passages of ``benchmark``."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it is taken."""
    return mixing.sample(docs, cap=3.0, weights=(1, 2, 3), seed=10)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the binary shards hold of each document, read back from them."""
    return token_store.store_digest(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality rules", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminated),
    ("source mixing", mixed),
    ("token shards", token_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, f"stage-{k}")
    return docs
