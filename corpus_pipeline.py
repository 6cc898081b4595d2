"""A corpus pipeline: toxic documents, foreign ones and near copies go, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again as
the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyweave.llm import jaccard, langid, packing, toxicity
from tallyweave.llm.shared import stored
from tallyweave.session import tune


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labelled ones."""
    tune(spark)
    return toxicity.keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_foreign(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or unlike every learned language go."""
    tune(spark)
    return langid.keep_known(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    tune(spark)
    return jaccard.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of the documents that are left."""
    tune(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language ID", drop_foreign),
    ("n-gram Jaccard join", drop_near_copies),
    ("best-fit packing", pack),
]

#: SQL can express none of the stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
    return docs
