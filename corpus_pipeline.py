"""A corpus pipeline: documents in, packed sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. The quality classifier drops
documents that it rejects; exact dedup keeps one document of equal ones, SimHash
near-dedup one of each linked group; mixing takes documents, some of them more
than once, so that sources meet their target weights; the last stage packs them
into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terravane.llm import exact, mixing, neardup, packing, quality
from terravane.llm.tables import cut


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def apart(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("quality classifier", good), ("exact dedup", different), ("simhash near-dedup", apart), ("source mixing", mixed), ("best-fit packing", packed)]
#: SQL can't express the classifier, SimHash or packing; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is not packed:
            docs = cut(docs, name.replace(" ", "-"))
    return docs
