"""The registered queries of this subpackage, and their SQL where DuckDB can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terravane.llm import exact, licences, media, mixing, neardup, packing, quality, scoring, sharding, warc
from terravane.llm.tables import documents


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.read_media(media.store_texts(documents(spark, sf_dir)))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shard(documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_groups(documents(spark, sf_dir))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score(documents(spark, sf_dir))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = mixing.counted(docs, mixing.plan_mix(docs))
    mix = F.col("mix")
    return rows.select("row.doc_id", mix["size"].alias("size"), mix["source_size"].alias("source_size"), mix["target"].alias("target"), (mix["size"] * mix["copies"]).cast("long").alias("taken"), mix["shards"].alias("shards"))


QUERIES = {f.__name__: f for f in (op1_media, op2_exact_dedup, op3_license_scan, op4_sharding, op5_simhash, op6_warc, op7_packing, op8_quality, op9_lm_scoring, op10_mixing)}
ORACLE_SQL = {"op2_exact_dedup": exact.ORACLE, "op3_license_scan": licences.ORACLE, "op6_warc": warc.ORACLE}
