"""Map-like inputs derived by formula from the plain tables, so that SQL can derive the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line an order, a vertex a line item."""
    w = Window.partitionBy("findex").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")  # dealt by findex, as what follows asks
    return table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "findex").select("findex", F.row_number().over(w).alias("seq"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (F.col("l_discount") * 100).alias("z"))


SHORT = "lines as (select l_orderkey as findex, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as seq, l_quantity as x, l_extendedprice / 1000 as y, l_discount * 100 as z from lineitem)"


def long_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line a user, a vertex an event."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("findex"), F.row_number().over(w).alias("seq"), F.col("value").alias("x"), (F.col("event_id") % 100).cast("double").alias("y"), (F.col("event_id") % 7).cast("double").alias("z"))


LONG = "lines as (select user_id as findex, row_number() over (partition by user_id order by ts, event_id) as seq, value as x, cast(event_id % 100 as double) as y, cast(event_id % 7 as double) as z from events)"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point a customer, in longitude and latitude."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("findex"), (129 + (k * 37 % 1500) / 100).alias("lon"), (31 + (k * 91 % 1300) / 100).alias("lat"), F.col("c_acctbal").alias("h"))


PLACES = "places as (select c_custkey as findex, 129 + (c_custkey * 37 % 1500) / 100.0::double as lon, 31 + (c_custkey * 91 % 1300) / 100.0::double as lat, c_acctbal as h from customer)"


def plane_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point a supplier, in metres, off all grid lines."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("findex"), (k * 7919 % 4000 + 0.5).cast("double").alias("x"), (k * 104729 % 3000 + 0.5).cast("double").alias("y"), F.lit(0.0).alias("z"))


PLANE = "points as (select s_suppkey as findex, cast(s_suppkey * 7919 % 4000 + 0.5 as double) as x, cast(s_suppkey * 104729 % 3000 + 0.5 as double) as y, 0.0::double as z from supplier)"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box a nation: findex, gtype, coords, and its bounds."""
    x0, y0 = (F.col("n_nationkey") % 5 * 800).cast("double"), (F.floor(F.col("n_nationkey") / 5) * 600).cast("double")
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"), F.lit(0.0).alias("z"))
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("findex"), F.lit("Polygon").alias("gtype"), F.array(p(x0, y0), p(x0 + 800, y0), p(x0 + 800, y0 + 600), p(x0, y0 + 600), p(x0, y0)).alias("coords"), x0.alias("x_min"), y0.alias("y_min"), (x0 + 800).alias("x_max"), (y0 + 600).alias("y_max"))


BOXES = "boxes as (select n_nationkey as findex, cast(n_nationkey % 5 * 800 as double) as x0, cast(n_nationkey // 5 * 600 as double) as y0 from nation)"


def fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("findex"), F.col("p_retailprice").alias("a"), F.col("p_size").alias("b"), F.col("p_type").alias("s"), F.col("p_brand").alias("t"))


FIELDS = "f as (select p_partkey as findex, p_retailprice as a, p_size as b, p_type as s, p_brand as t from part)"


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id") % 10
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("findex"), F.when(n == 0, None).when(n == 1, "").when(n == 2, "NaN").when(n == 3, " ").otherwise(F.col("value").cast("decimal(18,2)").cast("string")).alias("v"), F.col("value").alias("num"), F.col("event_type"), F.col("user_id"))


DIRTY = "d as (select event_id as findex, case event_id % 10 when 0 then null when 1 then '' when 2 then 'NaN' when 3 then ' ' else cast(cast(value as decimal(18,2)) as varchar) end as v, value as num, event_type, user_id from events)"
