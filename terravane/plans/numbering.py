"""Consecutive numbers without gathering all rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from terravane.plans.lineage import cut


def numbered(df: DataFrame, order: list[str], output: str, rows: int = 200_000) -> DataFrame:
    """df with output: 0, 1, 2, ... in the given order, which must be total for the result to be repeatable.

    Rows are dealt to ranges of the order, whatever its columns' types; a range's
    first number is the count of rows in the ranges before it. The ranges are
    written, so that both jobs see the same ones; the driver sees a row a range.
    """
    n = df.count()
    if n <= rows:
        return df.withColumn(output, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))  # fits a task
    ranged = cut(df.repartitionByRange(-(-n // rows), *order).withColumn("__range", F.spark_partition_id()))
    counts = ranged.groupBy("__range").count()
    before = counts.select("__range", F.coalesce(F.sum("count").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    w = Window.partitionBy("__range").orderBy(*order)
    return ranged.withColumn("__at", F.row_number().over(w) - 1).join(F.broadcast(before), "__range").withColumn(output, F.col("__before") + F.col("__at")).drop("__range", "__at", "__before")
