"""Numbers of rows in an order over all tasks: ranges of the order, and prefix counts of the ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import scratch

#: monotonically_increasing_id() holds the partition above this bit and the row's place in it below.
PLACE_BITS = 33


def with_row_number(df: DataFrame, order: list[Column], name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """df with name bigint, the row's place from 0 in this order over the whole table. Each task sorts a range of it; only the ranges'
    sizes, a row a task, meet in one place. The ranges are written once, as a second run could draw other borders. Rows that are equal in
    the order share a range, so an order with many ties needs a further column."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch(spark, "ranges")
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = spark.read.schema(df.withColumn("_place", F.lit(0).cast("bigint")).schema).parquet(path)
    part = F.shiftrightunsigned("_place", PLACE_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a task
    starts = sizes.select("_part", before.alias("_before"))
    inside = F.col("_place").bitwiseAND((1 << PLACE_BITS) - 1)
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + inside).drop("_part", "_place", "_before")


def with_number_in(df: DataFrame, group: str, order: list[Column], name: str = "row_number", partitions: int | None = None) -> DataFrame:
    """df with name bigint, the row's place from 1 among its group's rows in this order (null groups number by themselves). A group may
    span many tasks; its first place over all comes from one small row a group."""
    placed = with_row_number(df, [F.col(group).asc_nulls_first(), *order], "_all", partitions)
    first = placed.groupBy(F.col(group).alias("_group")).agg(F.min("_all").alias("_first"))
    joined = placed.join(first, F.col(group).eqNullSafe(F.col("_group")))
    return joined.withColumn(name, F.col("_all") - F.col("_first") + 1).drop("_all", "_first", "_group")
