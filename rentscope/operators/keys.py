"""Surrogate keys in first-seen order without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentscope.session import scratch_path


def dense_ids(df: DataFrame, order_col: str, id_col: str) -> DataFrame:
    """Number rows 1..n in ascending ``order_col`` (which must be unique).

    A global ``row_number()`` would pull every row into one task.  Instead
    the rows are range-partitioned and sorted, each row gets its in-partition
    position from ``monotonically_increasing_id`` (contiguous per partition),
    the tagged rows are written to the shared checkpoint folder (so a lost
    executor cannot reshuffle them differently), and per-partition row counts
    -- one row per partition, a bounded table -- give each partition's
    offset."""
    spark = df.sparkSession
    tagged = (df.repartitionByRange(F.col(order_col))
                .sortWithinPartitions(order_col)
                .withColumn("_part", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    path = scratch_path(spark, "ids")
    tagged.write.parquet(path)
    staged = spark.read.parquet(path)
    offsets = (staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .withColumn("_offset", F.coalesce(F.sum("_n").over(
                   Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .select("_part", "_offset"))
    local = F.col("_mid") - F.shiftleft(F.col("_part").cast("bigint"), 33)
    return (staged.join(F.broadcast(offsets), "_part")
                  .withColumn(id_col, F.col("_offset") + local + 1)
                  .drop("_part", "_mid", "_offset"))


def small_dense_ids(df: DataFrame, order_col: str, id_col: str) -> DataFrame:
    """``row_number()`` in one task -- only for tables with a proven small
    bound (e.g. at most 121 bedroom/bathroom pairs)."""
    return df.withColumn(id_col, F.row_number().over(Window.orderBy(order_col)).cast("bigint"))
