"""Range join with a stored table of bands: the first band that holds a value.

Bands are closed ranges of whole numbers that may overlap; the lowest id that
holds a value counts.  A handful of bands becomes a CASE chain.  More of them
are joined by equality: a range is cut into at most two aligned blocks of every
size 2^level (as a segment tree does), and a value lies in exactly one block of
a level, ``value >> level``.  So distinct values meet their bands with one
equality join per row and level, however long the ranges and however many of
them overlap, and no nested loop is needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rentscope.functions import band_id
from rentscope.session import scratch_path

CHAIN = 32      # so many bands are evaluated per row, without a join
LEVELS = 63


def aligned_blocks(low: Column, high: Column) -> Column:
    """``array<struct<level, block>>``: the aligned blocks whose union is
    ``low .. high`` (whole numbers; empty where one is null or the range is)."""
    none = F.array().cast("array<struct<level:int,block:bigint>>")

    def step(acc: Column, level: Column) -> Column:
        lo, hi, out = acc["lo"], acc["hi"], acc["out"]
        odd = (lo <= hi) & (F.pmod(lo, F.lit(2)) == 1)
        lo2 = F.when(odd & (lo < hi), lo + 1).otherwise(lo)
        even = (lo2 <= hi) & (F.pmod(hi, F.lit(2)) == 0)
        hi2 = F.when(even & (lo2 < hi), hi - 1).otherwise(hi)

        def block(of: Column) -> Column:
            return F.array(F.struct(level.alias("level"), of.alias("block")))
        more = F.concat(F.when(odd, block(lo)).otherwise(none), F.when(even, block(hi)).otherwise(none))
        # a range that is used up stays so: 0 .. -1 has no blocks
        over = (lo > hi) | (odd & (lo == hi)) | (even & (lo2 == hi))
        return F.struct(F.when(over, F.lit(0).cast("long")).otherwise(F.shiftright(lo2, 1)).alias("lo"),
                        F.when(over, F.lit(-1).cast("long")).otherwise(F.shiftright(hi2, 1)).alias("hi"),
                        F.concat(out, more).alias("out"))
    start = F.struct(F.coalesce(low.cast("long"), F.lit(0).cast("long")).alias("lo"),
                     F.when(low.isNotNull() & high.isNotNull(), high.cast("long")).otherwise(F.lit(-1).cast("long")).alias("hi"),
                     none.alias("out"))
    usable = low.isNotNull() & high.isNotNull() & (low <= high)
    return F.when(usable, F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda acc: acc["out"])).otherwise(none)


def first_bands(values: DataFrame, bands: DataFrame, id_col: str, low: str, high: str) -> DataFrame:
    """(value, id) of the distinct ``values`` (one column ``value``) that a band holds."""
    blocks = (bands.select(F.col(id_col).alias("id"), F.explode(aligned_blocks(F.col(low), F.col(high))).alias("b"))
              .groupBy("b.level", "b.block").agg(F.min("id").alias("id")))
    path = scratch_path(bands.sparkSession, "band-blocks")
    blocks.write.parquet(path)
    blocks = bands.sparkSession.read.parquet(path)
    levels = [r["level"] for r in blocks.select("level").distinct().collect()]  # at most LEVELS + 1
    if not levels:
        return values.limit(0).withColumn("id", F.lit(None).cast("long"))
    at = F.explode(F.array(*(F.struct(F.lit(n).alias("level"), F.shiftright("value", n).alias("block")) for n in sorted(levels))))
    return (values.filter("value IS NOT NULL").select("value", at.alias("b")).select("value", "b.level", "b.block")
            .join(blocks, ["level", "block"]).groupBy("value").agg(F.min("id").cast("long").alias("id")))


def with_first_band(df: DataFrame, bands: DataFrame, value: str, id_col: str, low: str, high: str) -> DataFrame:
    """All columns, and the lowest id of the bands that hold ``value`` (null
    where none does).  Up to CHAIN bands become a CASE chain; beyond, the
    distinct values are looked up and the written lookup is joined, so a hot
    value is split by AQE."""
    few = bands.select(id_col, F.lit("").alias("name"), low, high).limit(CHAIN + 1).collect()
    if len(few) <= CHAIN:
        rows = [tuple(r) for r in few if r[low] is not None and r[high] is not None]
        return df.withColumn(id_col, band_id(value, rows) if rows else F.lit(None).cast("long"))
    path = scratch_path(df.sparkSession, "band-lookup")
    first_bands(df.select(F.col(value).cast("long").alias("value")).distinct(), bands, id_col, low, high).write.parquet(path)
    lookup = df.sparkSession.read.parquet(path).select(F.col("value").alias("_band_value"), F.col("id").alias("_band"))
    return (df.join(lookup, F.col(value) == F.col("_band_value"), "left").withColumn(id_col, F.col("_band"))
            .drop("_band", "_band_value"))
