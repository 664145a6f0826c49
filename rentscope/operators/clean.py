"""The clean stage: dedup, room counts, locations, tiers, outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.functions import (
    bathrooms_from_title, bedrooms_from_title, clean_location,
    price_per_bedroom, price_tier,
)
from rentscope.operators.dedup import keep_first

DEDUP_KEYS = ["title", "price", "location"]
# Plausible monthly rent, closed range.
MIN_PRICE, MAX_PRICE = 200, 10000


def add_clean_columns(df: DataFrame) -> DataFrame:
    """Per-row derived columns (no shuffle)."""
    return df.withColumns({
        "bedrooms": bedrooms_from_title("title"),
        "bathrooms": bathrooms_from_title("title"),
        "clean_location": clean_location("location"),
        "price_category": price_tier("price", null_label="Unknown"),
    })


def clean_listings(raw: DataFrame, min_price: int = MIN_PRICE,
                   max_price: int = MAX_PRICE, scope: tuple[str, ...] = ()) -> DataFrame:
    """Raw listings -> clean listings.

    Order of steps as in the reference: dedup on (title, price, location),
    extract rooms, clean location, price category, drop prices outside
    ``[min_price, max_price]`` (null fails), then price per bedroom.  The
    range filter is on a dedup key, so Catalyst may evaluate it before the
    dedup shuffle with the same result.  ``scope`` columns (e.g. a snapshot
    stamp) are added to the dedup key, so each scope is cleaned on its own."""
    deduped = keep_first(raw, [*scope, *DEDUP_KEYS])
    kept = add_clean_columns(deduped).filter(F.col("price").between(min_price, max_price))
    return kept.withColumn("price_per_bedroom", price_per_bedroom("price", "bedrooms"))


def clean_report(raw: DataFrame, min_price: int = MIN_PRICE,
                 max_price: int = MAX_PRICE) -> DataFrame:
    """Counts the clean stage prints, as ``(metric, value)`` rows.

    raw rows, duplicates removed, outliers removed, clean rows, bedrooms /
    bathrooms found and distinct raw and clean locations (these are taken
    after the dedup, before the outlier filter), price min / max / mean of
    the clean rows.

    Every clean column is a function of the dedup key (title, price,
    location), so all of it comes from one key-level aggregate: one scan,
    one map-side partial ``count`` per key (a hot key costs one row per
    task), then a single-row aggregate over the distinct keys."""
    keys = raw.groupBy(*DEDUP_KEYS).agg(F.count(F.lit(1)).alias("_copies"))
    k = add_clean_columns(keys)
    in_range = F.col("price").between(min_price, max_price)
    kept = F.coalesce(in_range, F.lit(False))
    one = k.agg(
        F.sum("_copies").alias("raw_rows"),
        F.count_distinct("location").alias("raw_locations"),
        F.count(F.lit(1)).alias("deduped_rows"),
        (F.sum("_copies") - F.count(F.lit(1))).alias("duplicates_removed"),
        F.count_if(~kept).alias("outliers_removed"),
        F.count_if(kept).alias("clean_rows"),
        F.count("bedrooms").alias("bedrooms_found"),
        F.count("bathrooms").alias("bathrooms_found"),
        F.count_distinct("clean_location").alias("clean_locations"),
        F.min(F.when(kept, F.col("price"))).alias("price_min"),
        F.max(F.when(kept, F.col("price"))).alias("price_max"),
        F.round(F.avg(F.when(kept, F.col("price"))), 2).alias("price_mean"),
    )
    return _long(one)


def category_counts(raw: DataFrame) -> DataFrame:
    """Listings per price category after the dedup, before the outlier
    filter (so ``Unknown`` and the outliers count).  Category is a function
    of the dedup key: distinct keys, then one row per category."""
    keys = add_clean_columns(raw.select(*DEDUP_KEYS).distinct())
    return keys.groupBy("price_category").agg(F.count(F.lit(1)).alias("listings"))


def _long(one_row: DataFrame) -> DataFrame:
    """A one-row aggregate -> ``(metric, value double)`` rows."""
    return (one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in one_row.columns])).alias("m")).select("m.*"))


def scrape_summary(raw: DataFrame) -> DataFrame:
    """What the scrape stage reports on a fresh batch, as ``(metric,
    value)`` text rows: listing count, price range and mean as money
    (``$1,500``), distinct raw locations (null not counted).  One pass."""
    from rentscope.functions import money
    one = raw.agg(
        F.count(F.lit(1)).cast("string").alias("total_listings"),
        money(F.min("price")).alias("price_min"),
        money(F.max("price")).alias("price_max"),
        money(F.avg("price")).alias("price_mean"),
        F.count_distinct("location").cast("string").alias("unique_locations"))
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in one.columns])).alias("m")
    ).select("m.*")


# 2^12 registers: a standard error of 1.04 / 64 = 1.6 %
SKETCH_BITS = 12


def distinct_sketches(df: DataFrame, column: str, *by: str) -> DataFrame:
    """A mergeable HyperLogLog sketch of the distinct values of ``column`` (null
    not counted) per group, to be stored: a few KB, however many values."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.coalesce(F.col(column), F.lit("")), F.lit(SKETCH_BITS)).alias("sketch"),
                               (F.count(F.lit(1)) > F.count(column)).alias("has_null"))


def distinct_estimates(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct counts of the sketches merged per group; no value is
    read again, so new snapshots cost their own sketch only."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch", F.lit(False)).alias("sketch"), F.bool_or("has_null").alias("null"))
    number = F.hll_sketch_estimate("sketch") - F.col("null").cast("int")
    return merged.select(*by, F.greatest(number, F.lit(0)).cast("long").alias("estimate"))
