"""Reporting views over the star schema.

Each view aggregates the fact *before* joining a dimension: the fact is
collapsed by its foreign key with a map-side partial aggregate, so the join
sees one row per key instead of one row per listing, and a hot key costs
nothing extra.  Averages are re-assembled exactly from sums and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rentscope.operators.star import Star


def _per_key(fact: DataFrame, key: str) -> DataFrame:
    return fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count("price").alias("_np"),
        F.sum("price").alias("_s"),
        F.min("price").alias("_mn"),
        F.max("price").alias("_mx"))


def _avg(s="_s", n="_np"):
    """avg(price) from partial sums: null (not a division error under ANSI
    mode) for a group whose prices are all null."""
    return F.sum(s) / F.nullif(F.sum(n), F.lit(0))


def rent_by_location(star: Star, min_listings: int = 3) -> DataFrame:
    """Per clean location with at least ``min_listings`` listings: count,
    avg / min / max rent; dearest first."""
    per_loc = _per_key(star.fact_listings, "location_id")
    j = per_loc.join(star.dim_location.select("location_id", "clean_location"), "location_id")
    return (j.groupBy("clean_location").agg(
                F.sum("_n").alias("listing_count"),
                F.round(_avg(), 0).alias("avg_rent"),
                F.min("_mn").alias("min_rent"),
                F.max("_mx").alias("max_rent"))
            .filter(F.col("listing_count") >= min_listings)
            .orderBy(F.desc("avg_rent"), "clean_location"))


def rent_by_type(star: Star) -> DataFrame:
    """Per property label and bedroom count: count and avg rent."""
    per_pt = _per_key(star.fact_listings, "property_type_id")
    dim = F.broadcast(star.dim_property_type.select("property_type_id", "property_label", "bedrooms"))
    return (per_pt.join(dim, "property_type_id")
            .groupBy("property_label", "bedrooms").agg(
                F.sum("_n").alias("listing_count"),
                F.round(_avg(), 0).alias("avg_rent"))
            .orderBy(F.asc_nulls_first("bedrooms"), "property_label"))


def price_distribution(star: Star) -> DataFrame:
    """Per price band: count and its share of *all* fact rows (1 decimal)."""
    per_cat = star.fact_listings.groupBy("price_category_id").agg(F.count(F.lit(1)).alias("_n"))
    # At most one row per band plus a null row: the total is a window over
    # that handful of rows, not another pass over the fact.
    per_cat = per_cat.withColumn("_total", F.sum("_n").over(Window.partitionBy(F.lit(0))))
    j = per_cat.join(F.broadcast(star.dim_price_category), "price_category_id")
    return (j.groupBy("category_name", "min_price", "max_price").agg(
                F.sum("_n").alias("listing_count"), F.max("_total").alias("_total"))
            .select("category_name", "min_price", "max_price", "listing_count",
                    F.round(F.col("listing_count").cast("double") * 100.0 / F.col("_total"), 1)
                    .alias("percentage"))
            .orderBy("min_price", "category_name"))


def cheapest_by_bedrooms(star: Star, bedrooms: int = 2, k: int = 5) -> DataFrame:
    """The ``k`` cheapest listings with ``bedrooms`` bedrooms (ties by
    listing id), with their clean location.

    The top-k runs on the fact first (a distributed partial top-k per task,
    then a k-row merge); only those k rows meet the location dimension.
    Fact location ids always come from that dimension (build_star), so
    dropping rows without a location id before the top-k is exact."""
    types = F.broadcast(star.dim_property_type.filter(F.col("bedrooms") == bedrooms)
                        .select("property_type_id"))  # at most 11 rows
    top = (star.fact_listings.filter(F.col("location_id").isNotNull())
           .join(types, "property_type_id", "left_semi")
           .select("listing_id", "title", "price", "location_id")
           .orderBy(F.asc_nulls_first("price"), "listing_id").limit(k))
    return (top.join(star.dim_location.select("location_id", "clean_location"), "location_id")
               .select("title", "price", "clean_location", "listing_id")
               .orderBy(F.asc_nulls_first("price"), "listing_id"))


def top_locations(star: Star, n: int = 10) -> DataFrame:
    """The first ``n`` rows of ``rent_by_location`` (ties by name)."""
    return rent_by_location(star).limit(n)
