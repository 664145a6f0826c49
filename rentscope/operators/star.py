"""Star schema build: three dimensions and the listing fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rentscope.functions import PRICE_BANDS, band_id, city_of, property_label
from rentscope.operators.bands import with_first_band
from rentscope.operators.keys import dense_ids, small_dense_ids

# Fixed value: state default of the location dimension.
DEFAULT_STATE = "TX"

BAND_SCHEMA = T.StructType([
    T.StructField("price_category_id", T.LongType(), False),
    T.StructField("category_name", T.StringType(), False),
    T.StructField("min_price", T.IntegerType(), False),
    T.StructField("max_price", T.IntegerType(), False),
])


@dataclass
class Star:
    dim_location: DataFrame
    dim_property_type: DataFrame
    dim_price_category: DataFrame
    fact_listings: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"dim_location": self.dim_location,
                "dim_property_type": self.dim_property_type,
                "dim_price_category": self.dim_price_category,
                "fact_listings": self.fact_listings}


def dim_location(clean: DataFrame) -> DataFrame:
    """Distinct (raw location, clean location) pairs, ids in first-seen
    order.  The pair count grows with the data (free-text addresses), so
    ids come from the distributed ``dense_ids``."""
    pairs = (clean.groupBy("location", "clean_location")
                  .agg(F.min("listing_seq").alias("_first")))
    return (dense_ids(pairs, "_first", "location_id")
            .select("location_id",
                    F.col("location").alias("raw_location"),
                    "clean_location",
                    city_of("clean_location").alias("city"),
                    F.lit(DEFAULT_STATE).alias("state")))


def dim_property_type(clean: DataFrame) -> DataFrame:
    """Distinct (bedrooms, bathrooms) pairs with a label.  Both are one
    digit or null, so there are at most 11 x 11 = 121 rows."""
    pairs = (clean.groupBy("bedrooms", "bathrooms")
                  .agg(F.min("listing_seq").alias("_first")))
    return (small_dense_ids(pairs, "_first", "property_type_id")
            .select("property_type_id", "bedrooms", "bathrooms",
                    property_label("bedrooms", "bathrooms").alias("property_label")))


def dim_price_category(spark: SparkSession) -> DataFrame:
    """The fixed price bands."""
    return spark.createDataFrame(PRICE_BANDS, BAND_SCHEMA)


def location_lookup(locations: DataFrame) -> DataFrame:
    """``raw_location -> location_id`` with the lowest id per raw text (the
    first match of a lookup over a dimension that may hold duplicates)."""
    return (locations.groupBy("raw_location")
                     .agg(F.min("location_id").alias("location_id")))


def fact_listings(clean: DataFrame, locations: DataFrame | None,
                  property_types: DataFrame, lookup: DataFrame | None = None,
                  bands: DataFrame | None = None) -> DataFrame:
    """One fact row per clean listing with its three foreign keys.

    * location: plain equality on the raw text (a null location matches
      nothing) against ``lookup`` (default: ``location_lookup(locations)``),
      so duplicated dimension rows never fan the fact out.  Left to the
      planner: AQE broadcasts the lookup after measuring it, or keeps a
      sort-merge join -- and when ``lookup`` is a *stored* table (read by
      a scan, as ``load_star`` does) a hot location is split across tasks
      by AQE's skew join.  (Over an aggregate the join input is already
      partitioned by the aggregate, and AQE cannot split it.)
    * property type: null-safe equality on (bedrooms, bathrooms); the
      dimension is bounded at 121 rows, so it is broadcast.
    * price category: closed range ``min <= price <= max`` over ``bands``
      (default: the fixed ones), first match -> ``with_first_band``.
    ``listing_id`` is the source sequence number (unique and stable).
    """
    loc_key = lookup if lookup is not None else location_lookup(locations)
    pt_key = (property_types.groupBy("bedrooms", "bathrooms")
                            .agg(F.min("property_type_id").alias("property_type_id"))
                            .withColumnRenamed("bedrooms", "_b")
                            .withColumnRenamed("bathrooms", "_ba"))
    f = clean.join(loc_key, clean["location"] == loc_key["raw_location"], "left")
    f = f.join(F.broadcast(pt_key),
               F.col("bedrooms").eqNullSafe(F.col("_b")) & F.col("bathrooms").eqNullSafe(F.col("_ba")),
               "left")
    f = (f.withColumn("price_category_id", band_id("price")) if bands is None
         else with_first_band(f, bands, "price", "price_category_id", "min_price", "max_price"))
    return f.select(
        F.col("listing_seq").alias("listing_id"),
        "title", "price", "price_raw", "location_id", "property_type_id",
        "price_category_id",
        "price_per_bedroom", "link", "source", "scraped_at",
        F.current_timestamp().alias("created_at"))


def build_star(clean: DataFrame) -> Star:
    """All four tables from the clean listings (``clean`` should be a
    materialised dataset: the star re-reads it four times)."""
    spark = clean.sparkSession
    loc = dim_location(clean)
    pt = dim_property_type(clean)
    return Star(loc, pt, dim_price_category(spark), fact_listings(clean, loc, pt))
