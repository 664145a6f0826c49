"""The star schema as a warehouse of Parquet datasets plus SQL views."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.operators import views as V
from rentscope.sources.commits import commit, read_state
from rentscope.sources.files import delete, exists, write_concurrently
from rentscope.operators.star import (
    Star, dim_location, dim_price_category, dim_property_type, fact_listings, location_lookup,
)

TABLES = ("dim_location", "dim_property_type", "dim_price_category", "fact_listings")
ID_COLS = {"dim_location": "location_id", "dim_property_type": "property_type_id",
           "dim_price_category": "price_category_id", "fact_listings": "listing_id"}


def _folders(spark: SparkSession, root: str) -> tuple[int, dict[str, list[str]]]:
    """The newest committed version and the folders of each of its tables."""
    version, state = read_state(spark, root)
    return version, {n: [f"{root.rstrip('/')}/{f}" for f in fs] for n, fs in state.get("tables", {}).items()}


def read_star(spark: SparkSession, root: str, register: bool = True) -> Star:
    """Read the four tables as the newest commit has them; optionally register
    them and the reporting views as temp views (``v_avg_rent_by_location`` ...),
    so SQL users query them by name."""
    folders = _folders(spark, root)[1]
    if not folders:
        raise FileNotFoundError(f"no committed star under {root}")
    star = Star(**{n: spark.read.parquet(*folders[n]) for n in TABLES})
    if register:
        for name, df in star.tables().items():
            df.createOrReplaceTempView(name)
        V.rent_by_location(star).createOrReplaceTempView("v_avg_rent_by_location")
        V.rent_by_type(star).createOrReplaceTempView("v_avg_rent_by_type")
        V.price_distribution(star).createOrReplaceTempView("v_price_distribution")
    return star


def load_star(clean, root: str, mode: str = "overwrite", bands: DataFrame | None = None,
              watch: Callable[[DataFrame], DataFrame] | None = None) -> Star:
    """Build the star from ``clean`` and write it under ``root``.

    Dimensions are written first and the fact is built from the *written*
    dimensions (short lineage; a lost executor re-reads them).  All four
    tables are written to new folders, and one commit switches to them: until
    then, and after a failure, readers see the old star whole.

    ``overwrite`` (default) is idempotent.  ``append`` reproduces a rerun
    of an insert-only loader: dimension rows are added again with ids
    continuing after the existing maximum, and the fact lookups resolve to
    the lowest id per key across old and new rows, so facts never fan out;
    the new facts get ids above all old ones.  The old folders are part of
    the new version, so nothing is copied.  ``bands``: price bands other than
    the fixed ones (ids, names, closed ranges that may overlap).  ``watch``
    is applied to the fact that is written (to observe it)."""
    spark = clean.sparkSession
    root = root.rstrip("/")
    version, old = _folders(spark, root)
    old = old if mode == "append" else {}
    dims = {"dim_location": dim_location(clean),
            "dim_property_type": dim_property_type(clean),
            "dim_price_category": dim_price_category(spark) if bands is None else bands}
    first_id = 0
    if old:
        for name, df in dims.items():
            idc = ID_COLS[name]
            top = spark.read.parquet(*old[name]).agg(F.coalesce(F.max(idc), F.lit(0)).alias("m")).first()["m"]
            dims[name] = df.withColumn(idc, F.col(idc) + F.lit(top))
        first_id = spark.read.parquet(*old["fact_listings"]).agg(
            F.coalesce(F.max("listing_id") + 1, F.lit(0)).alias("m")).first()["m"]
    run = f"run-{uuid.uuid4().hex[:12]}"
    own = {name: f"{name}/{run}" for name in TABLES}
    write_concurrently({f"{root}/{own[name]}": df for name, df in dims.items()}, "errorifexists")
    folders = {name: [*old.get(name, []), f"{root}/{own[name]}"] for name in TABLES}
    fact = fact_from_stored_dimensions(clean, root, folders, f"{LOOKUP_DIR}/{run}")
    if first_id:
        fact = fact.withColumn("listing_id", F.col("listing_id") + F.lit(first_id))
    (watch(fact) if watch else fact).write.mode("errorifexists").parquet(f"{root}/{own['fact_listings']}")
    commit(spark, root, version, {"tables": {n: [f.removeprefix(f"{root}/") for f in fs] for n, fs in folders.items()}})
    delete(spark, f"{root}/{LOOKUP_DIR}/{run}")
    return read_star(spark, root, register=False)


LOOKUP_DIR = "_location_lookup"


def fact_from_stored_dimensions(clean, root: str, folders: dict[str, list[str]] | None = None,
                                lookup: str = LOOKUP_DIR):
    """The fact over written dimensions (by default those right under
    ``root``).  The first-match location lookup (one row per raw text) is
    written first, so the big join reads it by a scan and AQE can split a hot
    location.  Price bands are those that are stored."""
    spark = clean.sparkSession
    root = root.rstrip("/")
    folders = folders or {name: [f"{root}/{name}"] for name in TABLES if exists(spark, f"{root}/{name}")}
    dims = {name: spark.read.parquet(*folders[name]) for name in TABLES[:-1] if name in folders}
    location_lookup(dims["dim_location"]).write.mode("overwrite").parquet(f"{root}/{lookup}")
    return fact_listings(clean, None, dims["dim_property_type"], lookup=spark.read.parquet(f"{root}/{lookup}"),
                         bands=dims.get("dim_price_category"))
