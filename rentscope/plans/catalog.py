"""The query catalogue: one Spark query per operator group.

Every query reads the driver tables under ``sf_dir`` (or data Spark derives
from them) and runs over whole tables.  Stages that several queries share
-- the derived raw listings, the clean listings and the star schema -- are
written once per session
to the shared checkpoint folder and read back, which cuts the lineage (the
star plans otherwise re-analyse the whole clean chain for every self-join)
and lets a lost executor re-read instead of recompute."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.functions import city_of, clean_location, price_tier
from rentscope.functions.formatting import snapshot_stamp
from rentscope.functions.text import bathrooms_from_title, bedrooms_from_title
from rentscope.operators import clean as C
from rentscope.operators import quality as Q
from rentscope.operators import transforms as T
from rentscope.operators import views as V
from rentscope.operators.dedup import keep_first
from rentscope.operators.star import Star
from rentscope.schemas import RAW_LISTINGS
from rentscope.session import scratch_path, session_id, spread
from rentscope.sources.files import (
    listing, publish_snapshots, publish_zones, read_csv, read_latest_named_snapshot, read_latest_snapshot, read_published,
    write_csv, write_named_snapshot, write_snapshot,
)
from rentscope.sources.fixture import raw_listings, render_listing_pages
from rentscope.sources.html import LINK_LIST_LAYOUT, LISTING_LAYOUT, extract_page_records
from rentscope.sources.warehouse import load_star, read_star

_MEMO: dict[tuple, object] = {}


def _key(spark: SparkSession, sf_dir: str, what: str) -> tuple:
    # the session object too: cached DataFrames belong to one session; and the
    # tables' listing, so that a table replaced under its path is seen
    return (session_id(spark), id(spark), sf_dir.rstrip("/"), listing(spark, sf_dir), what)


def _once(spark: SparkSession, sf_dir: str, what: str, build: Callable[[str], object],
          read: Callable[[str], object] | None = None):
    """Write a shared stage once per session, then hand out the same read
    DataFrame(s) (the file listing and schema are resolved once).  Without
    ``read``, whatever ``build`` returns (already read back) is kept."""
    k = _key(spark, sf_dir, what)
    if k not in _MEMO:
        path = scratch_path(spark, what)
        built = build(path)
        _MEMO[k] = read(path) if read is not None else built
    return _MEMO[k]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings derived from the driver tables, written once per session
    (like a stored raw snapshot: later scans are split across tasks and get
    filter pushdown on ``price``)."""
    return _once(spark, sf_dir, "raw",
                 lambda p: raw_listings(spark, sf_dir).write.parquet(p),
                 spark.read.parquet)


def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean listings, materialised once per session."""
    return _once(spark, sf_dir, "clean",
                 lambda p: C.clean_listings(_raw(spark, sf_dir)).write.parquet(p),
                 spark.read.parquet)


def enriched_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched listing output (clean + rank + segment), written once per
    session like the pipeline's enriched dataset."""
    return _once(spark, sf_dir, "enriched",
                 lambda p: T.enrich(clean_table(spark, sf_dir)).write.parquet(p),
                 spark.read.parquet)


def star_tables(spark: SparkSession, sf_dir: str) -> Star:
    """The star schema, materialised once per session (dimensions first,
    then the fact built from the written dimensions)."""
    return _once(spark, sf_dir, "star", lambda p: load_star(clean_table(spark, sf_dir), p))


def _pages(spark, d):
    return spread(spark.read.parquet(f"{d}/pages.parquet"), "page_id")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings written as CSV and read back with the explicit schema
    and pandas null tokens (equal to the input)."""
    path = scratch_path(spark, "csv")
    write_csv(_raw(spark, sf_dir), path)
    return read_csv(spark, path, RAW_LISTINGS, one_header=True)


def csv_two_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings as CSV files of two writers in one folder: other column
    order, an extra column, prices as floats and missing values in words."""
    path = scratch_path(spark, "csv2")
    raw = _raw(spark, sf_dir)
    write_csv(raw.filter("listing_seq % 2 = 0"), path)
    cell = F.when(F.col("location").isNull(), "NaN").otherwise(F.col("location"))
    other = raw.filter("listing_seq % 2 = 1").select(
        "source", "scraped_at", "link", cell.alias("location"), F.lit("x").alias("extra"), "title",
        F.when(F.col("price").isNull(), "None").otherwise(F.concat(F.col("price").cast("string"), F.lit(".0"))).alias("price"),
        "price_raw", "listing_seq")
    write_csv(other, path, "append")
    return read_csv(spark, path, RAW_LISTINGS)


def published_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly raw snapshots that arrive in two parts are published after each
    part; the zone then holds every one of them."""
    root, zone = scratch_path(spark, "snapshots"), scratch_path(spark, "raw-zone")
    year = F.date_trunc("year", F.col("scraped_at"))
    for part in (F.year("scraped_at") % 2 == 0, F.year("scraped_at") % 2 == 1):
        write_snapshot(_raw(spark, sf_dir).filter(part), root, stamp=snapshot_stamp(year))
        publish_snapshots(spark, root, zone, RAW_LISTINGS)
    return read_published(spark, zone, RAW_LISTINGS)


def appended_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star loaded and loaded again by appending: dimensions double, new
    facts get new ids and find the first match of each dimension."""
    root = scratch_path(spark, "star2")
    clean = clean_table(spark, sf_dir)
    load_star(clean, root)
    return load_star(clean, root, "append").fact_listings.drop("created_at")


def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL over the registered views of the stored star."""
    root = scratch_path(spark, "star-sql")
    load_star(clean_table(spark, sf_dir), root)
    read_star(spark, root)
    return spark.sql("""
        SELECT 'location' AS view, clean_location AS name, listing_count, avg_rent AS value FROM v_avg_rent_by_location
        UNION ALL SELECT 'type', property_label, listing_count, avg_rent FROM v_avg_rent_by_type
        UNION ALL SELECT 'band', category_name, listing_count, percentage FROM v_price_distribution""")


def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end-to-end pipeline with its gate on the newest of the yearly
    snapshots; its written enriched output."""
    from rentscope.plans.pipeline import run_pipeline
    root = scratch_path(spark, "run")
    write_snapshot(_raw(spark, sf_dir), f"{root}/in", stamp=snapshot_stamp(F.date_trunc("year", F.col("scraped_at"))))
    res = run_pipeline(spark, f"{root}/in", f"{root}/out", publish_root=f"{root}/zones")
    return spark.read.parquet(res.paths["enriched"])


def page_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to numbered listings (the wall clock left out)."""
    from rentscope.plans.pipeline import pages_to_listings
    return pages_to_listings(_pages(spark, sf_dir), LINK_LIST_LAYOUT).drop("scraped_at")


def scrape_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings from pages per source, and whether all carry one wall-clock
    stamp, taken within the last hour."""
    from rentscope.plans.pipeline import pages_to_listings
    now = F.localtimestamp()
    rows = pages_to_listings(_pages(spark, sf_dir), LINK_LIST_LAYOUT)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("listings"),
        (F.every(F.col("scraped_at").between(now - F.expr("INTERVAL 1 HOUR"), now))
         & (F.min("scraped_at") == F.max("scraped_at"))).alias("stamped_now"))


def band_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored bands with the listings and prices found in each."""
    star = star_tables(spark, sf_dir)
    seen = star.fact_listings.groupBy("price_category_id").agg(
        F.count(F.lit(1)).alias("listings"), F.min("price").alias("lowest"), F.max("price").alias("highest"))
    return star.dim_price_category.join(seen, "price_category_id")


def overlapping_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star loaded with other bands: a closed range of its own around the
    price of every clean listing, so thousands overlap; the facts of each band."""
    clean = clean_table(spark, sf_dir)
    reach = F.col("listing_seq") % 40
    bands = clean.select(F.col("listing_seq").alias("price_category_id"), F.col("title").alias("category_name"),
                         (F.col("price") - reach).cast("int").alias("min_price"),
                         (F.col("price") + reach).cast("int").alias("max_price"))
    star = load_star(clean, scratch_path(spark, "star-bands"), bands=bands)
    return star.fact_listings.select("listing_id", "price", "price_category_id")


def observed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's report from what was counted while the pipeline wrote, over
    one snapshot of all listings."""
    from rentscope.plans.pipeline import run_pipeline
    root = scratch_path(spark, "observed")
    write_snapshot(_raw(spark, sf_dir), f"{root}/in", stamp="20260101_000000")
    return run_pipeline(spark, f"{root}/in", f"{root}/out").quality


def distinct_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct raw locations per year and over all years: exact, and whether
    the estimate from stored sketches, merged, lies within four standard errors."""
    raw = _raw(spark, sf_dir).withColumn("year", F.year("scraped_at"))
    path = scratch_path(spark, "sketches")
    C.distinct_sketches(raw, "location", "year").write.parquet(path)
    sketches = spark.read.parquet(path)
    exact = raw.groupBy("year").agg(F.count_distinct("location").alias("exact")).unionByName(
        raw.agg(F.count_distinct("location").alias("exact")).withColumn("year", F.lit(None).cast("int")))
    estimates = C.distinct_estimates(sketches, "year").unionByName(
        C.distinct_estimates(sketches).withColumn("year", F.lit(None).cast("int")))
    error = 1.04 / 2 ** (C.SKETCH_BITS / 2)
    return (exact.join(estimates.withColumnRenamed("year", "_y"), F.col("year").eqNullSafe(F.col("_y")))
            .select("year", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= 4 * error * F.col("exact") + 1).alias("within")))


def records_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings as records that only hold the fields they have, and some a
    field of their own; one frame again, typed by the values."""
    from rentscope.sources.records import records_to_frame
    raw = _raw(spark, sf_dir)
    fields = F.array(*(F.struct(F.lit(c).alias("key"), F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias("value")
                                if c == "scraped_at" else F.col(c).cast("string").alias("value")) for c in raw.columns),
                     F.struct(F.lit("repost_of").alias("key"), F.when(F.col("link").endswith("/repost"), F.regexp_extract(
                         "link", "([0-9]+)/repost$", 1)).alias("value")))
    return records_to_frame(raw.select(F.map_from_entries(F.filter(fields, lambda f: f["value"].isNotNull())).alias("record")))


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings written as yearly snapshots (stamp of the year start),
    then only the newest snapshot read back."""
    root = scratch_path(spark, "snapshots")
    write_snapshot(_raw(spark, sf_dir), root,
                   stamp=snapshot_stamp(F.date_trunc("year", F.col("scraped_at"))))
    return read_latest_snapshot(spark, root, RAW_LISTINGS)


def snapshot_stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings land as yearly snapshots; a streaming job cleans every
    snapshot as its own input; the cleaned output is read back."""
    from rentscope.streaming.snapshots import start_snapshot_cleaner
    root = scratch_path(spark, "stream-in")
    out = scratch_path(spark, "stream-out")
    write_snapshot(_raw(spark, sf_dir), root,
                   stamp=snapshot_stamp(F.date_trunc("year", F.col("scraped_at"))))
    q = start_snapshot_cleaner(spark, root, out, scratch_path(spark, "stream-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out)


def latest_named_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings written twice as timestamp-named CSV snapshots; only
    the newest (by name) is read back -- the rows appear once, not twice."""
    folder = scratch_path(spark, "named")
    raw = _raw(spark, sf_dir)
    write_named_snapshot(raw, folder, stamp="20260101_000000")
    write_named_snapshot(raw, folder, stamp="20260102_000000")
    return read_latest_named_snapshot(spark, folder, RAW_LISTINGS, prefix="listings_2")


def zone_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish raw listings to the raw zone and the curated outputs to the
    clean zone, then read every published dataset back and count it."""
    root = scratch_path(spark, "zones")
    clean = clean_table(spark, sf_dir)
    paths = publish_zones({
        "raw": {"listings": _raw(spark, sf_dir)},
        "clean": {"listings_clean": clean,
                  "listings_enriched": enriched_table(spark, sf_dir),
                  "location_stats": T.location_stats(clean)}}, root)
    out = None
    for (zone, name), path in sorted(paths.items()):
        back = spark.read.parquet(path)
        one = back.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(zone).alias("zone"), F.lit(name).alias("dataset"), "rows",
            F.lit(len(back.columns)).alias("columns"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_listings": _raw,
    "parse_price": lambda s, d: _raw(s, d).select("listing_seq", "price_raw", "price"),
    "dedup_first": lambda s, d: keep_first(_raw(s, d), C.DEDUP_KEYS),
    "extract_rooms": lambda s, d: _raw(s, d).select(
        "listing_seq", "title",
        bedrooms_from_title("title").alias("bedrooms"),
        bathrooms_from_title("title").alias("bathrooms")),
    "standardize_location": lambda s, d: _raw(s, d).select(
        "listing_seq", "location", clean_location("location").alias("clean_location"))
        .withColumn("city", city_of("clean_location")),
    "price_category": lambda s, d: _raw(s, d).select(
        "listing_seq", "price",
        price_tier("price", "Unknown").alias("price_category"),
        price_tier("price", None).alias("price_segment")),
    "clean_listings": lambda s, d: clean_table(s, d),
    "clean_report": lambda s, d: C.clean_report(_raw(s, d)),
    "category_counts": lambda s, d: C.category_counts(_raw(s, d)),
    "scrape_summary": lambda s, d: C.scrape_summary(_raw(s, d)),
    "rank_by_location": lambda s, d: T.rank_by_location(clean_table(s, d)).select(
        "listing_seq", "clean_location", "price", "price_rank_in_location", "listings_in_location"),
    "location_stats": lambda s, d: T.location_stats(clean_table(s, d)),
    "segment_summary": lambda s, d: T.segment_summary(clean_table(s, d)),
    "avg_by_bedrooms": lambda s, d: T.avg_by_bedrooms(clean_table(s, d)),
    "best_deals": lambda s, d: T.best_deals(clean_table(s, d)),
    "deals_context": lambda s, d: T.with_bedroom_average(clean_table(s, d)).select(
        "listing_seq", "bedrooms", "price", "avg_price_for_beds", "price_vs_avg"),
    "enriched_listings": enriched_table,
    "category_mean": lambda s, d: T.category_mean(clean_table(s, d)),
    "dim_location": lambda s, d: star_tables(s, d).dim_location,
    "dim_property_type": lambda s, d: star_tables(s, d).dim_property_type,
    "dim_price_category": band_table,
    "fact_listings": lambda s, d: star_tables(s, d).fact_listings.drop("created_at"),
    "rent_by_location": lambda s, d: V.rent_by_location(star_tables(s, d)),
    "rent_by_type": lambda s, d: V.rent_by_type(star_tables(s, d)),
    "price_distribution": lambda s, d: V.price_distribution(star_tables(s, d)),
    "cheapest_two_bed": lambda s, d: V.cheapest_by_bedrooms(star_tables(s, d), 2, 5),
    "top_locations": lambda s, d: V.top_locations(star_tables(s, d), 10),
    "extract_page_records": lambda s, d: extract_page_records(_pages(s, d), LISTING_LAYOUT),
    "extract_link_records": lambda s, d: extract_page_records(_pages(s, d), LINK_LIST_LAYOUT),
    "listing_pages_roundtrip": lambda s, d: extract_page_records(
        render_listing_pages(_raw(s, d)), LISTING_LAYOUT),
    "pages_to_listings": page_listings,
    "scrape_stamps": scrape_stamps,
    "csv_roundtrip": csv_roundtrip,
    "csv_two_headers": csv_two_headers,
    "published_snapshots": published_snapshots,
    "appended_facts": appended_facts,
    "sql_views": sql_views,
    "overlapping_bands": overlapping_bands,
    "observed_quality": observed_quality,
    "distinct_locations": distinct_locations,
    "records_frame": records_frame,
    "whole_run": whole_run,
    "latest_snapshot": latest_snapshot,
    "zone_publish": zone_publish,
    "latest_named_csv": latest_named_csv,
    "snapshot_stream_clean": snapshot_stream_clean,
    "quality_report": lambda s, d: Q.quality_report(
        clean_table(s, d), star_tables(s, d).fact_listings, enriched_table(s, d)),
}
