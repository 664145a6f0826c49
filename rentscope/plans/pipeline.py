"""The end-to-end batch pipeline.

newest snapshot -> clean (written) -> {enriched + location stats, star
warehouse + views} -> quality gate -> optional zone publish.  Stages hand
over written Parquet datasets, so every stage starts from a short lineage
and a lost executor re-reads instead of recomputing upstream stages."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.functions.formatting import wall_clock_now
from rentscope.operators import quality as Q
from rentscope.operators import transforms as T
from rentscope.operators import views as V
from rentscope.operators.clean import clean_listings
from rentscope.operators.keys import dense_ids
from rentscope.schemas import RAW_LISTINGS, REQUIRED_CLEAN_COLUMNS
from rentscope.sources.files import (
    SNAPSHOT_COL, publish_named_snapshots, publish_snapshots, publish_zones, read_latest_named_snapshot, read_latest_snapshot, write_dataset,
    write_snapshot,
)
from rentscope.sources.html import LISTING_LAYOUT, PageLayout, extract_page_records
from rentscope.sources.warehouse import load_star

@dataclass
class PipelineResult:
    paths: dict[str, str]
    reports: dict[str, DataFrame] = field(default_factory=dict)
    quality: DataFrame | None = None


def pages_to_listings(pages: DataFrame, layout: PageLayout = LISTING_LAYOUT,
                      source: str = "web") -> DataFrame:
    """Fetched pages -> raw listings (``RAW_LISTINGS``): records in page
    order, numbered 1..n, stamped with the wall clock and a source label."""
    rec = extract_page_records(pages, layout).withColumn("_order", F.struct("page_id", "pos"))
    return dense_ids(rec, "_order", "listing_seq").select(
        "listing_seq", "title", "price", "price_raw", "location", "link",
        wall_clock_now().alias("scraped_at"), F.lit(source).alias("source"))


def ingest_pages(pages: DataFrame, snapshot_root: str, layout: PageLayout = LISTING_LAYOUT,
                 stamp: str | None = None, source: str = "web") -> None:
    """Extract listing records from pages and append them as one snapshot."""
    write_snapshot(pages_to_listings(pages, layout, source), snapshot_root, stamp)


def run_pipeline(spark: SparkSession, snapshot_root: str, out_root: str,
                 publish_root: str | None = None, fmt: str = "parquet",
                 star_mode: str = "overwrite", gate: bool = True,
                 named_prefix: str | None = None) -> PipelineResult:
    """Run every stage on the newest snapshot under ``snapshot_root``.

    Snapshots are ``snapshot_ts=`` partitions (``write_snapshot``), or, with
    ``named_prefix``, timestamp-named files such as
    ``<prefix>20260417_033305.csv`` in one flat folder (the newest name
    wins; rows without a sequence column keep their file order)."""
    out = out_root.rstrip("/")
    if named_prefix is None:
        raw = read_latest_snapshot(spark, snapshot_root, RAW_LISTINGS, fmt)
    else:
        raw = read_latest_named_snapshot(spark, snapshot_root, RAW_LISTINGS, named_prefix,
                                         "csv" if fmt == "parquet" else fmt)
    if raw is None:
        raise FileNotFoundError(f"no snapshot under {snapshot_root}")
    raw = raw.drop(SNAPSHOT_COL)
    if raw.isEmpty():
        raise ValueError(f"newest snapshot under {snapshot_root} has no rows")
    paths = {"clean": f"{out}/clean", "enriched": f"{out}/enriched",
             "location_stats": f"{out}/location_stats", "warehouse": f"{out}/warehouse"}

    # sorted within each task (no shuffle): row-group min/max statistics on
    # clean_location let per-location reads skip most of the file
    seen = Q.Observed()
    write_dataset(seen.watch(clean_listings(raw).sortWithinPartitions("clean_location", "price"), Q.clean_rules()), paths["clean"])
    clean = spark.read.parquet(paths["clean"])

    write_dataset(seen.watch(T.enrich(clean), Q.enriched_rules()), paths["enriched"])
    write_dataset(T.location_stats(clean), paths["location_stats"])

    star = load_star(clean, paths["warehouse"], star_mode, watch=lambda fact: seen.watch(fact, Q.fact_rules()))
    reports = {
        "rent_by_location": V.rent_by_location(star),
        "rent_by_type": V.rent_by_type(star),
        "price_distribution": V.price_distribution(star),
        "cheapest_two_bed": V.cheapest_by_bedrooms(star, 2, 5),
        "segment_summary": T.segment_summary(clean),
        "best_deals": T.best_deals(clean),
    }
    # counted while the outputs were written: the gate reads none of them again
    report = seen.report(spark).unionByName(Q.has_columns(clean, REQUIRED_CLEAN_COLUMNS, "clean_required_columns"))
    if gate:
        Q.assert_quality(report)

    if publish_root:
        zone = f"{publish_root.rstrip('/')}/raw/listings"
        if named_prefix is None:
            paths["raw/listings"] = publish_snapshots(spark, snapshot_root, zone, RAW_LISTINGS, fmt)
        else:
            paths["raw/listings"] = publish_named_snapshots(spark, snapshot_root, zone, RAW_LISTINGS, named_prefix,
                                                            "csv" if fmt == "parquet" else fmt)
        published = publish_zones({
            "clean": {"listings_clean": clean,
                      "listings_enriched": spark.read.parquet(paths["enriched"]),
                      "location_stats": spark.read.parquet(paths["location_stats"])}},
            publish_root)
        paths.update({f"{zone}/{name}": p for (zone, name), p in published.items()})
    return PipelineResult(paths, reports, report)
