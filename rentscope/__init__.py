"""rentscope: rental-listing analytics as Spark DataFrame jobs.

Raw listing snapshots (or fetched web pages) go in; cleaned listings,
location and segment statistics, best deals, a star schema with its
reporting views and data-quality results come out.  Every stage is a
function ``DataFrame -> DataFrame`` built from native Spark expressions,
so Catalyst can prune, push down and code-generate the whole plan.
"""

__version__ = "0.1.0"

from rentscope.operators.clean import clean_listings, clean_report, scrape_summary  # noqa: E402,F401
from rentscope.operators.quality import assert_quality, expect, quality_report  # noqa: E402,F401
from rentscope.operators.star import build_star  # noqa: E402,F401
from rentscope.operators.transforms import (  # noqa: E402,F401
    best_deals, enrich, location_stats, rank_by_location, segment_summary,
)
from rentscope.plans.pipeline import ingest_pages, run_pipeline  # noqa: E402,F401
from rentscope.sources.html import extract_page_records  # noqa: E402,F401
from rentscope.sources.warehouse import load_star, read_star  # noqa: E402,F401
