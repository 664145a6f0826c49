"""End-to-end pipeline, page ingest, append reruns, streaming snapshots."""

import tempfile

from pyspark.sql import functions as F

from rentscope.operators.clean import clean_listings
from rentscope.plans.pipeline import ingest_pages, run_pipeline
from rentscope.schemas import RAW_LISTINGS
from rentscope.sources.files import write_snapshot
from rentscope.sources.fixture import raw_listings
from rentscope.sources.warehouse import load_star, read_star

SF = "/root/testdata/sf0.001"


def test_pipeline_on_newest_snapshot(spark):
    root = tempfile.mkdtemp(prefix="rs-pipe-")
    raw = raw_listings(spark, SF)
    write_snapshot(raw.filter(F.col("listing_seq") % 2 == 0), f"{root}/snap", "20260101_000000")
    write_snapshot(raw, f"{root}/snap", "20260102_000000")
    res = run_pipeline(spark, f"{root}/snap", f"{root}/out", publish_root=f"{root}/zones")
    want = clean_listings(raw).count()
    assert spark.read.parquet(res.paths["clean"]).count() == want
    assert spark.read.parquet(res.paths["clean/listings_clean"]).count() == want
    # every raw snapshot is published under its own stamp, not only the newest
    published = spark.read.parquet(res.paths["raw/listings"]).groupBy(F.col("snapshot_ts").cast("string")).count()
    assert dict(published.collect()) == {"20260101_000000": raw.filter("listing_seq % 2 = 0").count(),
                                         "20260102_000000": raw.count()}
    assert all(r.passed for r in res.quality.collect())
    assert res.reports["rent_by_location"].count() > 0
    # the warehouse is queryable by SQL name after read_star
    read_star(spark, res.paths["warehouse"])
    assert spark.sql("SELECT count(*) FROM v_price_distribution").first()[0] == 4


def test_append_rerun_doubles_rows_without_fanout(spark):
    root = tempfile.mkdtemp(prefix="rs-star-") + "/wh"
    clean = clean_listings(raw_listings(spark, SF))
    n = clean.count()
    first = load_star(clean, root, "overwrite")
    loc_n = first.dim_location.count()
    second = load_star(clean, root, "append")
    assert second.dim_location.count() == 2 * loc_n
    assert second.fact_listings.count() == 2 * n
    assert second.fact_listings.select("listing_id").distinct().count() == 2 * n
    ids = second.fact_listings.groupBy("link").agg(
        F.countDistinct("location_id").alias("l"), F.countDistinct("property_type_id").alias("p"))
    assert ids.filter((F.col("l") > 1) | (F.col("p") > 1)).count() == 0


def test_ingest_pages_then_pipeline(spark):
    root = tempfile.mkdtemp(prefix="rs-pages-")
    li = ('<li class="cl-static-search-result"><a href="/{i}"><div class="title">{b} bed 1 bath</div>'
          '<div class="price">${p}</div><div class="location">Dallas, TX</div></a></li>')
    html = "".join(li.format(i=i, b=1 + i % 3, p=900 + 50 * i) for i in range(12))
    pages = spark.createDataFrame([(1, "u1", html), (2, "u2", html)], "page_id bigint, url string, html string")
    ingest_pages(pages, f"{root}/snap", stamp="20260105_000000")
    res = run_pipeline(spark, f"{root}/snap", f"{root}/out")
    clean = spark.read.parquet(res.paths["clean"])
    assert clean.count() == 12  # page 2 repeats page 1: removed as duplicates
    assert {r.clean_location for r in clean.collect()} == {"Dallas"}


def test_snapshot_stream_cleans_each_snapshot_once(spark):
    from rentscope.streaming.snapshots import start_snapshot_cleaner
    root = tempfile.mkdtemp(prefix="rs-stream-")
    raw = raw_listings(spark, SF)
    write_snapshot(raw, f"{root}/in", "20260101_000000")
    q = start_snapshot_cleaner(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    n1 = spark.read.parquet(f"{root}/out").count()
    assert n1 == clean_listings(raw).count()
    write_snapshot(raw, f"{root}/in", "20260102_000000")
    q = start_snapshot_cleaner(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt")
    q.awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    assert out.count() == 2 * n1
    assert out.select("snapshot_ts").distinct().count() == 2


def test_pipeline_on_pandas_written_named_csv(spark):
    """Flat folder of timestamp-named CSV files as pandas writes them: no
    sequence column, integer prices written as floats next to a missing one."""
    import math

    import pandas as pd
    folder = tempfile.mkdtemp(prefix="rs-flat-")
    ts = "2026-04-17T03:33:05.123456"
    newer = pd.DataFrame(
        [("2 bed 2 bath apartment", 1500.0, "$1,500", "Dallas, TX 75201", "l1", ts, "feed"),
         ("2 bed 2 bath apartment", 1500.0, "$1,500", "Dallas, TX 75201", "l2", ts, "feed"),
         ("Studio loft", math.nan, "free", "Plano", "l3", ts, "feed"),
         ("Nice 1br apartment", 900.0, "$900", None, "l4", ts, "feed")],
        columns=["title", "price", "price_raw", "location", "link", "scraped_at", "source"])
    newer.to_csv(f"{folder}/listings_20260102_000000.csv", index=False)
    newer.head(1).to_csv(f"{folder}/listings_20260101_000000.csv", index=False)
    res = run_pipeline(spark, folder, f"{folder}/out", named_prefix="listings_2", gate=False)
    clean = spark.read.parquet(res.paths["clean"]).orderBy("listing_seq").collect()
    assert [r.link for r in clean] == ["l1", "l4"]   # first copy kept, null price dropped
    assert clean[0].price == 1500 and clean[0].bedrooms == 2 and clean[0].scraped_at.year == 2026
    assert clean[1].clean_location == "Unknown"


def test_pages_to_listings_keeps_page_order(spark):
    from rentscope.plans.pipeline import pages_to_listings
    li = '<li class="cl-static-search-result"><div class="title">t{i}</div><div class="price">${p}</div></li>'
    pages = spark.createDataFrame(
        [(2, "u", li.format(i=0, p=100) + li.format(i=1, p=200)), (10, "u", li.format(i=2, p=300))],
        "page_id bigint, url string, html string")
    rows = pages_to_listings(pages).orderBy("listing_seq").collect()
    assert [r.title for r in rows] == ["t0", "t1", "t2"]
    assert rows[1].listing_seq - rows[0].listing_seq == 1 and rows[0].source == "web"


def test_page_ids_of_any_size_keep_apart(spark):
    from rentscope.plans.pipeline import pages_to_listings
    li = '<li class="cl-static-search-result"><div class="title">t{i}</div></li>'
    pages = spark.createDataFrame([(5 + (1 << 33), "u", li.format(i=2)), (5, "u", li.format(i=1)), (-1, "u", li.format(i=0))],
                                  "page_id bigint, url string, html string")
    rows = pages_to_listings(pages).orderBy("listing_seq").collect()
    assert [(r.listing_seq, r.title) for r in rows] == [(1, "t0"), (2, "t1"), (3, "t2")]


def test_named_snapshots_are_published_under_their_names(spark):
    from rentscope.sources.files import publish_named_snapshots, published, read_published, write_named_snapshot
    root = tempfile.mkdtemp(prefix="rs-zone-")
    raw = raw_listings(spark, SF)
    parts = {f"listings_2026010{k + 1}_000000": raw.filter(F.col("listing_seq") % 2 == k) for k in (0, 1)}
    for name, part in parts.items():
        write_named_snapshot(part, f"{root}/in", stamp=name.removeprefix("listings_"))
        publish_named_snapshots(spark, f"{root}/in", f"{root}/zone", RAW_LISTINGS)
    assert published(spark, f"{root}/zone") == {name: part.count() for name, part in parts.items()}
    assert read_published(spark, f"{root}/zone", RAW_LISTINGS).drop("snapshot_ts").exceptAll(raw).count() == 0


def test_failed_append_leaves_the_old_star_whole(spark, monkeypatch):
    import pytest

    from rentscope.sources import warehouse
    root = tempfile.mkdtemp(prefix="rs-star-") + "/wh"
    clean = clean_listings(raw_listings(spark, SF))
    old = {n: df.count() for n, df in load_star(clean, root).tables().items()}

    def killed(*_):
        raise RuntimeError("killed after the dimensions")
    with monkeypatch.context() as m:
        m.setattr(warehouse, "fact_from_stored_dimensions", killed)
        for mode in ("append", "overwrite"):
            with pytest.raises(RuntimeError, match="killed"):
                load_star(clean, root, mode)
            assert {n: df.count() for n, df in read_star(spark, root).tables().items()} == old
    again = load_star(clean, root, "append")
    assert {n: df.count() for n, df in again.tables().items()} == {n: 2 * k for n, k in old.items()}
    assert again.dim_location.agg(F.max("location_id")).first()[0] == 2 * old["dim_location"]
    assert {n: df.count() for n, df in load_star(clean, root).tables().items()} == old


def test_star_with_other_bands(spark):
    root = tempfile.mkdtemp(prefix="rs-star-") + "/wh"
    clean = clean_listings(raw_listings(spark, SF))
    bands = spark.createDataFrame([(7, "low", 0, 1500), (3, "all", 1000, 9000), (9, "never", 5, 1), (5, "none", None, None)],
                                  "price_category_id long, category_name string, min_price int, max_price int")
    fact = load_star(clean, root, bands=bands).fact_listings
    wrong = fact.filter(~F.col("price_category_id").eqNullSafe(
        F.expr("CASE WHEN price BETWEEN 1000 AND 9000 THEN 3 WHEN price BETWEEN 0 AND 1500 THEN 7 END")))
    assert fact.count() == clean.count() and wrong.count() == 0
    # appended fixed bands come after the stored ones: they only catch what no older band holds
    again = load_star(clean, root, "append").fact_listings.filter(f"listing_id > {fact.agg(F.max('listing_id')).first()[0]}")
    assert again.filter("price_category_id > 7").count() == again.filter("price > 9000").count()


def test_cli_run(spark, capsys):
    from rentscope.__main__ import main
    root = tempfile.mkdtemp(prefix="rs-cli-")
    write_snapshot(raw_listings(spark, SF), f"{root}/snap", "20260101_000000")
    assert main(["run", "--snapshots", f"{root}/snap", "--out", f"{root}/out"]) == 0
    out = capsys.readouterr().out
    assert "warehouse\t" in out and spark.read.parquet(f"{root}/out/clean").count() > 0


def test_gate_stops_a_snapshot_with_no_clean_rows(spark):
    import pytest

    from rentscope.operators.quality import QualityError
    root = tempfile.mkdtemp(prefix="rs-gate-")
    raw = spark.createDataFrame([(1, "2 bed", 50, "$50", "Dallas", "l", None, "feed")], RAW_LISTINGS)
    write_snapshot(raw, f"{root}/snap", "20260101_000000")
    with pytest.raises(QualityError, match="clean_non_empty"):
        run_pipeline(spark, f"{root}/snap", f"{root}/out")
