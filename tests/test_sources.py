"""File sources and sinks."""

import os
import tempfile

from pyspark.sql import functions as F

from rentscope.schemas import RAW_LISTINGS
from rentscope.sources import files


def test_csv_null_tokens_and_types(spark):
    d = tempfile.mkdtemp(prefix="rs-csv-")
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("listing_seq,title,price,price_raw,location,link,scraped_at,source\n"
                 '1,"a ""quoted"" title",1500,"$1,500",NA,l,2026-04-17T03:33:05.123,feed\n'
                 "2,None,bad,,  Dallas  ,l2,,feed\n")
    rows = files.read_csv(spark, d, RAW_LISTINGS).orderBy("listing_seq").collect()
    assert rows[0].title == 'a "quoted" title' and rows[0].price == 1500 and rows[0].location is None
    assert rows[0].scraped_at.year == 2026
    assert rows[1].title is None and rows[1].price is None and rows[1].location == "  Dallas  "


def test_latest_snapshot_prunes_older(spark):
    root = tempfile.mkdtemp(prefix="rs-snap-") + "/s"
    df = spark.createDataFrame([(1, "a", 1, "$1", "x", "l", None, "feed")], RAW_LISTINGS)
    files.write_snapshot(df, root, "20260101_000000")
    files.write_snapshot(df.withColumn("listing_seq", F.lit(2).cast("long")), root, "20260102_000000")
    latest = files.read_latest_snapshot(spark, root, RAW_LISTINGS)
    assert [r.listing_seq for r in latest.collect()] == [2]
    assert "PartitionFilters: [isnotnull(snapshot_ts" in latest._jdf.queryExecution().executedPlan().toString() \
        or "snapshot_ts" in str(latest._jdf.queryExecution().executedPlan().toString())
    assert files.read_latest_snapshot(spark, root, RAW_LISTINGS).count() == 1


def test_publish_zone(spark):
    root = tempfile.mkdtemp(prefix="rs-zone-")
    df = spark.range(10)
    paths = files.publish_zone({"t": df}, root, "clean")
    assert paths["t"].endswith("/clean/t") and spark.read.parquet(paths["t"]).count() == 10


def test_named_snapshots_newest_by_name(spark):
    folder = tempfile.mkdtemp(prefix="rs-named-") + "/data"
    df = spark.createDataFrame([(1, "a", 1, "$1", "x", "l", None, "feed")], RAW_LISTINGS)
    assert files.read_latest_named_snapshot(spark, folder, RAW_LISTINGS) is None
    files.write_named_snapshot(df, folder, stamp="20260102_000000")
    files.write_named_snapshot(df.withColumn("listing_seq", F.lit(9).cast("long")), folder,
                               stamp="20260101_000000")
    got = files.read_latest_named_snapshot(spark, folder, RAW_LISTINGS)
    assert [r.listing_seq for r in got.collect()] == [1]


def test_latest_snapshot_missing_folder(spark):
    missing = tempfile.mkdtemp(prefix="rs-none-") + "/nothing"
    assert files.read_latest_snapshot(spark, missing, RAW_LISTINGS) is None


def test_write_concurrently_propagates_errors(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="rs-conc-")
    ok = spark.range(5)
    bad = spark.range(5).select((F.col("id") / F.lit(0)).cast("int").alias("x")).filter("assert_true(x < 0) is null")
    with pytest.raises(Exception):
        files.write_concurrently({f"{root}/a": ok, f"{root}/b": bad})
    files.write_concurrently({f"{root}/c": ok, f"{root}/d": ok})
    assert spark.read.parquet(f"{root}/c").count() == 5 and spark.read.parquet(f"{root}/d").count() == 5


def test_csv_columns_matched_by_name(spark):
    d = tempfile.mkdtemp(prefix="rs-order-")
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("source,extra,location,price,title,listing_seq\n"
                 "feed,zzz,Plano,1200.0,\"multi\nline\",7\n")
    row = files.read_csv(spark, d, RAW_LISTINGS).first()
    assert (row.listing_seq, row.title, row.price, row.location, row.source) == (7, "multi\nline", 1200, "Plano", "feed")
    assert row.price_raw is None and row.link is None   # absent columns are null


def test_csv_headers_of_each_file(spark):
    d = tempfile.mkdtemp(prefix="rs-headers-")
    with open(os.path.join(d, "b.csv"), "w") as fh:
        fh.write("location,title,price\nPlano,two,1500.0\nNA,three,none\n")
    with open(os.path.join(d, "a.csv"), "w") as fh:
        fh.write("title,location,more,price\none,Dallas,x,900\n")
    rows = files.read_csv(spark, d, RAW_LISTINGS, seq_col="listing_seq").orderBy("listing_seq").collect()
    assert [(r.listing_seq, r.title, r.location, r.price) for r in rows] == [
        (1, "one", "Dallas", 900), (2, "two", "Plano", 1500), (3, "three", None, None)]
    empty = tempfile.mkdtemp(prefix="rs-headers-")
    open(os.path.join(empty, "a.csv"), "w").close()
    assert files.read_csv(spark, empty, RAW_LISTINGS).count() == 0


def test_csv_snapshots_read_like_any_csv(spark):
    root = tempfile.mkdtemp(prefix="rs-csvsnap-")
    os.makedirs(f"{root}/snapshot_ts=20260101_000000")
    with open(f"{root}/snapshot_ts=20260101_000000/x.csv", "w") as fh:
        fh.write("listing_seq,title,price,location\n1,NA,1500.0,nan\n")
    [row] = files.read_latest_snapshot(spark, root, RAW_LISTINGS, "csv").collect()
    assert (row.title, row.price, row.location, row.snapshot_ts) == (None, 1500, None, "20260101_000000")


def test_other_errors_are_not_read_as_nothing_there(spark):
    import pytest
    with pytest.raises(Exception):
        files.read_latest_snapshot(spark, "nosuchscheme://x/y", RAW_LISTINGS)


def test_fifty_headers_in_one_scan(spark):
    import csv
    import random
    r = random.Random(2)
    d = tempfile.mkdtemp(prefix="rs-50 headers%-")
    names, want = RAW_LISTINGS.names, []
    for k in range(50):
        own = names + [f"extra {k}", 'a "quoted"\nname'][:k % 3]
        r.shuffle(own)
        if k % 7 == 0:
            own.remove("location")
        with open(os.path.join(d, f"f{k:02d}.csv"), "w", newline="") as fh:
            fh.write("\ufeff" if k % 5 == 0 else "")
            out = csv.DictWriter(fh, own, restval="x", extrasaction="ignore", lineterminator="\r\n" if k % 2 else "\n")
            out.writeheader()
            for i in range(k % 4):
                row = {"listing_seq": 10 * k + i, "title": "two\nlines" if i else "t, t", "price": 100 + k, "price_raw": "$1",
                       "location": f"loc {k}", "link": "NaN", "scraped_at": "2026-01-02T03:04:05", "source": 'say "hi"'}
                out.writerow(row)
                want.append((10 * k + i, row["title"], 100 + k, None if k % 7 == 0 else f"loc {k}", 'say "hi"'))
    df = files.read_csv(spark, d, RAW_LISTINGS)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("csv") == 1 and "Union" not in plan
    assert sorted((x.listing_seq, x.title, x.price, x.location, x.source) for x in df.collect()) == want
    assert all(x.link is None for x in df.collect())


def test_large_files_are_split_where_no_cell_holds_a_line_break(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for cell, parts in (("plain", 3), ("two\nlines", 1)):
        d = tempfile.mkdtemp(prefix="rs-large-")
        with open(os.path.join(d, "a.csv"), "w") as fh:
            fh.write("title,listing_seq\n" + "".join(f'"{cell} ""x""",{i}\n' for i in range(3000)))
        spark.conf.set("spark.sql.files.maxPartitionBytes", os.path.getsize(f"{d}/a.csv") // 3)
        try:
            df = files.read_csv(spark, d, RAW_LISTINGS)
            assert df.rdd.getNumPartitions() >= parts and (parts > 1 or df.rdd.getNumPartitions() == 1)
            rows = df.select("listing_seq", "title").collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert sorted(r.listing_seq for r in rows) == list(range(3000)) and {r.title for r in rows} == {f'{cell} "x"'}


def test_headers_where_tasks_cannot_open_files(spark, monkeypatch):
    d = tempfile.mkdtemp(prefix="rs-lines-")
    for name, text in (("a", "title,listing_seq\nx,1\n"), ("b", "listing_seq,link,title\n2,l,y\n"), ("c", "")):
        with open(os.path.join(d, f"{name}.csv"), "w") as fh:
            fh.write(text)
    for can in (True, False):
        monkeypatch.setattr(files.Ranges, "can", classmethod(lambda *_, can=can: can))
        rows = files.read_csv(spark, d, RAW_LISTINGS).collect()
        assert sorted((r.listing_seq, r.title, r.link) for r in rows) == [(1, "x", None), (2, "y", "l")]


def test_first_record():
    assert files.first_record('a,"b\nc"\r\nd', False) == 'a,"b\nc"'
    assert files.first_record("a,b", False) is None and files.first_record("a,b", True) == "a,b"
    assert files.first_record('a,"b\n', False) is None
