"""Hot keys: one location holds half the rows, one dedup key repeats
thousands of times.  Results must equal brute-force formulations, and the
plans must reduce a hot key before its shuffle."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rentscope.operators import clean as C
from rentscope.operators import transforms as T
from rentscope.operators.dedup import keep_first
from rentscope.operators.star import build_star


SKEW_TEST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


class skew_conf:
    """No broadcasts and test-sized skew thresholds, restored on exit."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.old = {k: self.spark.conf.get(k, None) for k in SKEW_TEST_CONF}
        for k, v in SKEW_TEST_CONF.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *exc):
        for k, v in self.old.items():
            if v is None:
                self.spark.conf.unset(k)
            else:
                self.spark.conf.set(k, v)


def hot_raw(spark, n=20000):
    hot = F.col("id") % 2 == 0
    return spark.range(n).repartition(8).select(
        F.col("id").alias("listing_seq"),
        F.when(F.col("id") % 4 == 0, F.lit("2 bed 2 bath apartment"))
         .otherwise(F.concat(F.lit("unit "), (F.col("id") % 97).cast("string"), F.lit(" 1br"))).alias("title"),
        F.when(F.col("id") % 4 == 0, F.lit(1500)).otherwise(200 + F.col("id") % 3000).cast("bigint").alias("price"),
        F.lit(None).cast("string").alias("price_raw"),
        F.when(hot, F.lit("Dallas, TX 75201")).otherwise(F.concat(F.lit("Town "), (F.col("id") % 50).cast("string"))).alias("location"),
        F.lit("l").alias("link"), F.lit(None).cast("timestamp_ntz").alias("scraped_at"), F.lit("feed").alias("source"))


def _plan(df):
    """Run the DataFrame's own adaptive plan (rows counted JVM-side) and
    return the final plan, with AQE's runtime decisions in it."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    return plan.toString()


def test_dedup_hot_key(spark):
    raw = hot_raw(spark)
    got = keep_first(raw, C.DEDUP_KEYS)
    w = Window.partitionBy(*C.DEDUP_KEYS)
    want = raw.withColumn("m", F.min("listing_seq").over(w)).filter(F.col("m") == F.col("listing_seq")).drop("m")
    assert sorted(r.listing_seq for r in got.collect()) == sorted(r.listing_seq for r in want.collect())
    assert "WindowGroupLimit" in _plan(got)


def test_rank_hot_location(spark):
    clean = C.clean_listings(hot_raw(spark))
    got = {r.listing_seq: (r.price_rank_in_location, r.listings_in_location)
           for r in T.rank_by_location(clean).collect()}
    w = Window.partitionBy("clean_location").orderBy(F.asc_nulls_first("price"))
    want = {r.listing_seq: (r.r, r.n) for r in clean.select(
        "listing_seq", F.rank().over(w).alias("r"),
        F.count(F.lit(1)).over(Window.partitionBy("clean_location")).alias("n")).collect()}
    assert got == want
    plan = _plan(T.rank_by_location(clean))
    # the only window runs over (location, price) counts, after a partial aggregate
    assert "partial_count" in plan


def test_stats_and_star_hot_location(spark):
    clean = C.clean_listings(hot_raw(spark))
    stats = {r.clean_location: r.total_listings for r in T.location_stats(clean).collect()}
    want = {r.clean_location: r["count"] for r in clean.groupBy("clean_location").count().collect()}
    assert stats == want
    star = build_star(clean)
    fact = star.fact_listings
    assert fact.count() == clean.count()
    assert fact.filter(F.col("location_id").isNull()).count() == 0
    dallas = star.dim_location.filter(F.col("clean_location") == "Dallas").collect()
    assert len(dallas) == 1
    assert fact.filter(F.col("location_id") == dallas[0].location_id).count() == stats["Dallas"]


def test_fact_join_splits_hot_location(spark):
    """Without a broadcast, the fact ⋈ location join over a hot location is
    planned by AQE as a skew join (the hot partition is split), and the
    result is unchanged."""
    import tempfile

    from rentscope.operators.star import dim_location, dim_property_type
    from rentscope.sources.warehouse import fact_from_stored_dimensions
    root = tempfile.mkdtemp(prefix="rs-skewstar-")
    with skew_conf(spark):
        C.clean_listings(hot_raw(spark, 40000)).write.parquet(f"{root}/clean")
        clean = spark.read.parquet(f"{root}/clean")
        dim_location(clean).write.parquet(f"{root}/wh/dim_location")
        dim_property_type(clean).write.parquet(f"{root}/wh/dim_property_type")
        fact = fact_from_stored_dimensions(clean, f"{root}/wh")
        plan = _plan(fact)
        assert "SortMergeJoin(skew=true)" in plan
        assert fact.count() == clean.count()
        assert fact.filter(F.col("location_id").isNull()).count() == 0


def test_rank_join_splits_hot_location_price(spark):
    """A (location, price) pair holding a quarter of all rows: the rank
    join-back is split by AQE's skew join, ranks still exact."""
    import tempfile
    root = tempfile.mkdtemp(prefix="rs-skewrank-")
    with skew_conf(spark):
        # a quarter of the rows: distinct titles, all Dallas at $1,500 (they survive dedup)
        hot = hot_raw(spark, 40000).withColumn(
            "title", F.when(F.col("listing_seq") % 4 == 0,
                            F.concat(F.lit("unit "), F.col("listing_seq").cast("string"), F.lit(" 2 bed")))
                      .otherwise(F.col("title")))
        C.clean_listings(hot).write.parquet(f"{root}/clean")
        clean = spark.read.parquet(f"{root}/clean")
        assert clean.filter((F.col("clean_location") == "Dallas") & (F.col("price") == 1500)).count() == 10000
        ranked = T.rank_by_location(clean)
        assert "SortMergeJoin(skew=true)" in _plan(ranked)
        w = Window.partitionBy("clean_location").orderBy(F.asc_nulls_first("price"))
        want = {r.listing_seq: r.r for r in clean.select("listing_seq", F.rank().over(w).alias("r")).collect()}
        got = {r.listing_seq: r.price_rank_in_location for r in ranked.collect()}
        assert got == want
