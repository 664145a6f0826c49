"""Operators checked against brute-force formulations on small inputs."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rentscope.operators import clean as C
from rentscope.operators import quality as Q
from rentscope.operators import transforms as T
from rentscope.operators import views as V
from rentscope.operators.dedup import keep_first
from rentscope.operators.keys import dense_ids
from rentscope.operators.star import Star, build_star, fact_listings
from rentscope.schemas import RAW_LISTINGS

RAW_ROWS = [
    # seq, title, price, price_raw, location, link, scraped_at, source
    (5, "2 bed 2 bath apartment", 1500, "$1,500", "Dallas, TX 75201", "l5", None, "feed"),
    (1, "2 bed 2 bath apartment", 1500, "$1,500", "Dallas, TX 75201", "l1", None, "feed"),
    (2, None, 900, "$900", None, "l2", None, "feed"),
    (7, None, 900, "$900", None, "l7", None, "feed"),
    (3, "Studio loft", 700, "$700", "Plano", "l3", None, "feed"),
    (4, "1br", 150, "$150", "Plano", "l4", None, "feed"),
    (6, "3 bedroom house", None, "free", "Plano", "l6", None, "feed"),
    (8, "1bd 1ba", 700, "$700", "plano", "l8", None, "feed"),
    (9, "2 bed", 2500, "$2,500", "Irving, TX", "l9", None, "feed"),
]


def raw_df(spark):
    return spark.createDataFrame(RAW_ROWS, RAW_LISTINGS)


def test_keep_first_null_equal_lowest_seq(spark):
    got = sorted(r.listing_seq for r in keep_first(raw_df(spark), C.DEDUP_KEYS).collect())
    assert got == [1, 2, 3, 4, 6, 8, 9]


def test_keep_first_plan_limits_before_shuffle(spark):
    plan = keep_first(raw_df(spark), C.DEDUP_KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_clean_listings(spark):
    clean = C.clean_listings(raw_df(spark))
    rows = {r.listing_seq: r for r in clean.collect()}
    assert sorted(rows) == [1, 2, 3, 8, 9]  # 4 below 200, 6 null price, dups gone
    assert rows[1].bedrooms == 2 and rows[1].price_per_bedroom == 750.0
    assert rows[2].clean_location == "Unknown" and rows[2].price_category == "Mid-Range"
    assert rows[3].bedrooms == 0 and rows[3].price_per_bedroom is None
    assert rows[8].clean_location == "Plano"


def _brute_rank(df):
    w = Window.partitionBy("clean_location").orderBy(F.asc_nulls_first("price"))
    return df.select("listing_seq", F.rank().over(w).alias("r"),
                     F.count(F.lit(1)).over(Window.partitionBy("clean_location")).alias("n"))


def test_rank_matches_window_rank(spark):
    rows = [(i, f"L{i % 3}", (i * 37) % 11 if i % 5 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "listing_seq long, clean_location string, price long")
    got = {r.listing_seq: (r.price_rank_in_location, r.listings_in_location)
           for r in T.rank_by_location(df).collect()}
    want = {r.listing_seq: (r.r, r.n) for r in _brute_rank(df).collect()}
    assert got == want


def test_location_stats_invariants(spark):
    stats = T.location_stats(C.clean_listings(raw_df(spark))).collect()
    for r in stats:
        assert r.total_listings >= 1
        assert r.min_price - 0.5 <= r.avg_price <= r.max_price + 0.5
        assert (r.price_stddev is None) == (r.total_listings == 1)
    assert [r.total_listings for r in stats] == sorted((r.total_listings for r in stats), reverse=True)


def test_best_deals_null_bedrooms_and_rounding(spark):
    rows = [(1, "a", 1000, 2, "X"), (2, "b", 1001, 2, "X"), (3, "c", 500, None, "X"),
            (4, "d", 100, None, "X")]
    df = spark.createDataFrame(rows, "listing_seq long, title string, price long, bedrooms int, clean_location string")
    deals = T.best_deals(df).collect()
    # average 1000.5: 1000 - 1000.5 = -0.5 rounds to -1 (a deal), 1001 -> 1 (not);
    # null bedrooms never match the average
    assert [(r.title, r.price_vs_avg) for r in deals] == [("a", -1.0)]


def test_dense_ids_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k")).distinct()
    got = {r.k: r.i for r in dense_ids(df.repartition(13), "k", "i").collect()}
    want = {r.k: r.i for r in df.select("k", F.row_number().over(Window.orderBy("k")).alias("i")).collect()}
    assert got == want


def test_star_lookups_first_match_no_fanout(spark):
    clean = C.clean_listings(raw_df(spark))
    star = build_star(clean)
    fact = star.fact_listings.collect()
    assert len(fact) == clean.count()
    # doubled dimensions (an insert-only rerun) must not fan the fact out
    loc2 = star.dim_location.unionByName(star.dim_location.withColumn("location_id", F.col("location_id") + 100))
    pt2 = star.dim_property_type.unionByName(
        star.dim_property_type.withColumn("property_type_id", F.col("property_type_id") + 100))
    fact2 = fact_listings(clean, loc2, pt2).collect()
    key = lambda r: (r.listing_id, r.location_id, r.property_type_id, r.price_category_id)
    assert sorted(map(key, fact2)) == sorted(map(key, fact))
    by_id = {r.listing_id: r for r in fact}
    assert by_id[2].location_id is None            # null location matches nothing
    assert by_id[2].property_type_id is not None   # (null, null) matches null-safely


def test_views_on_star(spark):
    star = build_star(C.clean_listings(raw_df(spark)))
    dist = {r.category_name: (r.listing_count, r.percentage) for r in V.price_distribution(star).collect()}
    assert dist["Premium"] == (1, 20.0) and dist["Luxury"] == (1, 20.0)
    assert sum(v[0] for v in dist.values()) == 5
    by_loc = V.rent_by_location(star, min_listings=1).collect()
    assert {r.clean_location for r in by_loc} == {"Dallas", "Plano", "Irving"}  # null location dropped
    cheap = V.cheapest_by_bedrooms(star, 2, 5).collect()
    assert [r.price for r in cheap] == [1500, 2500]


def test_expect_single_pass(spark):
    df = spark.createDataFrame([(1, 150), (2, None), (3, 25000)], "id long, price long")
    rep = {r.check: (r.passed, r.observed) for r in Q.expect(df, [
        Q.non_empty(), Q.no_nulls("price"), Q.within("price", 100, 20000)]).collect()}
    assert rep == {"non_empty": (True, 3), "no_null_price": (False, 1), "price_within_100_20000": (False, 1)}
    assert Q.has_columns(df, ["id", "nope"]).first().observed == 1


def test_clean_report_counts(spark):
    rep = {r.metric: r.value for r in C.clean_report(raw_df(spark)).collect()}
    assert rep["raw_rows"] == 9 and rep["deduped_rows"] == 7 and rep["duplicates_removed"] == 2
    assert rep["clean_rows"] == 5 and rep["outliers_removed"] == 2


def test_assert_quality_raises_on_failures(spark):
    import pytest
    df = spark.createDataFrame([(1, None)], "id long, price long")
    rep = Q.expect(df, [Q.non_empty(), Q.no_nulls("price")])
    with pytest.raises(Q.QualityError, match="no_null_price"):
        Q.assert_quality(rep)
    Q.assert_quality(Q.expect(df, [Q.non_empty()]))  # passes silently


def test_views_all_null_prices_give_null_average(spark):
    from rentscope.operators.star import Star
    fact = spark.createDataFrame([(1, None, 1, 1, None), (2, None, 1, 1, None)],
                                 "listing_id long, price long, location_id long, property_type_id long, price_category_id long")
    loc = spark.createDataFrame([(1, "x", "X")], "location_id long, raw_location string, clean_location string")
    pt = spark.createDataFrame([(1, 2, 1, "2BR/1BA")], "property_type_id long, bedrooms int, bathrooms int, property_label string")
    star = Star(loc, pt, None, fact)
    assert [(r.listing_count, r.avg_rent) for r in V.rent_by_location(star, 1).collect()] == [(2, None)]
    assert [(r.listing_count, r.avg_rent) for r in V.rent_by_type(star).collect()] == [(2, None)]
