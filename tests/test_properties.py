"""Property tests of the core operators against independent formulations:
pandas ``drop_duplicates(keep='first')`` for dedup, Spark's window
``rank()`` for ranking, a global ``row_number()`` for surrogate keys."""

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from rentscope.operators.dedup import keep_first
from rentscope.operators.keys import dense_ids
from rentscope.operators.transforms import rank_by_location

_rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                           st.one_of(st.none(), st.integers(1, 4)),
                           st.sampled_from(["X", "Y", None])), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(_rows, st.randoms(use_true_random=False))
def test_keep_first_matches_pandas(spark, rows, rnd):
    seqs = list(range(len(rows)))
    rnd.shuffle(seqs)                      # file order = seq order, rows arrive shuffled
    data = [(s, t, p, loc) for s, (t, p, loc) in zip(seqs, rows)]
    df = spark.createDataFrame(data, "listing_seq long, title string, price long, location string")
    got = sorted(r.listing_seq for r in keep_first(df.repartition(3), ["title", "price", "location"]).collect())
    pdf = pd.DataFrame(sorted(data), columns=["listing_seq", "title", "price", "location"])
    want = sorted(pdf.drop_duplicates(subset=["title", "price", "location"], keep="first").listing_seq)
    assert got == want


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["L1", "L2", "L3", None]), st.one_of(st.none(), st.integers(0, 6))),
                min_size=1, max_size=80))
def test_rank_matches_window_rank(spark, rows):
    df = spark.createDataFrame([(i, loc, p) for i, (loc, p) in enumerate(rows)],
                               "listing_seq long, clean_location string, price long")
    got = {r.listing_seq: (r.price_rank_in_location, r.listings_in_location)
           for r in rank_by_location(df).collect()}
    w = Window.partitionBy("clean_location").orderBy(F.asc_nulls_first("price"))
    want = {r.listing_seq: (r.r, r.n) for r in df.select(
        "listing_seq", F.rank().over(w).alias("r"),
        F.count(F.lit(1)).over(Window.partitionBy("clean_location")).alias("n")).collect()}
    assert got == want


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 3000), st.integers(1, 16))
def test_dense_ids_match_row_number(spark, n, parts):
    df = spark.range(n).select((F.col("id") * 7 + 3).alias("k")).repartition(parts)
    got = sorted((r.k, r.i) for r in dense_ids(df, "k", "i").collect())
    assert [i for _, i in got] == list(range(1, n + 1))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(1, 5)), st.one_of(st.none(), st.integers(1, 3)),
                          st.one_of(st.none(), st.integers(100, 2500))), min_size=1, max_size=60))
def test_views_equal_join_then_aggregate(spark, facts):
    from rentscope.operators import views as V
    from rentscope.operators.star import Star
    fact = spark.createDataFrame([(i, loc, pt, p) for i, (loc, pt, p) in enumerate(facts)],
                                 "listing_id long, location_id long, property_type_id long, price long")
    # five raw locations, three clean names (ids 1/2 and 3/4 share one)
    loc = spark.createDataFrame([(1, "a", "A"), (2, "a ", "A"), (3, "b", "B"), (4, "b,", "B"), (5, "c", "C")],
                                "location_id long, raw_location string, clean_location string")
    pt = spark.createDataFrame([(1, 0, None, "Studio"), (2, 2, 1, "2BR/1BA"), (3, None, None, "Unknown")],
                               "property_type_id long, bedrooms int, bathrooms int, property_label string")
    star = Star(loc, pt, None, fact)
    j = fact.join(loc, "location_id")
    want = {r.clean_location: (r.n, r.a, r.mn, r.mx) for r in j.groupBy("clean_location").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 0).alias("a"),
        F.min("price").alias("mn"), F.max("price").alias("mx")).filter("n >= 1").collect()}
    got = {r.clean_location: (r.listing_count, r.avg_rent, r.min_rent, r.max_rent)
           for r in V.rent_by_location(star, min_listings=1).collect()}
    assert got == want
    jt = fact.join(pt, "property_type_id")
    want_t = {(r.property_label, r.bedrooms): (r.n, r.a) for r in jt.groupBy("property_label", "bedrooms").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 0).alias("a")).collect()}
    got_t = {(r.property_label, r.bedrooms): (r.listing_count, r.avg_rent) for r in V.rent_by_type(star).collect()}
    assert got_t == want_t
