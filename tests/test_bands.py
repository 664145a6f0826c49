"""The range join with stored bands against a plain search."""

import random

import pytest
from pyspark.sql import functions as F

from rentscope.operators import bands as B

TOP = (1 << 63) - 1


def brute(value, table):
    return min((i for i, a, b in table if None not in (value, a, b) and a <= value <= b), default=None)


def looked_up(spark, values, table):
    df = spark.createDataFrame([(v, k) for k, v in enumerate(values)], "price long, listing long")
    t = spark.createDataFrame(table, "id long, low long, high long")
    return B.with_first_band(df, t, "price", "id", "low", "high")


def tables():
    r = random.Random(1)
    few = [(3, 0, 10), (1, 5, 20), (2, 5, 7), (4, None, 9), (5, 30, 25)]
    many = [(i, (a := r.randrange(-500, 500)), a + r.choice([-1, 0, 1, 7, 64, 300])) for i in r.sample(range(1000), 200)]
    wide = [(i, -TOP - 1, TOP) for i in (40, 50)] + [(i, i, TOP) for i in range(35)] + [(7, TOP, TOP), (6, -TOP - 1, -TOP - 1)]
    return {"few": few, "many": many, "wide": wide, "none": []}


@pytest.mark.parametrize("name", ["few", "many", "wide", "none"])
@pytest.mark.parametrize("chain", [0, 32])
def test_first_band_matches_a_search(spark, monkeypatch, name, chain):
    monkeypatch.setattr(B, "CHAIN", chain)
    table = tables()[name]
    edges = {x + d for _, *ab in table for x in ab if x is not None for d in (-1, 0, 1) if -TOP - 1 <= x + d <= TOP}
    values = [None, 0, 1, -1, TOP, -TOP - 1, 12345, 12345, *edges]
    got = {r.listing: r.id for r in looked_up(spark, values, table).collect()}
    assert got == {k: brute(v, table) for k, v in enumerate(values)}


def test_blocks_cut_a_range(spark):
    for low, high in ((0, 0), (5, 5), (3, 17), (-9, 9), (-8, -1), (1, 1 << 20), (7, 6)):
        rows = spark.range(1).select(F.explode(B.aligned_blocks(F.lit(low), F.lit(high))).alias("b")).select("b.*").collect()
        covered = sorted((r.block << r.level, ((r.block + 1) << r.level) - 1) for r in rows)
        assert len(rows) <= 2 * B.LEVELS
        if low > high:
            assert covered == []
            continue
        assert covered[0][0] == low and covered[-1][1] == high
        assert all(b + 1 == c for (_, b), (c, _) in zip(covered, covered[1:]))


def test_large_overlapping_table(spark):
    """10^5 bands, thousands of them over each price, and no nested loop."""
    t = spark.range(100_000).select(F.col("id"), (F.col("id") * 7919 % 9800 + 200 - F.col("id") % 900).alias("low"),
                                    (F.col("id") * 7919 % 9800 + 200 + F.col("id") % 400).alias("high"))
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 1500).otherwise(F.col("id") % 12000).alias("price"))
    got = B.with_first_band(df, t.withColumnRenamed("id", "band"), "price", "band", "low", "high")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert got.count() == 20_000
    table = [(i, i * 7919 % 9800 + 200 - i % 900, i * 7919 % 9800 + 200 + i % 400) for i in range(100_000)]
    for r in got.select("price", "band").distinct().sample(0.01, 3).collect():
        assert r.band == brute(r.price, table)
