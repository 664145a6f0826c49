"""Records with keys of their own, observed rules, distinct sketches."""

import tempfile

import pytest
from pyspark.sql import functions as F

from rentscope.operators import clean as C
from rentscope.operators import quality as Q
from rentscope.sources import records as R


def frame(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, record map<string,string>")


def test_keys_are_united_and_typed(spark):
    rows = [{"a": "1", "b": "x", "when": "2026-01-02T03:04:05.5"}, {"a": "2.5", "c": "true", "big": "9" * 30}, {},
            {"b": None, "c": "FALSE", "when": "2026-01-03", "n": None, "m": "7"}, {"m": "x7", "flag": "true"}, {"flag": "3"}]
    got = R.records_to_frame(frame(spark, rows).repartition(3), keep=("id",))
    assert dict(got.dtypes) == {"id": "int", "a": "double", "b": "string", "big": "double", "c": "boolean", "flag": "string",
                                "m": "string", "n": "string", "when": "timestamp_ntz"}
    by_id = {r.id: r for r in got.collect()}
    assert [by_id[i].a for i in range(6)] == [1.0, 2.5, None, None, None, None]
    assert by_id[3].c is False and by_id[3].when.day == 3 and by_id[4].flag == "true" and by_id[2].b is None


def test_kinds_do_not_depend_on_the_split(spark):
    rows = [{"k": v} for v in ["1", "2", "+3", "-4"] * 20 + ["5.5"]]
    for parts in (1, 7):
        assert R.records_to_frame(frame(spark, rows).repartition(parts)).dtypes == [("k", "double")]
    assert R.records_to_frame(frame(spark, rows[:-1])).dtypes == [("k", "bigint")]
    assert R.records_to_frame(frame(spark, rows).limit(0), keep=("id",)).columns == ["id"]


def test_too_many_keys_are_no_columns(spark, monkeypatch):
    monkeypatch.setattr(R, "MAX_COLUMNS", 3)
    assert len(R.records_to_frame(frame(spark, [{f"k{i}": "1"} for i in range(3)])).columns) == 3
    with pytest.raises(ValueError, match="more than 3"):
        R.records_to_frame(frame(spark, [{f"k{i}": "1"} for i in range(4)]))


def test_rules_are_observed_while_writing(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("price"))
    rules = [Q.non_empty(), Q.no_nulls("price"), Q.within("price", 5, 900)]
    seen, path = Q.Observed(), tempfile.mkdtemp(prefix="rs-seen-") + "/t"
    seen.watch(df.repartition(5), rules).write.parquet(path)
    want = sorted(map(tuple, Q.expect(spark.read.parquet(path), rules).collect()))
    assert sorted(map(tuple, seen.report(spark).collect())) == want
    assert seen.values() == {"non_empty": 1000, "no_null_price": 100, "price_within_5_900": 4 + 90}
    with pytest.raises(Q.QualityError, match="no_null_price"):
        Q.assert_quality(seen.report(spark))


def test_a_task_that_runs_again_counts_once():
    """In a session of its own: every partition's first attempt fails after its rows."""
    import subprocess
    import sys
    from pathlib import Path
    code = '''
import os, sys, tempfile
from pyspark import TaskContext
from pyspark.sql import SparkSession
from rentscope.operators import quality as Q
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").getOrCreate()
marks = tempfile.mkdtemp()
def once(batches):
    for b in batches:
        yield b
    mark = os.path.join(marks, str(TaskContext.get().partitionId()))
    if not os.path.exists(mark):
        open(mark, "w").close()
        raise RuntimeError("lost")
df = spark.range(0, 1000, 1, 4).mapInArrow(once, "id long")
seen = Q.Observed()
seen.watch(df, [Q.non_empty("rows")]).write.parquet(os.path.join(marks, "out"))
print("ROWS", seen.values()["rows"], len(os.listdir(marks)))
'''
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240,
                         cwd=Path(__file__).resolve().parents[1])
    assert "ROWS 1000 5" in out.stdout, out.stderr[-2000:]


def test_sketches_merge(spark):
    df = spark.range(60_000).select((F.col("id") % 5).alias("part"), F.when(F.col("id") % 100 > 0, F.concat(
        F.lit("v"), (F.col("id") % 20_000).cast("string"))).alias("v"))
    sketches = C.distinct_sketches(df, "v", "part")
    exact = df.agg(F.count_distinct("v")).first()[0]
    assert abs(C.distinct_estimates(sketches).first().estimate - exact) <= 4 * 1.04 / 64 * exact
    assert C.distinct_estimates(sketches, "part").count() == 5
    nulls = spark.createDataFrame([(1, None)], "part int, v string")
    assert C.distinct_estimates(C.distinct_sketches(nulls, "v", "part")).first().estimate == 0
