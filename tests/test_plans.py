"""Design rules checked on every catalogue query's physical plans -- the
returned frame's and those of everything it writes on the way: no Python
UDF evaluation, no cartesian product, no nested-loop join."""

import pytest
from pyspark.sql import readwriter

from rentscope.plans import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas", "MapInArrow")
# reading HTML needs a stack: one map-only walk per page; the heads of CSV files are read by ranges in tasks
PAGE_QUERIES = {"extract_page_records", "extract_link_records", "listing_pages_roundtrip", "pages_to_listings", "scrape_stamps",
                "csv_two_headers", "latest_named_csv"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def written(monkeypatch):
    """Plans of the frames that are written (shared stages are built anew)."""
    plans = []
    for name in ("parquet", "csv", "save", "text"):
        write = getattr(readwriter.DataFrameWriter, name)

        def recorded(self, *args, _write=write, **kwargs):
            plans.append(plan_of(self._df))
            return _write(self, *args, **kwargs)
        monkeypatch.setattr(readwriter.DataFrameWriter, name, recorded)
    monkeypatch.setattr(catalog, "_MEMO", {})
    return plans


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plans_are_jvm_only_and_pairs_free(spark, written, name):
    plans = [plan_of(catalog.QUERIES[name](spark, SF)), *written]
    allowed = {"MapInArrow"} if name in PAGE_QUERIES else set()
    assert not [f for f in FORBIDDEN if f not in allowed and any(f in p for p in plans)]


def test_shared_stages_are_seen(spark, written):
    catalog.QUERIES["dim_location"](spark, SF)
    assert any("Join" in p for p in written) and any("Window" in p for p in written)
