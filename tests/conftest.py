import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from rentscope.session import local_session
    s = local_session(8, shuffle_partitions=8, app="rentscope-tests")
    yield s


def eval_col(spark, values, fn, dtype="string"):
    """Evaluate ``fn(col)`` over ``values`` in one DataFrame, in order."""
    from pyspark.sql import functions as F
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {dtype}")
    out = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in out]
