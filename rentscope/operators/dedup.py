"""Keep-first de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str = "listing_seq") -> DataFrame:
    """Keep the row with the smallest ``order_col`` per ``keys``; nulls in
    the key compare equal (pandas ``drop_duplicates(keep='first')``).

    Plan: ``row_number() ... = 1`` is rewritten by Catalyst into a partial
    ``WindowGroupLimit`` *before* the shuffle, so each map task forwards at
    most one row per key -- a key holding a third of all rows costs one row
    per task, not a third of the data in one task.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(order_col).asc())
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
