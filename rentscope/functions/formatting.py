"""Display and timestamp helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x) -> Column:
    """``1500.4`` -> ``'$1,500'`` (thousands separators, no decimals)."""
    return F.concat(F.lit("$"), F.format_number(_c(x), 0))


def snapshot_stamp(ts) -> Column:
    """Snapshot name stamp ``yyyyMMdd_HHmmss``."""
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def wall_clock_now() -> Column:
    """Local wall-clock time without zone (what a scrape records)."""
    return F.localtimestamp()
