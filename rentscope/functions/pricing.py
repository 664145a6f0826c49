"""Price tiers, per-bedroom prices, property labels, band lookups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier cut points (strictly below each bound) and labels.
TIER_CUTS = [(800, "Budget"), (1200, "Mid-Range"), (2000, "Premium")]
TOP_TIER = "Luxury"
# The price-category dimension (id, name, min, max), closed bands.
PRICE_BANDS = [
    (1, "Budget", 0, 799),
    (2, "Mid-Range", 800, 1199),
    (3, "Premium", 1200, 1999),
    (4, "Luxury", 2000, 10000),
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def price_tier(x, null_label: str | None = "Unknown") -> Column:
    """Budget < 800 <= Mid-Range < 1200 <= Premium < 2000 <= Luxury.

    ``null_label`` is what a null price gets.  The clean stage uses
    ``'Unknown'``; the segment stage has no null branch, so a null price
    falls through to ``Luxury`` (pass ``None``)."""
    p = _c(x)
    out = None
    if null_label is not None:
        out = F.when(p.isNull(), F.lit(null_label))
    for bound, label in TIER_CUTS:
        out = F.when(p < bound, F.lit(label)) if out is None else out.when(p < bound, F.lit(label))
    return out.otherwise(F.lit(TOP_TIER))


def price_per_bedroom(price, beds) -> Column:
    """Half-even rounded price / bedrooms when bedrooms > 0, else null."""
    b = _c(beds)
    return F.when(b > 0, F.bround(_c(price) / b, 0))


def price_vs_avg(price, avg) -> Column:
    """``round(price - avg, 0)``, half away from zero (so -0.4 -> 0)."""
    return F.round(_c(price) - _c(avg), 0)


def property_label(beds, baths) -> Column:
    """0 beds -> Studio; ``nBR/mBA``; ``nBR``; otherwise Unknown."""
    b, a = _c(beds), _c(baths)
    return (F.when(b == 0, F.lit("Studio"))
            .when(b.isNotNull() & a.isNotNull(),
                  F.concat(b.cast("string"), F.lit("BR/"), a.cast("string"), F.lit("BA")))
            .when(b.isNotNull(), F.concat(b.cast("string"), F.lit("BR")))
            .otherwise(F.lit("Unknown")))


def band_id(x, bands=PRICE_BANDS) -> Column:
    """Closed-range lookup ``min <= x <= max`` returning the *first* matching
    band id (the lowest id), null when none matches.

    The band table is a fixed handful of rows, so the range join becomes a
    CASE chain evaluated per row: no join, no fan-out, no shuffle."""
    v = _c(x)
    out = None
    for bid, _name, lo, hi in sorted(bands):
        cond = (v >= lo) & (v <= hi)
        out = F.when(cond, F.lit(bid)) if out is None else out.when(cond, F.lit(bid))
    return out.cast("bigint")
