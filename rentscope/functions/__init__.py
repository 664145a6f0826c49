"""Column builders (native Spark expressions, no Python UDFs)."""

from rentscope.functions.text import (  # noqa: F401
    bathrooms_from_title, bedrooms_from_title, city_of, clean_location,
    parse_price, strip_ws, title_case,
)
from rentscope.functions.pricing import (  # noqa: F401
    PRICE_BANDS, band_id, price_per_bedroom, price_tier, price_vs_avg,
    property_label,
)
from rentscope.functions.formatting import money, snapshot_stamp, wall_clock_now  # noqa: F401
