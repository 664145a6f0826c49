"""Raw listings derived from the driver's order tables.

``orders ⋈ customer ⋈ nation`` is turned into listing snapshots whose
titles, prices and locations exercise every parsing rule; a quarter of the
orders are re-posted a day later so keep-first dedup has work to do.

Scale notes: nation is a fixed 25-row table (broadcast is safe); customer
grows with the data, so orders ⋈ customer is left to the planner (sort-merge
with AQE skew splitting on a hot ``o_custkey``).  The re-posts are produced
by ``inline`` over a one- or two-element array -- one scan, no union, no
second evaluation of the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.functions.text import parse_price
from rentscope.session import spread

# Title by o_orderkey % 12, location by o_custkey % 10.
TITLES = [
    "2 bed 2 bath apartment",
    "Nice 1br apartment",
    "3 bedroom house",
    "Studio apartment downtown",
    "Great location near park",
    "1bd 1ba near downtown",
    None,
    "12 BR 2.5 bath",
    "studio loft 1 bath",
    "4BED/3BTH",
    "2 brand new units",
    "2 bedroom studio",
]
# Re-posted listings get this offset on their sequence number.  It stays
# above every TPC-H order key up to SF 100,000 (max key ~6e11).
REPOST_SEQ_OFFSET = 10 ** 12


def _pick(key, options):
    """``options[key]`` as a CASE chain (options are texts or Columns)."""
    out = None
    for i, v in enumerate(options):
        val = v if isinstance(v, Column) else F.lit(v).cast("string")
        out = F.when(key == i, val) if out is None else out.when(key == i, val)
    return out


def derive_raw_listings(orders: DataFrame, customer: DataFrame,
                        nation: DataFrame) -> DataFrame:
    o = spread(orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), "o_orderkey")
    c = customer.select("c_custkey", "c_nationkey")
    n = F.broadcast(nation.select("n_nationkey", "n_name"))  # 25 rows, fixed
    base = (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey")))

    k = F.col("o_orderkey")
    divisor = F.when(k % 7 < 2, F.lit(45)).otherwise(F.lit(200))
    p = F.floor(F.col("o_totalprice") / divisor).cast("bigint")
    money = (F.when(p >= 1000, F.concat(F.lit("$"), (p / 1000).cast("bigint").cast("string"), F.lit(","),
                                        F.lpad((p % 1000).cast("string"), 3, "0")))
             .otherwise(F.concat(F.lit("$"), p.cast("string"))))
    km = k % 50
    price_raw = (F.when(km == 0, F.lit(None).cast("string"))
                 .when(km == 1, F.lit("free"))
                 .when(km == 2, F.lit("$1,500.50"))
                 .otherwise(money))
    nm = F.col("n_name")
    location = _pick(F.col("o_custkey") % 10, [
        F.concat(nm, F.lit(", TX 75201")),
        F.lit("Fort Worth, TX"),
        F.lit("DALLAS"),
        F.lit(None).cast("string"),
        F.lit(", TX"),
        F.concat(F.lit("3701 n o'connor rd, "), nm),
        F.lit("euless/bedford"),
        F.lit("Galleria ATX"),
        F.lit("dallas, tx"),
        F.concat(F.lit("  "), nm, F.lit("  ")),
    ])
    link = F.concat(F.lit("https://listings.test/"), k.cast("string"))
    ts = F.col("o_orderdate").cast("timestamp_ntz")

    first = F.struct(k.alias("listing_seq"), link.alias("link"), ts.alias("scraped_at"))
    repost = F.struct((k + REPOST_SEQ_OFFSET).alias("listing_seq"),
                      F.concat(link, F.lit("/repost")).alias("link"),
                      (ts + F.expr("INTERVAL 1 DAY")).alias("scraped_at"))
    posts = F.when(k % 4 == 0, F.array(first, repost)).otherwise(F.array(first))

    return (base.select(
                _pick(k % 12, TITLES).alias("title"),
                price_raw.alias("price_raw"),
                location.alias("location"),
                F.inline(posts))
            .select("listing_seq", "title",
                    parse_price("price_raw").alias("price"),
                    "price_raw", "location", "link", "scraped_at",
                    F.lit("feed").alias("source")))


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listings (schema ``RAW_LISTINGS``) derived from ``sf_dir``."""
    rd = spark.read.parquet
    return derive_raw_listings(rd(f"{sf_dir}/orders.parquet"),
                               rd(f"{sf_dir}/customer.parquet"),
                               rd(f"{sf_dir}/nation.parquet"))


# --- listing pages rendered from the derived listings ---

LISTINGS_PER_PAGE = 120  # what one result page of the listing site holds


def _escape(c):
    """HTML-escape text (``&`` first; the apostrophe as a numeric reference)."""
    for ch, ent in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(ch), F.lit(ent))
    return c


def _div(cls, text):
    return F.when(text.isNotNull(), F.concat(F.lit(f'<div class="{cls}"> '), _escape(text), F.lit(" </div>")))


def _span(cls, text):
    return F.when(text.isNotNull(), F.concat(F.lit(f'<span class="{cls}">'), _escape(text), F.lit("</span>")))


def render_listing_pages(raw: DataFrame, per_page: int = LISTINGS_PER_PAGE) -> DataFrame:
    """Raw listings -> ``pages(page_id, url, html)`` in the listing-site
    markup: page ``listing_seq div per_page`` holds at most ``per_page``
    listings in sequence order; every fifth page uses the older
    ``div.result-info`` layout, with nested ``div`` fields for every other
    listing.  Every third ``li`` has no end tag, and every seventh listing is
    followed by one that is commented out.  A missing field is left out.

    Each page collects at most ``per_page`` blocks (a bounded group); the
    block markup is built per row before the shuffle."""
    page = F.floor(F.col("listing_seq") / per_page).cast("bigint")
    link = _escape(F.col("link"))
    primary = F.concat(
        F.lit('<li class="cl-static-search-result"><a href="'), link, F.lit('">'),
        F.coalesce(_div("title", F.col("title")), F.lit("")),
        F.lit('<div class="details">'),
        F.coalesce(_div("price", F.col("price_raw")), F.lit("")),
        F.coalesce(_div("location", F.col("location")), F.lit("")),
        F.lit("</div></a>"), F.when(F.col("listing_seq") % 3 == 0, "").otherwise("</li>"))
    fallback = F.concat(
        F.lit('<div class="result-info">'),
        F.when(F.col("title").isNotNull(),
               F.concat(F.lit('<a class="titlestring" href="'), link, F.lit('">'),
                        _escape(F.col("title")), F.lit("</a>")))
         .otherwise(F.concat(F.lit('<a href="'), link, F.lit('">link</a>'))),
        F.coalesce(_span("priceinfo", F.col("price_raw")), F.lit("")),
        F.coalesce(_span("meta", F.col("location")), F.lit("")),
        F.lit("</div>"))
    nested = F.concat(
        F.lit('<div class="result-info"><div class="head">'),
        F.coalesce(_div("title", F.col("title")), F.lit("")),
        F.lit("</div>"),
        F.coalesce(_div("price", F.col("price_raw")), F.lit("")),
        F.coalesce(_div("location", F.col("location")), F.lit("")),
        F.lit('<div><a href="'), link, F.lit('">link</a></div></div>'))
    older = F.when(F.col("listing_seq") % 2 == 0, nested).otherwise(fallback)
    hidden = F.lit('<!-- <li class="cl-static-search-result"><div class="title">gone</div></li> -->')
    blocks = raw.select(page.alias("page_id"), "listing_seq",
                        F.concat(F.when(page % 5 == 0, older).otherwise(primary),
                                 F.when(F.col("listing_seq") % 7 == 0, hidden).otherwise("")).alias("block"))
    body = (blocks.groupBy("page_id")
                  .agg(F.array_sort(F.collect_list(F.struct("listing_seq", "block"))).alias("_b")))
    return body.select(
        "page_id",
        F.concat(F.lit("https://listings.test/search?page="), F.col("page_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><body><ul>"), F.array_join(F.col("_b.block"), ""),
                 F.lit("</ul></body></html>")).alias("html"))
