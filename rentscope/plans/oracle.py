"""Oracle SQL (DuckDB dialect) for the query catalogue.

Each statement is self-contained: it re-derives the listings fixture from
the driver tables with a chain of CTEs and then computes the query the
independent way (window functions, correlated lookups, plain GROUP BY),
so the Spark formulation is checked against a straightforward one."""

from __future__ import annotations

from rentscope.sources.fixture import REPOST_SEQ_OFFSET, TITLES


def _sql_lit(v):
    return "NULL" if v is None else "'" + v.replace("'", "''") + "'"


_TITLE_CASE = " ".join(f"WHEN {i} THEN {_sql_lit(t)}" for i, t in enumerate(TITLES))
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def title_case_sql(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(lower({x}), "
            f"'[{_CASED}]+|[^{_CASED}]+'), lambda p: upper(p[1]) || p[2:]), '')")


RAW = f"""
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderdate AS od, n.n_name AS nm,
         CAST(floor(o.o_totalprice / (CASE WHEN o.o_orderkey % 7 < 2 THEN 45 ELSE 200 END)) AS BIGINT) AS p
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey),
shaped AS (
  SELECT k,
    CASE k % 12 {_TITLE_CASE} END AS title,
    CASE WHEN k % 50 = 0 THEN NULL WHEN k % 50 = 1 THEN 'free' WHEN k % 50 = 2 THEN '$1,500.50'
         WHEN p >= 1000 THEN '$' || CAST(p // 1000 AS VARCHAR) || ',' || lpad(CAST(p % 1000 AS VARCHAR), 3, '0')
         ELSE '$' || CAST(p AS VARCHAR) END AS price_raw,
    CASE ck % 10 WHEN 0 THEN nm || ', TX 75201' WHEN 1 THEN 'Fort Worth, TX' WHEN 2 THEN 'DALLAS'
         WHEN 3 THEN NULL WHEN 4 THEN ', TX' WHEN 5 THEN '3701 n o''connor rd, ' || nm
         WHEN 6 THEN 'euless/bedford' WHEN 7 THEN 'Galleria ATX' WHEN 8 THEN 'dallas, tx'
         WHEN 9 THEN '  ' || nm || '  ' END AS location,
    'https://listings.test/' || CAST(k AS VARCHAR) AS link,
    CAST(od AS TIMESTAMP) AS scraped_at
  FROM base),
posts AS (
  SELECT k AS listing_seq, title, price_raw, location, link, scraped_at FROM shaped
  UNION ALL
  SELECT k + {REPOST_SEQ_OFFSET}, title, price_raw, location, link || '/repost', scraped_at + INTERVAL 1 DAY
  FROM shaped WHERE k % 4 = 0),
priced AS (
  SELECT *, trim(replace(replace(price_raw, '$', ''), ',', '')) AS _pt FROM posts),
raw_listings AS (
  SELECT listing_seq, title,
    CASE WHEN regexp_full_match(_pt, '[+-]?[0-9]+(_[0-9]+)*') THEN TRY_CAST(replace(_pt, '_', '') AS BIGINT) END AS price,
    price_raw, location, link, scraped_at, 'feed' AS source
  FROM priced)"""

ROOMS = """
  coalesce(TRY_CAST(NULLIF(regexp_extract(lower(title), '(\\d)\\s*(bed|bd|br|bedroom)', 1), '') AS INTEGER),
           CASE WHEN contains(lower(title), 'studio') THEN 0 END) AS bedrooms,
  TRY_CAST(NULLIF(regexp_extract(lower(title), '(\\d)\\s*(bath|ba|bth|bathroom)', 1), '') AS INTEGER) AS bathrooms"""

_LOC_STRIPPED = ("trim(regexp_replace(regexp_replace(location, '^\\s+|\\s+$', '', 'g'), "
                 "',?\\s*TX\\s*\\d*$', ''), ', ')")

CLEAN_LOCATION = (f"CASE WHEN location IS NULL OR {_LOC_STRIPPED} = '' THEN 'Unknown' "
                  f"ELSE {title_case_sql(_LOC_STRIPPED)} END")


def tier_sql(x: str, null_label: str | None) -> str:
    head = f"WHEN {x} IS NULL THEN '{null_label}' " if null_label else ""
    return (f"CASE {head}WHEN {x} < 800 THEN 'Budget' WHEN {x} < 1200 THEN 'Mid-Range' "
            f"WHEN {x} < 2000 THEN 'Premium' ELSE 'Luxury' END")


CLEAN = RAW + f""",
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY title, price, location ORDER BY listing_seq) AS rn
    FROM raw_listings) WHERE rn = 1),
derived AS (
  SELECT *, {ROOMS},
    {CLEAN_LOCATION} AS clean_location,
    {tier_sql('price', 'Unknown')} AS price_category
  FROM dedup),
clean AS (
  SELECT *, CASE WHEN bedrooms > 0 THEN round_even(CAST(price AS DOUBLE) / bedrooms, 0) END AS price_per_bedroom
  FROM derived WHERE price BETWEEN 200 AND 10000)"""

ENRICHED = CLEAN + f""",
enriched AS (
  SELECT *,
    rank() OVER (PARTITION BY clean_location ORDER BY price ASC NULLS FIRST) AS price_rank_in_location,
    count(*) OVER (PARTITION BY clean_location) AS listings_in_location,
    {tier_sql('price', None)} AS price_segment
  FROM clean)"""

_BANDS = "(VALUES (1, 'Budget', 0, 799), (2, 'Mid-Range', 800, 1199), (3, 'Premium', 1200, 1999), (4, 'Luxury', 2000, 10000))"

STAR = CLEAN + f""",
dim_location AS (
  SELECT row_number() OVER (ORDER BY first_seq) AS location_id, location AS raw_location, clean_location,
         coalesce(trim(split_part(clean_location, ',', 1)), 'Unknown') AS city, 'TX' AS state
  FROM (SELECT location, clean_location, min(listing_seq) AS first_seq FROM clean GROUP BY location, clean_location)),
dim_property_type AS (
  SELECT row_number() OVER (ORDER BY first_seq) AS property_type_id, bedrooms, bathrooms,
    CASE WHEN bedrooms = 0 THEN 'Studio'
         WHEN bedrooms IS NOT NULL AND bathrooms IS NOT NULL THEN CAST(bedrooms AS VARCHAR) || 'BR/' || CAST(bathrooms AS VARCHAR) || 'BA'
         WHEN bedrooms IS NOT NULL THEN CAST(bedrooms AS VARCHAR) || 'BR' ELSE 'Unknown' END AS property_label
  FROM (SELECT bedrooms, bathrooms, min(listing_seq) AS first_seq FROM clean GROUP BY bedrooms, bathrooms)),
dim_price_category AS (
  SELECT CAST(col0 AS BIGINT) AS price_category_id, col1 AS category_name,
         CAST(col2 AS INTEGER) AS min_price, CAST(col3 AS INTEGER) AS max_price FROM {_BANDS}),
fact_listings AS (
  SELECT c.listing_seq AS listing_id, c.title, c.price, c.price_raw,
    (SELECT min(l.location_id) FROM dim_location l WHERE l.raw_location = c.location) AS location_id,
    (SELECT min(t.property_type_id) FROM dim_property_type t
      WHERE t.bedrooms IS NOT DISTINCT FROM c.bedrooms AND t.bathrooms IS NOT DISTINCT FROM c.bathrooms) AS property_type_id,
    (SELECT min(b.price_category_id) FROM dim_price_category b
      WHERE c.price >= b.min_price AND c.price <= b.max_price) AS price_category_id,
    c.price_per_bedroom, c.link, c.source, c.scraped_at
  FROM clean c)"""


def w(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body}"


ORACLE = {
    "raw_listings": w(RAW, "SELECT * FROM raw_listings"),
    "parse_price": w(RAW, "SELECT listing_seq, price_raw, price FROM raw_listings"),
    "dedup_first": w(CLEAN, "SELECT * FROM dedup"),
    "extract_rooms": w(RAW, f"SELECT listing_seq, title, {ROOMS} FROM raw_listings"),
    "standardize_location": w(RAW, f"""
        SELECT listing_seq, location, clean_location,
               coalesce(trim(split_part(clean_location, ',', 1)), 'Unknown') AS city
        FROM (SELECT listing_seq, location, {CLEAN_LOCATION} AS clean_location FROM raw_listings)"""),
    "price_category": w(RAW, f"""
        SELECT listing_seq, price, {tier_sql('price', 'Unknown')} AS price_category,
               {tier_sql('price', None)} AS price_segment FROM raw_listings"""),
    "clean_listings": w(CLEAN, "SELECT * FROM clean"),
    "clean_report": w(CLEAN + """,
        m AS (
          SELECT 'raw_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM raw_listings
          UNION ALL SELECT 'raw_locations', CAST(count(DISTINCT location) AS DOUBLE) FROM raw_listings
          UNION ALL SELECT 'deduped_rows', CAST(count(*) AS DOUBLE) FROM dedup
          UNION ALL SELECT 'outliers_removed', CAST(count(*) FILTER (WHERE NOT coalesce(price BETWEEN 200 AND 10000, false)) AS DOUBLE) FROM dedup
          UNION ALL SELECT 'clean_rows', CAST(count(*) AS DOUBLE) FROM clean
          UNION ALL SELECT 'bedrooms_found', CAST(count(bedrooms) AS DOUBLE) FROM derived
          UNION ALL SELECT 'bathrooms_found', CAST(count(bathrooms) AS DOUBLE) FROM derived
          UNION ALL SELECT 'clean_locations', CAST(count(DISTINCT clean_location) AS DOUBLE) FROM derived
          UNION ALL SELECT 'price_min', CAST(min(price) AS DOUBLE) FROM clean
          UNION ALL SELECT 'price_max', CAST(max(price) AS DOUBLE) FROM clean
          UNION ALL SELECT 'price_mean', round(avg(price), 2) FROM clean)""", """
        SELECT * FROM m
        UNION ALL SELECT 'duplicates_removed',
          (SELECT value FROM m WHERE metric = 'raw_rows') - (SELECT value FROM m WHERE metric = 'deduped_rows')"""),
    "scrape_summary": w(RAW, """
        SELECT 'total_listings' AS metric, CAST(count(*) AS VARCHAR) AS value FROM raw_listings
        UNION ALL SELECT 'price_min', '$' || format('{:,.0f}', CAST(min(price) AS DOUBLE)) FROM raw_listings
        UNION ALL SELECT 'price_max', '$' || format('{:,.0f}', CAST(max(price) AS DOUBLE)) FROM raw_listings
        UNION ALL SELECT 'price_mean', '$' || format('{:,.0f}', avg(price)) FROM raw_listings
        UNION ALL SELECT 'unique_locations', CAST(count(DISTINCT location) AS VARCHAR) FROM raw_listings"""),
    "rank_by_location": w(ENRICHED, """
        SELECT listing_seq, clean_location, price, price_rank_in_location, listings_in_location FROM enriched"""),
    "location_stats": w(CLEAN, """
        SELECT clean_location, count(*) AS total_listings, round(avg(price), 0) AS avg_price,
               min(price) AS min_price, max(price) AS max_price,
               round(stddev_samp(price), 0) AS price_stddev, round(avg(bedrooms), 1) AS avg_bedrooms
        FROM clean GROUP BY clean_location"""),
    "segment_summary": w(ENRICHED, """
        SELECT price_segment, count(*) AS count, round(avg(price), 0) AS avg_price,
               round(avg(bedrooms), 1) AS avg_bedrooms
        FROM enriched GROUP BY price_segment"""),
    "avg_by_bedrooms": w(CLEAN, "SELECT bedrooms, avg(price) AS avg_price_for_beds FROM clean GROUP BY bedrooms"),
    "best_deals": w(CLEAN, """
        SELECT c.title, c.price, c.bedrooms, c.clean_location,
               round(c.price - a.avg_price_for_beds, 0) AS price_vs_avg
        FROM clean c LEFT JOIN (SELECT bedrooms, avg(price) AS avg_price_for_beds FROM clean GROUP BY bedrooms) a
          ON c.bedrooms = a.bedrooms
        WHERE round(c.price - a.avg_price_for_beds, 0) < 0"""),
    "deals_context": w(CLEAN, """
        SELECT c.listing_seq, c.bedrooms, c.price, a.avg_price_for_beds,
               round(c.price - a.avg_price_for_beds, 0) AS price_vs_avg
        FROM clean c LEFT JOIN (SELECT bedrooms, avg(price) AS avg_price_for_beds FROM clean GROUP BY bedrooms) a
          ON c.bedrooms = a.bedrooms"""),
    "enriched_listings": w(ENRICHED, "SELECT * FROM enriched"),
    "category_mean": w(CLEAN, """
        SELECT price_category, count(*) AS listings, round_even(avg(price), 0) AS mean_price
        FROM clean GROUP BY price_category"""),
    "dim_location": w(STAR, "SELECT * FROM dim_location"),
    "dim_property_type": w(STAR, "SELECT * FROM dim_property_type"),
    "dim_price_category": w(STAR, """
        SELECT b.*, (SELECT count(*) FROM clean WHERE price BETWEEN b.min_price AND b.max_price) AS listings,
               (SELECT min(price) FROM clean WHERE price BETWEEN b.min_price AND b.max_price) AS lowest,
               (SELECT max(price) FROM clean WHERE price BETWEEN b.min_price AND b.max_price) AS highest
        FROM dim_price_category b WHERE listings > 0"""),
    "fact_listings": w(STAR, "SELECT * FROM fact_listings"),
    # listings of a null location have no dimension row to match, so they are in no group
    "rent_by_location": w(CLEAN, """
        SELECT DISTINCT clean_location, n AS listing_count, round(mean, 0) AS avg_rent, lo AS min_rent, hi AS max_rent
        FROM (SELECT clean_location, count(*) OVER place AS n, avg(price) OVER place AS mean,
                     min(price) OVER place AS lo, max(price) OVER place AS hi
              FROM clean WHERE location IS NOT NULL WINDOW place AS (PARTITION BY clean_location))
        WHERE n > 2"""),
    "rent_by_type": w(CLEAN, """
        , labelled AS (
          SELECT bedrooms, price, CASE WHEN bedrooms IS NULL THEN 'Unknown' WHEN bedrooms = 0 THEN 'Studio'
                 ELSE concat_ws('/', bedrooms::VARCHAR || 'BR', bathrooms::VARCHAR || 'BA') END AS property_label FROM clean)
        SELECT property_label, bedrooms, sum(1)::BIGINT AS listing_count,
               round(sum(price)::DOUBLE / sum(1), 0) AS avg_rent FROM labelled GROUP BY ALL"""),
    "price_distribution": w(CLEAN, f"""
        SELECT col1 AS category_name, col2::INTEGER AS min_price, col3::INTEGER AS max_price, n AS listing_count,
               round(100.0::DOUBLE * n / total, 1) AS percentage
        FROM (SELECT b.*, (SELECT count(*) FROM clean WHERE price BETWEEN col2 AND col3) AS n,
                     (SELECT count(*) FROM clean) AS total FROM {_BANDS} b) WHERE n > 0"""),
    "cheapest_two_bed": w(CLEAN, """
        SELECT title, price, clean_location, listing_seq AS listing_id
        FROM (SELECT *, row_number() OVER (ORDER BY price, listing_seq) AS place
              FROM clean WHERE bedrooms = 2 AND location IS NOT NULL) WHERE place <= 5"""),
    "top_locations": w(CLEAN, """
        , places AS (SELECT clean_location, count(*) AS listing_count, round(avg(price), 0) AS avg_rent,
                            min(price) AS min_rent, max(price) AS max_rent
                     FROM clean WHERE location IS NOT NULL GROUP BY 1),
        placed AS (SELECT *, row_number() OVER (ORDER BY avg_rent DESC, clean_location) AS place
                   FROM places WHERE listing_count > 2)
        SELECT * EXCLUDE (place) FROM placed WHERE place <= 10"""),
    "listing_pages_roundtrip": w(RAW, """
        SELECT listing_seq // 120 AS page_id,
               CAST(row_number() OVER (PARTITION BY listing_seq // 120 ORDER BY listing_seq) - 1 AS INTEGER) AS pos,
               trim(title) AS title, price, trim(price_raw) AS price_raw, trim(location) AS location, link
        FROM raw_listings"""),
    "csv_roundtrip": w(RAW, "SELECT * FROM raw_listings"),
    "latest_snapshot": w(RAW, """
        SELECT *, strftime(date_trunc('year', scraped_at), '%Y%m%d_%H%M%S') AS snapshot_ts
        FROM raw_listings
        WHERE date_trunc('year', scraped_at) = (SELECT max(date_trunc('year', scraped_at)) FROM raw_listings)"""),
    "latest_named_csv": w(RAW, "SELECT * FROM raw_listings"),
    "zone_publish": w(ENRICHED, """
        SELECT 'raw' AS zone, 'listings' AS dataset, count(*) AS rows, 8 AS columns FROM raw_listings
        UNION ALL SELECT 'clean', 'listings_clean', count(*), 13 FROM clean
        UNION ALL SELECT 'clean', 'listings_enriched', count(*), 16 FROM enriched
        UNION ALL SELECT 'clean', 'location_stats', count(DISTINCT clean_location), 7 FROM clean"""),
    "snapshot_stream_clean": w(RAW + f""",
        snap AS (SELECT *, strftime(date_trunc('year', scraped_at), '%Y%m%d_%H%M%S') AS snapshot_ts FROM raw_listings),
        dedup AS (
          SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY snapshot_ts, title, price, location ORDER BY listing_seq) AS rn
            FROM snap) WHERE rn = 1),
        derived AS (
          SELECT *, {ROOMS}, {CLEAN_LOCATION} AS clean_location, {tier_sql('price', 'Unknown')} AS price_category
          FROM dedup)""", """
        SELECT * EXCLUDE (snapshot_ts),
               CASE WHEN bedrooms > 0 THEN round_even(CAST(price AS DOUBLE) / bedrooms, 0) END AS price_per_bedroom,
               snapshot_ts
        FROM derived WHERE price BETWEEN 200 AND 10000"""),
    "quality_report": w(ENRICHED, """
        SELECT 'clean_non_empty' AS "check", count(*) > 0 AS passed, count(*) AS observed FROM clean
        UNION ALL SELECT 'clean_no_null_price', count(*) FILTER (WHERE price IS NULL) = 0,
                         count(*) FILTER (WHERE price IS NULL) FROM clean
        UNION ALL SELECT 'clean_price_in_range', count(*) FILTER (WHERE price < 100 OR price > 20000) = 0,
                         count(*) FILTER (WHERE price < 100 OR price > 20000) FROM clean
        UNION ALL SELECT 'fact_non_empty', count(*) > 0, count(*) FROM clean
        UNION ALL SELECT 'enriched_non_empty', count(*) > 0, count(*) FROM enriched
        UNION ALL SELECT 'clean_required_columns', count(*) = 0, count(*) FROM unnest(
          ['title', 'price', 'location', 'link', 'bedrooms', 'bathrooms', 'clean_location', 'price_category', 'source']) AS r(c)
          WHERE c NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM clean))"""),
    "category_counts": w(CLEAN, "SELECT price_category, count(*) AS listings FROM derived GROUP BY price_category"),
}


# --- page records: this module's own reading of well-formed pages (DuckDB/RE2 has no lookaround) ---

# The named references that occur in the driver's pages.
_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", " "),
               ("&copy;", "©"), ("&middot;", "·"), ("&ndash;", "–"), ("&mdash;", "—"),
               ("&rsquo;", "’"), ("&hellip;", "…"), ("&euro;", "€"), ("&amp;", "&")]


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _decoded(x: str) -> str:
    for i in range(32, 127):  # printable numeric references
        if not chr(i).isalnum():
            x = f"replace({x}, '&#{i};', {_quoted(chr(i))})"
    for name, ch in _REFERENCES:
        x = f"replace({x}, '{name}', {_quoted(ch)})"
    return x


LINK_RECORDS = f"""
WITH clean AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'),
                      '(?is)<(script|style)[^>]*>.*?</(script|style)>', '', 'g') AS html FROM pages),
items AS (SELECT page_id, regexp_extract_all(html, '(?is)<li(?:[\\s][^>]*)?>(.*?)</li\\s*>', 1) AS found FROM clean),
item AS (SELECT page_id, unnest(found) AS li, unnest(generate_series(0, len(found) - 1)) AS pos FROM items),
anchor AS (SELECT *, regexp_extract(li, '(?is)<a(?:\\s[^>]*)?>(.*?)</a\\s*>', 1) AS inner_html,
                  regexp_matches(li, '(?is)<a(?:\\s[^>]*)?>') AS any_a,
                  regexp_extract(li, '(?is)<a\\s(?:[^>]*\\s)?href\\s*=\\s*"([^"]*)"', 1) AS href,
                  regexp_matches(li, '(?is)<a\\s(?:[^>]*\\s)?href\\s*=') AS any_href FROM item)
SELECT page_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN any_a THEN array_to_string(list_filter(list_transform(
            regexp_split_to_array(inner_html, '<[^>]*>'), lambda p: trim({_decoded('p')}, ' \t\n')), lambda p: p <> ''), '') END AS title,
       CAST(NULL AS BIGINT) AS price, CAST(NULL AS VARCHAR) AS price_raw, CAST(NULL AS VARCHAR) AS location,
       CASE WHEN any_href THEN {_decoded('href')} END AS link
FROM anchor"""

ORACLE["extract_link_records"] = LINK_RECORDS
# no driver page carries the listing site's classes
ORACLE["extract_page_records"] = f"""
SELECT l.* FROM ({LINK_RECORDS}) l JOIN pages p USING (page_id)
WHERE contains(p.html, 'cl-static-search-result') OR contains(p.html, 'result-info')"""

ORACLE["pages_to_listings"] = f"""
SELECT row_number() OVER (ORDER BY page_id, pos) AS listing_seq, title, price, price_raw, location, link, 'web' AS source
FROM ({LINK_RECORDS})"""
ORACLE["csv_two_headers"] = ORACLE["raw_listings"]
ORACLE["published_snapshots"] = w(RAW, """
        SELECT *, strftime(date_trunc('year', scraped_at), '%Y%m%d_%H%M%S') AS snapshot_ts FROM raw_listings""")
ORACLE["appended_facts"] = w(STAR, """
        SELECT * FROM fact_listings
        UNION ALL SELECT * REPLACE (listing_id + (SELECT max(listing_id) + 1 FROM fact_listings) AS listing_id) FROM fact_listings""")
ORACLE["sql_views"] = f"""
SELECT 'location' AS view, clean_location AS name, listing_count, avg_rent AS value FROM ({ORACLE['rent_by_location']})
UNION ALL SELECT 'type', property_label, listing_count, avg_rent FROM ({ORACLE['rent_by_type']})
UNION ALL SELECT 'band', category_name, listing_count, percentage FROM ({ORACLE['price_distribution']})"""
_NEWEST = ("FROM priced WHERE date_trunc('year', scraped_at) = "
           "(SELECT max(date_trunc('year', scraped_at)) FROM priced))")
ORACLE["whole_run"] = ORACLE["enriched_listings"].replace("FROM priced)", _NEWEST)
ORACLE["overlapping_bands"] = w(CLEAN, """
        SELECT c.listing_seq AS listing_id, c.price, min(b.listing_seq) AS price_category_id
        FROM clean c LEFT JOIN clean b
          ON c.price BETWEEN b.price - b.listing_seq % 40 AND b.price + b.listing_seq % 40
        GROUP BY c.listing_seq, c.price""")
ORACLE["observed_quality"] = ORACLE["quality_report"]
ORACLE["distinct_locations"] = w(RAW, """
        SELECT CAST(year(scraped_at) AS INTEGER) AS year, count(DISTINCT location) AS exact, true AS within
        FROM raw_listings GROUP BY 1
        UNION ALL SELECT NULL, count(DISTINCT location), true FROM raw_listings""")
ORACLE["records_frame"] = w(RAW, """
        SELECT *, CASE WHEN link LIKE '%/repost' THEN CAST(regexp_extract(link, '([0-9]+)/repost$', 1) AS BIGINT) END AS repost_of
        FROM raw_listings""")
ORACLE["scrape_stamps"] = f"""
        SELECT source, count(*) AS listings, true AS stamped_now FROM ({ORACLE['pages_to_listings']}) GROUP BY source"""
