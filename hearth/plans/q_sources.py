"""Queries for sources, standardisation and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import macro as M
from ..operators import standardise as S
from ..sources import fixtures as fx
from ..sources import listings as L
from ..sources.fixture_sql import CITY_INDEX_LABELS
from ..sources.schemas import RAW_HEADER
from . import sqlbits as Q
from .common import ENTITY, enriched, named_series, r6
from .registry import register

MACRO = ["real_price_yoy", "real_price_idx", "nom_price_yoy", "nom_price_idx"]

_RENAMED = ", ".join(f'"{raw}" AS "{new}"' for raw, new in RAW_HEADER if new != "date_serial")


@register("src_listings", "A1", "B4", "B5", "B7", "B8", sql=f"""
SELECT {_RENAMED}, DATE '1899-12-30' + "Date" AS "date",
       CAST(year(DATE '1899-12-30' + "Date") AS INTEGER) AS sale_year,
       CAST(month(DATE '1899-12-30' + "Date") AS INTEGER) AS sale_month,
       'india' AS market_region
FROM listings_raw
""")
def q_src_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Raw listing header renamed; Excel day → date, year, month; region tag."""
    return L.listings_from(fx.listings_raw(spark, sf))


@register("src_second_market", "A2", "B6", "B9", sql="""
SELECT id, bedrooms, bathrooms, sqft_living, sqft_lot, floors, "view", grade, sqft_above,
       sqft_basement, yr_built, yr_renovated, zipcode, lat, long, sqft_living15, sqft_lot15, price,
       CASE waterfront WHEN 'N' THEN 0 WHEN 'Y' THEN 1 ELSE 0 END AS waterfront,
       CASE "condition" WHEN 'Poor' THEN 1 WHEN 'Fair' THEN 2 WHEN 'Average' THEN 3
            WHEN 'Good' THEN 4 WHEN 'Very Good' THEN 5 ELSE 3 END AS "condition",
       try_strptime("date", '%Y%m%dT%H%M%S') AS "date",
       CAST(year(try_strptime("date", '%Y%m%dT%H%M%S')) AS INTEGER) AS sale_year,
       CAST(month(try_strptime("date", '%Y%m%dT%H%M%S')) AS INTEGER) AS sale_month,
       2 AS schools_nearby, 35.0e0 AS airport_distance_km, 'us_kc' AS market_region
FROM second_market_raw
""")
def q_src_second_market(spark: SparkSession, sf: str) -> DataFrame:
    """Second market: Y/N and condition words to codes, compact timestamps, stub columns."""
    return L.second_market_from(fx.second_market_raw(spark, sf))


@register("src_series", "A3", sql="""
SELECT country_code, TRY_CAST(CAST("date" AS VARCHAR) AS DATE) AS "date", round(price, 6) AS price
FROM series
""")
def q_src_series(spark: SparkSession, sf: str) -> DataFrame:
    """Country series as text (dates as text) parsed back to (code, date, price)."""
    s = L.series_from(fx.series_text(spark, sf))
    return s.select("country_code", "date", r6("price"))


_TRIMMED = ", ".join(f'round("{c}", 6) AS "{c.strip()}"' for c in CITY_INDEX_LABELS)


@register("src_city_index", "A4", sql=f"""
SELECT "Particulars", {_TRIMMED} FROM city_index_wide
""")
def q_src_city_index(spark: SparkSession, sf: str) -> DataFrame:
    """Wide city index with header names trimmed."""
    w = L.city_index_from(fx.city_index_wide(spark, sf))
    return w.select("Particulars", *[r6(f"`{c}`", c) for c in w.columns if c != "Particulars"])


@register("enriched_listings", "A8", "J1", "C1", "C4", "W3", sql=f"""
WITH my AS (SELECT sale_year AS y FROM properties GROUP BY sale_year
            ORDER BY count(*) DESC, sale_year ASC LIMIT 1),
     m AS (SELECT * FROM ({Q.MACRO_BY_YEAR}) t WHERE sale_year = (SELECT y FROM my)),
     h AS ({Q.LATEST_HPI})
SELECT p.id, p.sale_year,
       round((SELECT max(real_price_yoy) FROM m), 6) AS real_price_yoy,
       round((SELECT max(real_price_idx) FROM m), 6) AS real_price_idx,
       round((SELECT max(nom_price_yoy) FROM m), 6) AS nom_price_yoy,
       round((SELECT max(nom_price_idx) FROM m), 6) AS nom_price_idx,
       round((SELECT latest_hpi FROM h), 6) AS latest_hpi
FROM properties p
""")
def q_enriched_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Listings + macro values of the modal sale year + latest city index, as scalars."""
    from ..operators.aggregates import mode_of
    p = fx.properties(spark, sf)
    year = mode_of(p, "sale_year").select("sale_year").scalar()
    by_year = M.macro_by_year(named_series(spark, sf), ENTITY)
    one = by_year.where(F.col("sale_year") == year).agg(*[F.max(c).alias(c) for c in MACRO])
    e = M.enrich_scalar(p.select("id", "sale_year"), one)
    e = M.enrich_scalar(e, M.latest_hpi(fx.city_index_wide(spark, sf), "INDIA"))
    return e.select("id", "sale_year", *[r6(c) for c in MACRO], r6("latest_hpi"))


@register("enriched_by_year", "J1b", sql=f"""
SELECT id, sale_year, round(real_price_yoy, 6) AS real_price_yoy, round(real_price_idx, 6) AS real_price_idx,
       round(nom_price_yoy, 6) AS nom_price_yoy, round(nom_price_idx, 6) AS nom_price_idx,
       round(latest_hpi, 6) AS latest_hpi
FROM ({Q.ENRICHED}) e
""")
def q_enriched_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """Listings + macro values of their own sale year (broadcast year table) + latest index."""
    e = enriched(spark, sf)
    return e.select("id", "sale_year", *[r6(c) for c in MACRO], r6("latest_hpi"))


_NORMED = ", ".join(f'"{raw}" AS "{raw.strip().lower().replace(" ", "_")}"' for raw, _ in RAW_HEADER)


@register("clean_names", "B1", sql=f"SELECT {_NORMED} FROM listings_raw")
def q_clean_names(spark: SparkSession, sf: str) -> DataFrame:
    """Column names stripped, lower-cased, spaces to underscores."""
    return S.normalise_names(fx.listings_raw(spark, sf))


@register("clean_trim", "B2", sql="""
SELECT id, trim(priority) AS priority, trim(waterfront) AS waterfront, trim("condition") AS "condition",
       trim("date") AS "date", trim(bedrooms) AS bedrooms
FROM properties_text
""")
def q_clean_trim(spark: SparkSession, sf: str) -> DataFrame:
    """Every text column trimmed."""
    t = fx.properties_text(spark, sf).select("id", "priority", "waterfront", "condition", "date", "bedrooms")
    return S.trim_strings(t)


@register("clean_coerce", "B3", sql="""
SELECT id,
       CAST(trunc(TRY_CAST(trim(bedrooms) AS DOUBLE)) AS INTEGER) AS bedrooms,
       TRY_CAST(trim(sqft_living) AS DOUBLE) AS sqft_living,
       TRY_CAST(trim(price) AS DOUBLE) AS price
FROM properties_text
""")
def q_clean_coerce(spark: SparkSession, sf: str) -> DataFrame:
    """Text to numbers by the type map: '3.6' → 3, 'n/a' → NULL."""
    t = fx.properties_text(spark, sf).select("id", "bedrooms", "sqft_living", "price")
    return S.coerce_types(t)


@register("excel_serial_date", "B4", sql="""
SELECT id, date_serial, DATE '1899-12-30' + date_serial AS "date" FROM properties_text
""")
def q_excel_date(spark: SparkSession, sf: str) -> DataFrame:
    """Excel serial day number → date."""
    t = fx.properties_text(spark, sf)
    return t.select("id", "date_serial", X.excel_date("date_serial").alias("date"))


@register("date_parts", "B5", sql="""
SELECT id, CAST(year(DATE '1899-12-30' + date_serial) AS INTEGER) AS sale_year,
       CAST(month(DATE '1899-12-30' + date_serial) AS INTEGER) AS sale_month
FROM properties_text
""")
def q_date_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Year and month of the sale date."""
    d = X.excel_date("date_serial")
    return fx.properties_text(spark, sf).select("id", F.year(d).alias("sale_year"),
                                                F.month(d).alias("sale_month"))


@register("parse_compact_ts", "B6", sql="""
SELECT id, try_strptime("date", '%Y%m%dT%H%M%S') AS ts FROM properties_text
""")
def q_parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    """yyyyMMddTHHmmss text → timestamp; bad text → NULL."""
    return fx.properties_text(spark, sf).select("id", X.parse_ts("date").alias("ts"))


@register("code_map", "B9", sql="""
SELECT id, CASE waterfront WHEN 'N' THEN 0 WHEN 'Y' THEN 1 ELSE 0 END AS waterfront,
       CASE "condition" WHEN 'Poor' THEN 1 WHEN 'Fair' THEN 2 WHEN 'Average' THEN 3
            WHEN 'Good' THEN 4 WHEN 'Very Good' THEN 5 ELSE 3 END AS "condition"
FROM properties_text
""")
def q_code_map(spark: SparkSession, sf: str) -> DataFrame:
    """Text codes with defaults: N/Y → 0/1 else 0; Poor…Very Good → 1…5 else 3."""
    t = fx.properties_text(spark, sf)
    return t.select("id", X.code_map("waterfront", X.WATERFRONT_CODES, 0).alias("waterfront"),
                    X.code_map("condition", X.CONDITION_CODES, 3).alias("condition"))


@register("dedup_exact", "U1", sql="SELECT DISTINCT * FROM properties_dirty")
def q_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Exact duplicate rows dropped."""
    return S.dedup(fx.properties_dirty(spark, sf))


@register("union_markets", "U2", sql="""
SELECT id, 'india' AS market_region, waterfront, "condition", schools_nearby, airport_distance_km,
       sale_year, sale_month, price
FROM properties
UNION ALL
SELECT id, 'us_kc', CASE waterfront WHEN 'N' THEN 0 WHEN 'Y' THEN 1 ELSE 0 END,
       CASE "condition" WHEN 'Poor' THEN 1 WHEN 'Fair' THEN 2 WHEN 'Average' THEN 3
            WHEN 'Good' THEN 4 WHEN 'Very Good' THEN 5 ELSE 3 END,
       2, 35.0e0,
       CAST(year(try_strptime("date", '%Y%m%dT%H%M%S')) AS INTEGER),
       CAST(month(try_strptime("date", '%Y%m%dT%H%M%S')) AS INTEGER), price
FROM second_market_raw
""")
def q_union_markets(spark: SparkSession, sf: str) -> DataFrame:
    """Both markets in one table by column name, region flag kept."""
    a = L.listings_from(fx.listings_raw(spark, sf))
    b = L.second_market_from(fx.second_market_raw(spark, sf))
    u = S.union_markets(a, b)
    return u.select("id", "market_region", "waterfront", "condition", "schools_nearby",
                    "airport_distance_km", "sale_year", "sale_month", "price")
