"""Deterministic listing, series and market views over the driver tables.

The reference reads property CSVs that are not shipped; these views give the
same shapes from the star-schema tables (see FIXTURES.md). Every view is a
lazy DataFrame: the joins are planned by Catalyst (sort-merge on the big keys,
broadcast only where AQE measures a small side at runtime).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .schemas import RAW_HEADER
from .tables import table

# Condition words of the second-market format, codes 1..5 in order.
CONDITION_WORDS = ["Poor", "Fair", "Average", "Good", "Very Good"]

# A listing's key: the order and the line's place in it. Lines of one order are numbered by a
# window over the join key, so keys neither collide nor overflow (up to 9.2e14 orders).
LINES_PER_ORDER = 10_000


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their listing key; lines of an order are ordered by all columns that a listing uses."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_linenumber", "l_quantity", "l_extendedprice")
    place = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    return li.withColumn("listing_id", F.col("l_orderkey") * LINES_PER_ORDER + F.row_number().over(place))


def _joined(spark: SparkSession, sf_dir: str, order_cols: tuple[str, ...] = ()) -> DataFrame:
    li = _lines(spark, sf_dir)
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", *order_cols)
    p = table(spark, sf_dir, "part", "p_partkey", "p_size")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .join(c, o.o_custkey == c.c_custkey))


def _listing_columns(j: DataFrame, *keep: str) -> DataFrame:
    c = F.col
    base = j.select(
        c("listing_id").alias("id"),
        (1 + c("p_size") % 6).alias("bedrooms"),
        (1 + (c("p_size") % 9) * 0.25).alias("bathrooms"),
        (400 + c("l_quantity") * 80 + (c("l_partkey") % 7) * 10).alias("sqft_living"),
        (1000 + (c("l_partkey") * 37) % 20000).cast("double").alias("sqft_lot"),
        (1 + (c("l_linenumber") % 4) * 0.5).alias("floors"),
        F.when(c("l_suppkey") % 25 == 0, 1).otherwise(0).alias("waterfront"),
        F.when(c("l_suppkey") % 5 == 0, c("l_suppkey") % 4).otherwise(0).cast("int").alias("view"),
        (1 + c("p_size") % 5).alias("condition"),
        (4 + c("p_size") % 9).alias("grade"),
        F.when(c("l_partkey") % 3 == 0, c("l_quantity") * 20).otherwise(0.0).alias("sqft_basement"),
        (1900 + c("p_partkey") % 99).cast("int").alias("yr_built"),
        F.when(c("l_partkey") % 11 == 0, 1980 + c("l_partkey") % 15).otherwise(0)
         .cast("int").alias("yr_renovated"),
        (122000 + c("c_nationkey") * 4 + c("c_custkey") % 4).cast("int").alias("zipcode"),
        (8 + c("c_nationkey") + (c("l_partkey") % 100) * 0.01).alias("lat"),
        (70 + c("c_nationkey") * 0.5 + (c("l_suppkey") % 100) * 0.01).alias("long"),
        (c("l_linenumber") % 3 + 1).alias("schools_nearby"),
        (c("l_orderkey") % 120).cast("double").alias("airport_distance_km"),
        F.year("o_orderdate").alias("sale_year"),
        F.month("o_orderdate").alias("sale_month"),
        (c("l_extendedprice") * 0.5).alias("noise"),
        *[c(k) for k in keep],
    )
    return base.select(
        "*",
        F.greatest(c("sqft_living") - c("sqft_basement"), F.lit(0.0)).alias("sqft_above"),
        (c("sqft_living") + (c("id") % 10) * 10).alias("sqft_living15"),
        (c("sqft_lot") + (c("id") % 7) * 100).alias("sqft_lot15"),
        (50000 + 120 * c("sqft_living") + 15000 * c("grade") + 200000 * c("waterfront")
         + 20000 * c("view") - 400 * c("airport_distance_km") + 3000 * (c("zipcode") % 10)
         + c("noise")).alias("price"),
    )


LISTING_COLUMNS = [
    "id", "bedrooms", "bathrooms", "sqft_living", "sqft_lot", "floors", "waterfront", "view",
    "condition", "grade", "sqft_above", "sqft_basement", "yr_built", "yr_renovated", "zipcode",
    "lat", "long", "sqft_living15", "sqft_lot15", "schools_nearby", "airport_distance_km",
    "sale_year", "sale_month", "noise", "price",
]


def properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per line item (FIXTURES.md §2)."""
    return _listing_columns(_joined(spark, sf_dir)).select(*LISTING_COLUMNS)


def _null_unless(cond: Column, name: str) -> Column:
    return F.when(~cond, F.col(name)).alias(name)


def properties_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``properties`` with nulls, inflated labels and exact duplicates (FIXTURES.md §3)."""
    p = properties(spark, sf_dir)
    m = lambda k: F.col("id") % k == 0
    faults = {
        "bathrooms": _null_unless(m(17), "bathrooms"),
        "floors": _null_unless(m(23) | (F.col("zipcode") == 122003), "floors"),
        "waterfront": _null_unless(m(29), "waterfront"),
        "sqft_lot": _null_unless(m(997), "sqft_lot"),
        "airport_distance_km": _null_unless(m(991), "airport_distance_km"),
        "price": F.when(m(211), F.lit(None).cast("double"))
                  .when(m(1009), F.col("price") * 20).otherwise(F.col("price")).alias("price"),
    }
    d = p.select(*[faults.get(k, F.col(k)) for k in LISTING_COLUMNS])
    # the duplicates come out of the same pass: a union would make every listing twice
    return d.select("*", F.explode(F.when(m(101), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


def _text_codes() -> list[Column]:
    """Flag, condition and date as the second market's text."""
    c = F.col
    return [
        F.when(c("id") % 41 == 0, F.lit("unknown"))
         .when(c("waterfront") == 1, F.lit("Y")).otherwise(F.lit("N")).alias("waterfront"),
        F.element_at(F.array(*[F.lit(w) for w in CONDITION_WORDS]), c("condition")).alias("condition"),
        F.when(c("id") % 43 == 0, F.lit("not a date"))
         .otherwise(F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss")).alias("date"),
    ]


def properties_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-typed listing fields as a raw file would deliver them."""
    j = _listing_columns(_joined(spark, sf_dir, ("o_orderpriority",)), "o_orderpriority",
                         "o_orderdate")
    c = F.col
    return j.select(
        "id",
        F.concat(F.lit("  "), c("o_orderpriority"), F.lit(" ")).alias("priority"),
        F.when(c("id") % 7 == 0, F.concat(c("bedrooms").cast("string"), F.lit(".6")))
         .otherwise(c("bedrooms").cast("string")).alias("bedrooms"),
        F.when(c("id") % 37 == 0, F.lit("n/a"))
         .otherwise(c("sqft_living").cast("bigint").cast("string")).alias("sqft_living"),
        *_text_codes(),
        F.datediff(c("o_orderdate").cast("date"), F.lit("1899-12-30").cast("date"))
         .alias("date_serial"),
        c("price").cast("string").alias("price"),
    )


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings under the raw file header, with the Excel day number as ``Date``."""
    j = _listing_columns(_joined(spark, sf_dir), "o_orderdate")
    j = j.withColumn("date_serial", F.datediff(F.col("o_orderdate").cast("date"),
                                               F.lit("1899-12-30").cast("date")))
    return j.select(*[F.col(new).alias(raw) for raw, new in RAW_HEADER])


SECOND_MARKET = ["id", "bedrooms", "bathrooms", "sqft_living", "sqft_lot", "floors", "view", "grade", "sqft_above", "sqft_basement",
                 "yr_built", "yr_renovated", "zipcode", "lat", "long", "sqft_living15", "sqft_lot15", "price"]


def second_market_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second-market listings: compact timestamp text, Y/N and condition words."""
    j = _listing_columns(_joined(spark, sf_dir), "o_orderdate")
    return j.select(*SECOND_MARKET, *_text_codes())


# ---------------------------------------------------------------- series views

def _orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey")))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country price series: one mean order price per region and quarter."""
    j = _orders_by_nation(spark, sf_dir)
    return (j.groupBy(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country_code"),
                      F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("date"))
             .agg(F.avg("o_totalprice").alias("price")))


def series_nominal(spark: SparkSession, sf_dir: str, real: DataFrame | None = None) -> DataFrame:
    """The nominal series; ``real`` is the real one, if it is at hand."""
    s = series(spark, sf_dir) if real is None else real
    return s.select("country_code", "date",
                    (F.col("price") * (1 + 0.03 * (F.year("date") - 1995))).alias("price"))


def series_text(spark: SparkSession, sf_dir: str, nominal: bool = False) -> DataFrame:
    """The series as a latin-1 text file delivers it: dates as text."""
    s = series_nominal(spark, sf_dir) if nominal else series(spark, sf_dir)
    return s.select("country_code", F.col("date").cast("string").alias("date"), "price")


def order_span(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    """First and last order date (one row, from column statistics of the scan)."""
    r = table(spark, sf_dir, "orders", "o_orderdate").agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b")).first()
    return r["a"], r["b"]


def quarter_labels(first: dt.date, last: dt.date) -> list[str]:
    """Month-year labels (quarter ends, leading space) of all quarters from ``first`` to ``last``."""
    span = range(first.year * 4 + (first.month - 1) // 3, last.year * 4 + (last.month - 1) // 3 + 1)
    return [f" {q % 4 * 3 + 3:02d}-{q // 4}" for q in span]


def city_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide quarterly index per nation (100 = first quarter), one column for each quarter of the orders."""
    labels = quarter_labels(*order_span(spark, sf_dir))
    j = _orders_by_nation(spark, sf_dir)
    label = F.concat(F.lit(" "), F.lpad((F.quarter("o_orderdate") * 3).cast("string"), 2, "0"),
                     F.lit("-"), F.year("o_orderdate").cast("string"))
    w = (j.withColumn("q", label).groupBy("n_nationkey", "n_name")
          .pivot("q", labels).agg(F.avg("o_totalprice")))
    cols = []
    for q in labels:
        v = 100 * F.col(f"`{q}`") / F.col(f"`{labels[0]}`")
        if q == labels[-1]:
            v = F.when(F.col("n_nationkey") % 5 != 0, v)
        cols.append(v.alias(q))
    return w.select(F.col("n_name").alias("Particulars"), *cols)


def city_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-nation market table: price level, growth, yield, inventory, position."""
    j = _orders_by_nation(spark, sf_dir)
    y1 = (order_span(spark, sf_dir)[1] + dt.timedelta(days=1)).year - 1  # the last full year
    y0 = y1 - 1
    yr = F.year("o_orderdate")
    orders_agg = j.groupBy("n_nationkey", "n_name").agg(
        (F.avg("o_totalprice") / 100000).alias("avg_price_cr"),
        (100 * (F.avg(F.when(yr == y1, F.col("o_totalprice")))
                / F.avg(F.when(yr == y0, F.col("o_totalprice"))) - 1)).alias("yoy_growth"),
        F.count("*").alias("inventory_score"),
    )
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_discount")
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    yield_agg = (li.join(o, li.l_orderkey == o.o_orderkey)
                   .join(c, o.o_custkey == c.c_custkey)
                   .groupBy(F.col("c_nationkey").alias("n_nationkey"))
                   .agg((F.avg("l_discount") * 100).alias("rental_yield")))
    return orders_agg.join(yield_agg, "n_nationkey").select(
        F.col("n_name").alias("city"), "avg_price_cr", "yoy_growth", "rental_yield",
        "inventory_score",
        (8 + F.col("n_nationkey")).cast("double").alias("lat"),
        (70 + F.col("n_nationkey") * 0.5).alias("lon"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored out-of-fold predictions with a known error (for C10/C11 oracles)."""
    p = properties(spark, sf_dir)
    return p.select("id", ((F.col("id") % 1000003) % 3).alias("fold"),
                    F.col("price").alias("y"),
                    (F.col("price") - F.col("noise") + 26527).alias("p"))
