"""Sources A1–A4: listing files, second-market files, country series, wide city index.

Each reader has a file entry point (``read_*``) and a DataFrame entry point
(``*_from``) so the same logic serves files and already-loaded tables.
CSV files are read with explicit schemas, and their headers are checked against
them; where a format leaves columns open, the header alone is read first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import (CONDITION_CODES, WATERFRONT_CODES, code_map, excel_date,
                                 parse_ts)
from ..operators.standardise import drop_columns, with_constants
from .schemas import LISTINGS, RAW_HEADER, SECOND_MARKET_TEXT, SERIES

PRIMARY_REGION = "india"
SECOND_REGION = "us_kc"
# Stub columns the second market lacks (schools, airport km).
SECOND_MARKET_STUBS = {"schools_nearby": 2, "airport_distance_km": 35.0}


def _csv(spark: SparkSession, path: str, schema: T.StructType, encoding: str = "UTF-8") -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("encoding", encoding).csv(path)


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file: one line, no pass over the data."""
    return spark.read.option("header", True).csv(path).columns


# ------------------------------------------------------------------ A1 listings

def listings_from(raw: DataFrame, region: str = PRIMARY_REGION) -> DataFrame:
    """A1: rename the raw header, derive date / sale_year / sale_month, tag the region."""
    names = dict(RAW_HEADER)
    df = raw.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in raw.columns])
    d = excel_date("date_serial")
    df = df.withColumns({"date": d, "sale_year": F.year(d), "sale_month": F.month(d)})
    return with_constants(drop_columns(df, ["date_serial"]), market_region=region)


def read_listings(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    raw = _csv(spark, path, LISTINGS) if fmt == "csv" else spark.read.format(fmt).load(path)
    return listings_from(raw)


# ------------------------------------------------------------- A2 second market

def second_market_from(raw: DataFrame, region: str = SECOND_REGION) -> DataFrame:
    """A2: text flags → codes, compact timestamps → dates, stub columns, region tag."""
    ts = parse_ts("date")
    df = raw.withColumns({
        "waterfront": code_map("waterfront", WATERFRONT_CODES, 0),
        "condition": code_map("condition", CONDITION_CODES, 3),
        "date": ts,
    })
    df = df.withColumns({"sale_year": F.year("date"), "sale_month": F.month("date")})
    return with_constants(df, **SECOND_MARKET_STUBS, market_region=region)


def read_second_market(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType() if c in SECOND_MARKET_TEXT else T.LongType() if c == "id" else T.DoubleType())
                           for c in _header(spark, path)])
    return second_market_from(_csv(spark, path, schema))


# ------------------------------------------------------------- A3 country series

def series_from(raw: DataFrame) -> DataFrame:
    """A3: (country_code, date, price) with text dates parsed; bad dates → NULL."""
    return raw.select(
        F.col("country_code").cast("string").alias("country_code"),
        F.col("date").cast("string").try_cast("date").alias("date"),
        F.col("price").cast("string").try_cast("double").alias("price"),
    )


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Country series files are latin-1 encoded."""
    return series_from(_csv(spark, path, SERIES, encoding="ISO-8859-1"))


# --------------------------------------------------------------- A4 city index

def city_index_from(raw: DataFrame) -> DataFrame:
    """A4: wide index with header names trimmed (the file's names carry a leading space)."""
    return raw.toDF(*[c.strip() for c in raw.columns])


def read_city_index(spark: SparkSession, path: str) -> DataFrame:
    names = _header(spark, path)
    schema = T.StructType([T.StructField(c, T.StringType() if k == 0 else T.DoubleType()) for k, c in enumerate(names)])
    return city_index_from(_csv(spark, path, schema))
