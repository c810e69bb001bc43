"""Market analytics tables (K2–K6): KPIs, real vs nominal trend, city snapshot, rankings, matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .macro import latest_slice, select_series


def latest_value(series: DataFrame, order: str = "date", value: str = "price") -> DataFrame:
    """The reading at the latest date (one row)."""
    return series.agg(F.max_by(value, order).alias(value))


def market_kpis(real: DataFrame, nominal: DataFrame, cities: DataFrame, entity: str,
                year_from: int = 1980) -> DataFrame:
    """K2: latest real reading, latest nominal reading, mean city growth, mean city yield."""
    r = select_series(real, entity, year_from)
    n = select_series(nominal, entity)
    return cities.agg(
        F.avg("yoy_growth").alias("avg_city_yoy"),
        F.avg("rental_yield").alias("avg_rental_yield"),
    ).select(latest_value(r).scalar().alias("latest_real"),
             latest_value(n).scalar().alias("latest_nominal"),
             "avg_city_yoy", "avg_rental_yield")


def macro_trend(real: DataFrame, nominal: DataFrame, entity: str, year_from: int = 1980) -> DataFrame:
    """K3: real and nominal readings side by side per date (union + pivot: one shuffle)."""
    u = (select_series(real, entity, year_from).select("date", F.lit("real").alias("s"), "price")
         .unionByName(select_series(nominal, entity).select("date", F.lit("nominal").alias("s"), "price")))
    return u.groupBy("date").pivot("s", ["real", "nominal"]).agg(F.first("price")).orderBy("date")


def city_snapshot(long: DataFrame, digits: int = 1) -> DataFrame:
    """K4: latest period per city, index rounded, ascending by index then city."""
    s = latest_slice(long)
    return s.select("city", "quarter", F.round("hpi", digits).alias("hpi")).orderBy("hpi", "city")


def city_growth_rank(cities: DataFrame) -> DataFrame:
    """K5: cities by growth, descending, city name breaking ties."""
    return cities.select("city", "yoy_growth").orderBy(F.desc("yoy_growth"), "city")


def city_matrix(cities: DataFrame) -> DataFrame:
    """K6: price / yield / inventory / growth per city with its position (the table has one row per city)."""
    return cities.select("city", "avg_price_cr", "rental_yield", "inventory_score", "yoy_growth", "lat", "lon")
