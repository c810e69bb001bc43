"""Macro series and city index: selection (F1, F2, F6), scalars (C4), yoy series,
enrichment joins (J1, J1b), latest index (W3), wide→long (U3), latest slice (F7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The aggregate entity and the reference's fallback index.
WORLD_ENTITY = "5R"
DEFAULT_HPI = 200.0
MACRO_COLUMNS = ["real_price_yoy", "real_price_idx", "nom_price_yoy", "nom_price_idx"]


def select_series(df: DataFrame, entity: str, year_from: int | None = None,
                  year_to: int | None = None) -> DataFrame:
    """one entity's readings with date and value present, optionally within years.

    The year bounds are written as a date range so Parquet min/max statistics can prune.
    """
    cond = (F.col("country_code") == entity) & F.col("date").isNotNull() & F.col("price").isNotNull()
    if year_from is not None:
        cond = cond & (F.col("date") >= F.make_date(F.lit(year_from), F.lit(1), F.lit(1)))
    if year_to is not None:
        cond = cond & (F.col("date") < F.make_date(F.lit(year_to + 1), F.lit(1), F.lit(1)))
    return df.where(cond)


def yoy_series(df: DataFrame, lag: int = 4) -> DataFrame:
    """Year-over-year % change of an index series (quarterly: lag 4), per entity.

    The window is partitioned by entity; one entity's series has one row per period.
    """
    w = Window.partitionBy("country_code").orderBy("date")
    return df.select("country_code", "date",
                     (100 * (F.col("price") / F.lag("price", lag).over(w) - 1)).alias("price"))


def macro_scalar(series: DataFrame, entity: str, year: int, name: str = "value") -> DataFrame:
    """C4: mean reading of ``entity`` in ``year`` (NULL when there is none), one row."""
    s = select_series(series, entity, year, year)
    return s.agg(F.avg("price").alias(name))


def macro_by_year(named: Mapping[str, DataFrame], entity: str) -> DataFrame:
    """J1b table: one row per year with the yearly mean of each named series."""
    parts = [select_series(df, entity).select(F.year("date").alias("sale_year"),
                                              F.lit(n).alias("series"), "price")
             for n, df in named.items()]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.groupBy("sale_year").pivot("series", list(named)).agg(F.avg("price"))


def macro_features(named: Mapping[str, DataFrame], entity: str, year: int) -> DataFrame:
    """J1 table: one row, one column per named series (mean over ``year``)."""
    m = macro_by_year(named, entity).where(F.col("sale_year") == year)
    return m.agg(*[F.max(n).alias(n) for n in named])  # one row; NULL when the year is absent


def enrich_scalar(df: DataFrame, one_row: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The one-row table's values onto every row, as scalar subqueries (no join)."""
    cols = list(cols or one_row.columns)
    return df.select("*", *[one_row.select(F.col(c)).scalar().alias(c) for c in cols])


def enrich_by_year(df: DataFrame, by_year: DataFrame, year: str = "sale_year") -> DataFrame:
    """Per-year macro values by a left join on the year.

    ``by_year`` has one row per calendar year of the series (tens of rows), a
    bound that does not grow with the listings, so it is broadcast.
    """
    t = by_year.withColumnRenamed("sale_year", year)
    return df.join(F.broadcast(t), year, "left")


def latest_index(wide: DataFrame, label_col: str = "Particulars",
                 periods: Sequence[str] | None = None, default: float = DEFAULT_HPI) -> DataFrame:
    """Per row, the last non-null reading across the period columns (in column order)."""
    periods = list(periods or [c for c in wide.columns if c != label_col])
    vals = [F.col(f"`{p}`").cast("string").try_cast("double") for p in reversed(periods)]
    return wide.select(F.trim(F.col(label_col)).alias(label_col),
                       F.coalesce(*vals, F.lit(default)).alias("latest_hpi"))


def latest_hpi(wide: DataFrame, row: str, label_col: str = "Particulars",
               default: float = DEFAULT_HPI) -> DataFrame:
    """One row: the latest reading of the row labelled ``row`` (``default`` when absent)."""
    li = latest_index(wide, label_col, default=default).where(F.col(label_col) == row)
    return li.agg(F.coalesce(F.max("latest_hpi"), F.lit(default)).alias("latest_hpi"))  # the highest, if the label repeats


def to_long(wide: DataFrame, id_col: str = "Particulars", id_name: str = "city",
            period: str = "quarter", value: str = "hpi") -> DataFrame:
    """U3 + F6: melt period columns to (city, quarter, hpi, period_date); drop NULL readings.

    ``period_date`` parses the ``MM-yyyy`` label: text order would put 12-2012 after 09-2013.
    """
    periods = [c for c in wide.columns if c != id_col]
    t = wide.select(F.col(id_col).alias(id_name),
                    *[F.col(f"`{p}`").cast("string").alias(p.strip()) for p in periods])
    long = t.unpivot([id_name], [p.strip() for p in periods], period, "_v")
    return long.select(id_name, period, F.col("_v").try_cast("double").alias(value),
                       F.try_to_date(F.concat(F.lit("01-"), F.col(period)), "dd-MM-yyyy")
                       .alias("period_date")).where(F.col(value).isNotNull())


def latest_slice(long: DataFrame, order: str = "period_date") -> DataFrame:
    """rows of the latest period (global max as a scalar subquery)."""
    return long.where(F.col(order) == long.agg(F.max(order)).scalar())
