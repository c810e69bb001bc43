"""Small helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import macro as M
from ..session import materialise
from ..sources import fixtures as fx

# The fixture entity that plays the reference's aggregate "5R", and the city-index
# row that plays "All India".
ENTITY = "R0"
INDEX_ROW = "INDIA"


def r6(c: str | Column, name: str | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or (c if isinstance(c, str) else None))


def round6(c: Column) -> Column:
    """``F.round(c, 6)`` of a double, which works on decimals: those are only needed near ties and for great values.

    A whole number over 10^6 is the double nearest to that decimal, so both ways give the same bits.
    """
    x = c.cast("double")
    scaled = x * 1e6
    off = scaled - F.floor(scaled)
    plain = (F.abs(scaled) < 4e13) & (F.abs(off - 0.5) > 0.02)
    return F.when(plain, F.floor(scaled + 0.5) / F.lit(1e6)).otherwise(F.round(x, 6))


def named_series(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four macro inputs: yoy and index of the real and nominal series."""
    # a few rows for each quarter, written once: the four series below would each aggregate the orders again
    real = materialise(fx.series(spark, sf), "series")
    nom = fx.series_nominal(spark, sf, real)
    return {"real_price_yoy": M.yoy_series(real), "real_price_idx": real,
            "nom_price_yoy": M.yoy_series(nom), "nom_price_idx": nom}


def enriched(spark: SparkSession, sf: str, df: DataFrame | None = None) -> DataFrame:
    """Listings with per-year macro columns (J1b) and the latest city index."""
    df = df if df is not None else fx.properties(spark, sf)
    by_year = M.macro_by_year(named_series(spark, sf), ENTITY)
    e = M.enrich_by_year(df, by_year)
    return M.enrich_scalar(e, M.latest_hpi(fx.city_index_wide(spark, sf), INDEX_ROW))
