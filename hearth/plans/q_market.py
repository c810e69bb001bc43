"""Queries for macro series, city index and market tables, and evaluation (F1, F2, F6, F7, C4,
C10–C14, U3, W3, T1–T3, K2–K6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluation as EV
from ..operators import macro as M
from ..operators import market as MK
from ..sources import fixtures as fx
from ..sources.fixture_sql import CITY_INDEX_LABELS
from . import sqlbits as Q
from .common import ENTITY, named_series, r6
from .registry import register

MACRO = ["real_price_yoy", "real_price_idx", "nom_price_yoy", "nom_price_idx"]
MACRO_YEAR = 1998


@register("macro_scalar", "F1", "C4", sql=f"""
SELECT {", ".join(f"round(max({c}), 6) AS {c}" for c in MACRO)}
FROM ({Q.MACRO_BY_YEAR}) m WHERE sale_year = {MACRO_YEAR}
""")
def q_macro_scalar(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of each macro series for the aggregate entity in one year (one row)."""
    m = M.macro_features(named_series(spark, sf), ENTITY, MACRO_YEAR)
    return m.select(*[r6(c) for c in MACRO])


@register("macro_trend", "K3", "F2", "T1", sql="""
SELECT "date", round(max(CASE WHEN s = 'real' THEN price END), 6) AS real,
       round(max(CASE WHEN s = 'nominal' THEN price END), 6) AS nominal
FROM (SELECT 'real' AS s, "date", price FROM series
      WHERE country_code = 'R0' AND "date" IS NOT NULL AND price IS NOT NULL AND "date" >= DATE '1980-01-01'
      UNION ALL
      SELECT 'nominal', "date", price FROM series_nominal
      WHERE country_code = 'R0' AND "date" IS NOT NULL AND price IS NOT NULL) u
GROUP BY "date"
""")
def q_macro_trend(spark: SparkSession, sf: str) -> DataFrame:
    """Real and nominal readings of the aggregate entity side by side, by date."""
    t = MK.macro_trend(fx.series(spark, sf), fx.series_nominal(spark, sf), ENTITY)
    return t.select("date", r6("real"), r6("nominal"))


def _long_sql(digits: int | None) -> str:
    v = (lambda c: f'round("{c}", {digits})') if digits is not None else (lambda c: f'"{c}"')
    return " UNION ALL ".join(
        f"""SELECT "Particulars" AS city, '{c.strip()}' AS quarter, {v(c)} AS hpi,
            CAST(strptime('01-{c.strip()}', '%d-%m-%Y') AS DATE) AS period_date
            FROM city_index_wide WHERE "{c}" IS NOT NULL""" for c in CITY_INDEX_LABELS)


_LONG_SQL = _long_sql(6)


@register("city_index_long", "U3", "F6", sql=_LONG_SQL)
def q_city_long(spark: SparkSession, sf: str) -> DataFrame:
    """Wide quarterly index melted to (city, quarter, hpi, period_date); NULL readings dropped."""
    return M.to_long(fx.city_index_wide(spark, sf)).select("city", "quarter", r6("hpi"), "period_date")


@register("city_index_snapshot", "F7", "T2", "K4", sql=f"""
SELECT city, quarter, round(hpi, 1) AS hpi FROM ({_long_sql(None)}) l
WHERE period_date = (SELECT max(period_date) FROM ({_LONG_SQL}) m)
""")
def q_city_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Latest quarter per city, index rounded to 1 decimal, ascending."""
    return MK.city_snapshot(M.to_long(fx.city_index_wide(spark, sf)))


@register("latest_index", "W3", sql=f"""
SELECT trim("Particulars") AS "Particulars", round(coalesce({Q.REVERSED_QUARTERS}, 200.0e0), 6) AS latest_hpi
FROM city_index_wide
""")
def q_latest_index(spark: SparkSession, sf: str) -> DataFrame:
    """Last non-NULL reading per city across the quarter columns (default 200)."""
    li = M.latest_index(fx.city_index_wide(spark, sf))
    return li.select("Particulars", r6("latest_hpi"))


@register("market_kpis", "K2", "C12", "C13", sql="""
SELECT round((SELECT arg_max(price, "date") FROM series WHERE country_code = 'R0' AND "date" IS NOT NULL
              AND price IS NOT NULL AND "date" >= DATE '1980-01-01'), 6) AS latest_real,
       round((SELECT arg_max(price, "date") FROM series_nominal WHERE country_code = 'R0'
              AND "date" IS NOT NULL AND price IS NOT NULL), 6) AS latest_nominal,
       round(avg(yoy_growth), 6) AS avg_city_yoy, round(avg(rental_yield), 6) AS avg_rental_yield
FROM city_market
""")
def q_market_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Latest real and nominal readings, mean city growth and yield (one row)."""
    k = MK.market_kpis(fx.series(spark, sf), fx.series_nominal(spark, sf), fx.city_market(spark, sf), ENTITY)
    return k.select(*[r6(c) for c in k.columns])


@register("city_growth_rank", "K5", "T3", sql="SELECT city, round(yoy_growth, 6) AS yoy_growth FROM city_market")
def q_growth_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Cities by growth, descending."""
    return MK.city_growth_rank(fx.city_market(spark, sf)).select("city", r6("yoy_growth"))


@register("city_matrix", "K6", sql="""
SELECT city, round(avg_price_cr, 6) AS avg_price_cr, round(rental_yield, 6) AS rental_yield, inventory_score,
       round(yoy_growth, 6) AS yoy_growth, lat, lon FROM city_market
""")
def q_city_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Price / yield / inventory / growth per city with its position."""
    m = MK.city_matrix(fx.city_market(spark, sf))
    return m.select("city", r6("avg_price_cr"), r6("rental_yield"), "inventory_score", r6("yoy_growth"),
                    "lat", "lon")


METRICS_SQL = """SELECT fold, count(*) AS n,
  CASE WHEN var_pop(y) * count(y) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0e0 ELSE 0.0e0 END
       ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) END AS r2,
  avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse
FROM {src} GROUP BY fold"""


@register("regression_metrics", "C10", sql=f"""
SELECT fold, n, round(r2, 6) AS r2, round(mae, 6) AS mae, round(rmse, 6) AS rmse
FROM ({METRICS_SQL.format(src="predictions")}) m
""")
def q_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """R², MAE, RMSE per fold of stored predictions."""
    m = EV.regression_metrics(fx.predictions(spark, sf), by=["fold"])
    return m.select("fold", "n", r6("r2"), r6("mae"), r6("rmse"))


@register("cv_summary", "C11", "M5", sql=f"""
SELECT count(*) AS n_folds, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std,
       round(avg(mae), 6) AS mae_mean, round(avg(rmse), 6) AS rmse_mean
FROM ({METRICS_SQL.format(src="predictions")}) m
""")
def q_cv_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Mean ± population std of R² across folds, mean MAE and RMSE."""
    s = EV.cv_summary(EV.regression_metrics(fx.predictions(spark, sf), by=["fold"]))
    return s.select("n_folds", r6("r2_mean"), r6("r2_std"), r6("mae_mean"), r6("rmse_mean"))


CANDIDATES_SQL = """SELECT 0 AS candidate_no, 'A' AS candidate, id, fold, y, p FROM predictions
UNION ALL SELECT 1, 'B', id, fold, y, p * 1.02e0 FROM predictions
UNION ALL SELECT 2, 'C', id, fold, y, p + ((id % 7) - 3) * 5000.0e0 FROM predictions"""


@register("select_winner", "C14", "C11", sql=f"""
SELECT candidate AS best_model, round(r2_mean, 6) AS r2_mean FROM (
  SELECT candidate_no, candidate, avg(r2) AS r2_mean FROM (
    SELECT candidate_no, candidate, fold,
      1 - sum((y - p) * (y - p)) / (var_pop(y) * count(y)) AS r2
    FROM ({CANDIDATES_SQL}) c GROUP BY candidate_no, candidate, fold) f
  GROUP BY candidate_no, candidate) s
ORDER BY r2_mean DESC, candidate_no LIMIT 1
""")
def q_select_winner(spark: SparkSession, sf: str) -> DataFrame:
    """Best of three candidate predictors by mean fold R² (earlier candidate wins ties)."""
    pr = fx.predictions(spark, sf)
    cands = [("A", F.col("p")), ("B", F.col("p") * 1.02), ("C", F.col("p") + ((F.col("id") % 7) - 3) * 5000.0)]
    u = None
    for i, (name, expr) in enumerate(cands):
        part = pr.select(F.lit(i).alias("candidate_no"), F.lit(name).alias("candidate"), "fold", "y",
                         expr.alias("p"))
        u = part if u is None else u.unionByName(part)
    folds = EV.regression_metrics(u, by=["candidate_no", "candidate", "fold"])
    res = EV.cv_summary(folds, by=["candidate_no", "candidate"])
    w = EV.select_winner(res)
    return w.select("best_model", r6("r2_mean"))
