"""Queries for engineered features and scoring outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import features as FE
from ..operators import scoring as SC
from ..sources import fixtures as fx
from . import sqlbits as Q
from .common import enriched, r6, round6
from .registry import register

AGE_SQL = "CASE WHEN sale_year - yr_built IS NOT NULL THEN greatest(sale_year - yr_built, 0) END"
ENG_SQL = f"""
  {AGE_SQL} AS property_age,
  CASE WHEN yr_renovated > 0 THEN 1 ELSE 0 END AS has_renovated,
  greatest(CASE WHEN yr_renovated > 0 THEN sale_year - yr_renovated ELSE {AGE_SQL} END, 0) AS years_since_renovation,
  round(least(greatest(coalesce(sqft_basement / nullif(sqft_living, 0), 0.0e0), 0.0e0), 1.0e0), 6) AS basement_ratio,
  round(CASE WHEN ln(1 + airport_distance_km) <> 0 THEN schools_nearby / ln(1 + airport_distance_km) END, 6)
    AS school_accessibility,
  sqft_above + sqft_basement AS total_interior_area,
  grade * "condition" AS grade_condition_score,
  waterfront * CASE WHEN "view" > 0 THEN 1 ELSE 0 END AS waterfront_view_premium,
  CASE WHEN sale_month IN (12, 1, 2) THEN 'winter' WHEN sale_month IN (3, 4, 5) THEN 'spring'
       WHEN sale_month IN (6, 7, 8) THEN 'summer' WHEN sale_month IN (9, 10, 11) THEN 'fall'
       ELSE 'spring' END AS sale_season"""

ZIP_SQL = """
LEFT JOIN (SELECT zipcode, median(price) AS zp, median(sqft_living) AS zs FROM properties GROUP BY zipcode) z
  ON p.zipcode = z.zipcode
CROSS JOIN (SELECT median(price) AS gp, median(sqft_living) AS gs FROM properties) g"""


@register("feat_size_vs_neighborhood", "B15", "J2", "C2", "C3", sql=f"""
SELECT p.id, p.zipcode, p.sqft_living,
       round(p.sqft_living / CASE WHEN coalesce(z.zs, g.gs) = 0 THEN 1 ELSE coalesce(z.zs, g.gs) END, 6)
         AS size_vs_neighborhood
FROM properties p {ZIP_SQL}
""")
def q_size_vs_neighborhood(spark: SparkSession, sf: str) -> DataFrame:
    """Living area relative to the zipcode median (unseen zip → global median)."""
    p = fx.properties(spark, sf)
    return FE.engineer(p, FE.fit_engineer(p)).select("id", "zipcode", "sqft_living", r6("size_vs_neighborhood"))


@register("feat_market_demand", "B14", "J2", "C2", "C3", sql=f"""
SELECT p.id, p.zipcode, round(coalesce(z.zp, g.gp) / g.gp, 6) AS market_demand_index
FROM properties p {ZIP_SQL}
""")
def q_market_demand(spark: SparkSession, sf: str) -> DataFrame:
    """Zipcode median price over the global median price."""
    p = fx.properties(spark, sf)
    return FE.engineer(p, FE.fit_engineer(p)).select("id", "zipcode", r6("market_demand_index"))


@register("feat_property_age", "B10", sql=f"SELECT id, {AGE_SQL} AS property_age FROM properties")
def q_property_age(spark: SparkSession, sf: str) -> DataFrame:
    """max(sale_year − yr_built, 0)."""
    return fx.properties(spark, sf).select("id", X.property_age().alias("property_age"))


@register("feat_renovation", "B11", "B12", sql=f"""
SELECT id, CASE WHEN yr_renovated > 0 THEN 1 ELSE 0 END AS has_renovated,
       greatest(CASE WHEN yr_renovated > 0 THEN sale_year - yr_renovated ELSE {AGE_SQL} END, 0)
         AS years_since_renovation
FROM properties
""")
def q_renovation(spark: SparkSession, sf: str) -> DataFrame:
    """Renovated flag and years since renovation (property age when never renovated)."""
    return fx.properties(spark, sf).select(
        "id", X.has_renovated().alias("has_renovated"),
        X.years_since_renovation(age=X.property_age()).alias("years_since_renovation"))


@register("feat_basement_ratio", "B13", sql="""
SELECT id, round(least(greatest(coalesce(sqft_basement / nullif(sqft_living, 0), 0.0e0), 0.0e0), 1.0e0), 6)
  AS basement_ratio FROM properties
""")
def q_basement_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """clip(basement / living, 0, 1), zero living → 0."""
    return fx.properties(spark, sf).select("id", r6(X.basement_ratio(), "basement_ratio"))


@register("feat_school_access", "B16", sql="""
SELECT id, airport_distance_km,
       round(CASE WHEN ln(1 + airport_distance_km) <> 0 THEN schools_nearby / ln(1 + airport_distance_km) END, 6)
         AS school_accessibility
FROM properties
""")
def q_school_access(spark: SparkSession, sf: str) -> DataFrame:
    """schools / ln(1 + km); 0 km → NULL."""
    return fx.properties(spark, sf).select("id", "airport_distance_km",
                                           r6(X.school_accessibility(), "school_accessibility"))


@register("feat_areas", "B17", "B21", sql="""
SELECT id, sqft_above + sqft_basement AS total_interior_area,
       greatest(sqft_living - sqft_basement, 0.0e0) AS sqft_above_scoring
FROM properties
""")
def q_areas(spark: SparkSession, sf: str) -> DataFrame:
    """Total interior area; above-ground area as derived at scoring time."""
    return fx.properties(spark, sf).select("id", X.total_interior_area().alias("total_interior_area"),
                                           X.sqft_above_from().alias("sqft_above_scoring"))


@register("feat_interactions", "B18", "B19", sql="""
SELECT id, grade * "condition" AS grade_condition_score,
       waterfront * CASE WHEN "view" > 0 THEN 1 ELSE 0 END AS waterfront_view_premium
FROM properties
""")
def q_interactions(spark: SparkSession, sf: str) -> DataFrame:
    """grade × condition; waterfront × (view > 0)."""
    return fx.properties(spark, sf).select("id", X.grade_condition_score().alias("grade_condition_score"),
                                           X.waterfront_view_premium().alias("waterfront_view_premium"))


@register("feat_season", "B20", sql="""
SELECT id, sale_month,
  CASE WHEN sale_month IN (12, 1, 2) THEN 'winter' WHEN sale_month IN (3, 4, 5) THEN 'spring'
       WHEN sale_month IN (6, 7, 8) THEN 'summer' WHEN sale_month IN (9, 10, 11) THEN 'fall'
       ELSE 'spring' END AS sale_season
FROM properties
""")
def q_season(spark: SparkSession, sf: str) -> DataFrame:
    """Season of the sale month."""
    return fx.properties(spark, sf).select("id", "sale_month", X.sale_season().alias("sale_season"))


@register("feature_frame", "B22", "B23", "H11", "J2", sql=f"""
SELECT p.*, {ENG_SQL},
  round(coalesce(z.zp, g.gp) / g.gp, 6) AS market_demand_index,
  round(p.sqft_living / CASE WHEN coalesce(z.zs, g.gs) = 0 THEN 1 ELSE coalesce(z.zs, g.gs) END, 6)
    AS size_vs_neighborhood
FROM properties p {ZIP_SQL}
""")
def q_feature_frame(spark: SparkSession, sf: str) -> DataFrame:
    """All engineered features of every listing, in one projection after one lookup join."""
    p = fx.properties(spark, sf)
    e = FE.engineer(p, FE.fit_engineer(p))
    rounded = {"basement_ratio", "school_accessibility", "market_demand_index", "size_vs_neighborhood"}
    return e.select(*[round6(F.col(c)).alias(c) if c in rounded else F.col(c) for c in e.columns])


# ---------------------------------------------------------------------- scoring

@register("score_band", "B24", sql="""
SELECT id, round(p, 6) AS pred, round(p * (1 - 0.12e0), 6) AS lo, round(p * (1 + 0.12e0), 6) AS hi
FROM predictions
""")
def q_score_band(spark: SparkSession, sf: str) -> DataFrame:
    """±12 % band around stored predictions."""
    b = SC.with_band(fx.predictions(spark, sf).withColumnRenamed("p", "pred"), "pred", 0.12)
    return b.select("id", r6("pred"), r6("lo"), r6("hi"))


@register("score_macro_defaults", "M8", sql=f"""
SELECT id, round(real_price_idx * 0.05e0, 6) AS real_price_yoy,
       round(CASE WHEN sale_year % 2 = 0 THEN nom_price_yoy ELSE nom_price_idx * 0.06e0 END, 6) AS nom_price_yoy
FROM ({Q.ENRICHED}) e
WHERE nom_price_yoy IS NOT NULL
""")
def q_macro_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Growth rates of scoring rows: absent (real) or NULL in odd years (nominal), filled from the indices."""
    e = enriched(spark, sf).where("nom_price_yoy is not null").drop("real_price_yoy")
    e = e.withColumn("nom_price_yoy", F.when(F.col("sale_year") % 2 == 0, F.col("nom_price_yoy")))
    return SC.with_macro_defaults(e).select("id", r6("real_price_yoy"), r6("nom_price_yoy"))


RULE_SQL = """greatest(sqft_living * 950.0e0 + grade * 120000.0e0 + bathrooms * 85000.0e0 + "view" * 60000.0e0
  + waterfront * 350000.0e0 + airport_distance_km * -2500.0e0, 1200000.0e0)"""


@register("score_rule_based", "B25", sql=f"""
SELECT id, round({RULE_SQL}, 6) AS pred, round({RULE_SQL} * (1 - 0.12e0), 6) AS lo,
       round({RULE_SQL} * (1 + 0.12e0), 6) AS hi
FROM properties
""")
def q_rule_based(spark: SparkSession, sf: str) -> DataFrame:
    """Rule-based valuation with its band."""
    r = SC.rule_based(fx.properties(spark, sf))
    return r.select("id", r6("pred"), r6("lo"), r6("hi"))


MS_SQL = """100 * (0.35e0 * least(latest_hpi / 250, 1.2e0) + 0.30e0 * least(real_price_idx / 150, 1.2e0)
  + 0.20e0 * least(nom_price_idx / 180, 1.2e0)
  + 0.15e0 * least((4 - least(airport_distance_km / 30, 4.0e0)) / 4 + 0.2e0, 1.0e0))"""


@register("market_score", "B26", sql=f"""
SELECT id, round({MS_SQL}, 6) AS market_score FROM ({Q.ENRICHED}) e
""")
def q_market_score(spark: SparkSession, sf: str) -> DataFrame:
    """Market score per listing from its macro columns (unrounded, compared at 6 decimals)."""
    e = SC.with_market_score(enriched(spark, sf), digits=None)
    return e.select("id", r6("market_score"))


@register("risk_band", "B27", sql="""
SELECT id, CASE WHEN spread <= 0.20e0 THEN 'Low' WHEN spread <= 0.28e0 THEN 'Moderate' ELSE 'Elevated' END AS risk_band
FROM (SELECT id, (p * (1 + (id % 20) * 0.01e0) - p * (1 - (id % 20) * 0.01e0)) / greatest(p, 1.0e0) AS spread
      FROM predictions) t
""")
def q_risk_band(spark: SparkSession, sf: str) -> DataFrame:
    """Relative band width → Low / Moderate / Elevated (band width varies with the row)."""
    pr = fx.predictions(spark, sf)
    pct = (F.col("id") % 20) * 0.01
    b = pr.select("id", F.col("p").alias("pred"), (F.col("p") * (1 - pct)).alias("lo"),
                  (F.col("p") * (1 + pct)).alias("hi"))
    return SC.with_risk_band(b).select("id", "risk_band")


@register("signal_composition", "B28", sql=f"""
SELECT id, metric, round(score, 6) AS score FROM (
  SELECT id, 'Real index' AS metric, real_price_idx / 2.0e0 AS score FROM ({Q.ENRICHED}) e1
  UNION ALL SELECT id, 'Nominal index', nom_price_idx / 2.2e0 FROM ({Q.ENRICHED}) e2
  UNION ALL SELECT id, 'HPI', latest_hpi / 2.3e0 FROM ({Q.ENRICHED}) e3
  UNION ALL SELECT id, 'Neighbourhood strength', 68.0e0 FROM properties) u
""")
def q_signal_composition(spark: SparkSession, sf: str) -> DataFrame:
    """(metric, score) rows per listing."""
    s = SC.signal_composition(enriched(spark, sf))
    return s.select("id", "metric", r6("score"))


@register("scenario_table", "J5", sql="""
SELECT id, scenario, round(p * factor, 6) AS value FROM predictions,
  (VALUES ('Base', 1.0e0), ('Higher grade', 1.08e0), ('Closer airport', 1.04e0),
          ('Higher HPI', 1.06e0), ('Premium view', 1.07e0)) s(scenario, factor)
""")
def q_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    """Each prediction under each fixed scenario factor."""
    s = SC.scenarios(fx.predictions(spark, sf), pred="p")
    return s.select("id", "scenario", r6("value"))
