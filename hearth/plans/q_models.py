"""Queries for the custom algorithms (H1–H3), the cleaning chain (M10), modelling (M1–M9),
feature matrix (H9, H10) and sinks (A5–A7). These are checked by rows plus our own tests
(brute-force comparisons on small fixtures), except the closed-form VIF pair."""

from __future__ import annotations

import hashlib
import json
import uuid
from functools import reduce
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning as CL
from ..operators import collinearity as CO
from ..operators import encoders as EN
from ..operators import evaluation as EV
from ..operators import iforest as IF
from ..operators import knn as KN
from ..operators import outliers as OU
from ..operators import scoring as SC
from ..operators import standardise as S
from ..operators import training as TR
from ..session import materialise
from ..sources import fixtures as fx
from ..sources import sinks as SK
from ..sources.tables import table
from .common import enriched, r6, round6
from .registry import register
from .sqlbits import iforest_ctes, matrix_sql, vif_prune_sql, vif_sql


def _knn_sql(c: str, other: str) -> str:
    """Answers for the missing values of ``c``: two columns hold NULLs, so distances run over the other one."""
    return f"""
  SELECT r.id, CASE WHEN count(*) FILTER (WHERE dist = 0) > 0 THEN avg(v) FILTER (WHERE dist = 0)
                    ELSE sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0)) END AS v
  FROM (SELECT r.id, o.{c} AS v, sqrt(2.0e0 * (r.{other} - o.{other}) * (r.{other} - o.{other})) AS dist,
               row_number() OVER (PARTITION BY r.id ORDER BY sqrt(2.0e0 * (r.{other} - o.{other}) * (r.{other} - o.{other})), o.id) AS rank
        FROM u r JOIN u o ON r.{c} IS NULL AND r.{other} IS NOT NULL AND o.{c} IS NOT NULL AND o.{other} IS NOT NULL) r
  WHERE rank <= 5 GROUP BY r.id"""


@register("knn_impute", "H1", "J4", "W4", sql=f"""
WITH u AS (SELECT DISTINCT * FROM properties_dirty),
a AS ({_knn_sql("sqft_lot", "airport_distance_km")}),
b AS ({_knn_sql("airport_distance_km", "sqft_lot")})
SELECT u.id, round(coalesce(u.sqft_lot, a.v, (SELECT avg(sqft_lot) FROM u)), 6) AS sqft_lot,
       round(coalesce(u.airport_distance_km, b.v, (SELECT avg(airport_distance_km) FROM u)), 6) AS airport_distance_km
FROM u LEFT JOIN a ON u.id = a.id LEFT JOIN b ON u.id = b.id
""")
def q_knn(spark: SparkSession, sf: str) -> DataFrame:
    """KNN-imputed sqft_lot and airport distance (the candidate columns that have NULLs)."""
    d = S.dedup(fx.properties_dirty(spark, sf))
    return KN.knn_impute(d).select("id", r6("sqft_lot"), r6("airport_distance_km"))


@register("outlier_filter", "H2", "F5", sql=f"""
WITH q AS (SELECT quantile_cont(price, 0.01) AS a, quantile_cont(price, 0.99) AS b FROM properties),
fenced AS MATERIALIZED (SELECT p.* FROM properties p CROSS JOIN q WHERE price BETWEEN a - 1.5e0 * (b - a) AND b + 1.5e0 * (b - a)),
{iforest_ctes("fenced", IF.IFOREST_COLS)}
SELECT f.id, f.price, round(k.score, 6) AS anomaly_score FROM fenced f JOIN kept k ON f.id = k.id
""")
def q_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """Listings kept by the isolation forest (200 trees, ψ = 256, contamination 3 %)."""
    kept = IF.remove_outliers(OU.fence_filter(fx.properties(spark, sf)))
    return kept.select("id", "price", round6(F.col("anomaly_score")).alias("anomaly_score"))


@register("vif_report", "H3", sql=vif_sql(CO.VIF_CANDIDATES))
def q_vif_report(spark: SparkSession, sf: str) -> DataFrame:
    """VIF of every candidate column from one covariance pass."""
    return CO.vif_report(fx.properties(spark, sf)).select("column", r6("vif"), "infinite")


@register("vif_pair", "H3", sql="""
SELECT 'sqft_living' AS "column", round(1 / (1 - pow(corr(sqft_living, sqft_lot), 2)), 6) AS vif,
       false AS infinite FROM properties
UNION ALL
SELECT 'sqft_lot', round(1 / (1 - pow(corr(sqft_living, sqft_lot), 2)), 6), false FROM properties
""")
def q_vif_pair(spark: SparkSession, sf: str) -> DataFrame:
    """Two-column VIF, equal to 1/(1 − r²) (closed form, oracle-checked)."""
    return CO.vif_report(fx.properties(spark, sf), ["sqft_living", "sqft_lot"]).select(
        "column", r6("vif"), "infinite")


VIF_THREE = ["sqft_living", "sqft_lot", "grade"]


@register("vif_three", "H3", sql=" UNION ALL ".join(f"""
SELECT '{a}' AS "column", round((1 - pow(corr({b}, {c}), 2)) / (1 + 2 * corr({a}, {b}) * corr({a}, {c}) * corr({b}, {c})
       - pow(corr({a}, {b}), 2) - pow(corr({a}, {c}), 2) - pow(corr({b}, {c}), 2)), 6) AS vif, false AS infinite FROM properties"""
    for a, b, c in (VIF_THREE, VIF_THREE[1:] + VIF_THREE[:1], VIF_THREE[2:] + VIF_THREE[:2])))
def q_vif_three(spark: SparkSession, sf: str) -> DataFrame:
    """Three-column VIF: the diagonal of the inverse correlation matrix (closed form, oracle-checked)."""
    return CO.vif_report(fx.properties(spark, sf), VIF_THREE).select("column", r6("vif"), "infinite")


@register("vif_prune", "H3", "U4", sql=vif_prune_sql(CO.VIF_CANDIDATES, 10.0))
def q_vif_prune(spark: SparkSession, sf: str) -> DataFrame:
    """Columns dropped by iterative VIF pruning (threshold 10), in order."""
    return CO.vif_prune_report(fx.properties(spark, sf)).select("column", "dropped", "drop_order",
                                                                 r6("vif_at_drop"))


@register("clean_all", "M10")
def q_clean_all(spark: SparkSession, sf: str) -> DataFrame:
    """The four cleaning steps in order over the faulty listings."""
    return CL.clean_listings(fx.properties_dirty(spark, sf)).select("id", "price", "bathrooms", "floors",
                                                                    "waterfront", "sqft_lot", "airport_distance_km")


@register("clean_to_fence", "M10", "F3", "F4", sql=f"""
WITH u AS (SELECT DISTINCT * FROM properties_dirty),
a AS ({_knn_sql("sqft_lot", "airport_distance_km")}),
b AS ({_knn_sql("airport_distance_km", "sqft_lot")}),
m AS (SELECT waterfront AS mode FROM u WHERE waterfront IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
z AS (SELECT zipcode, quantile_cont(bathrooms, 0.5) AS bathrooms, quantile_cont(floors, 0.5) AS floors FROM u GROUP BY zipcode),
g AS (SELECT quantile_cont(coalesce(u.bathrooms, z.bathrooms), 0.5) AS bathrooms, quantile_cont(coalesce(u.floors, z.floors), 0.5) AS floors
      FROM u LEFT JOIN z ON u.zipcode = z.zipcode),
f AS (SELECT u.id, u.price, coalesce(u.bathrooms, z.bathrooms, g.bathrooms) AS bathrooms, coalesce(u.floors, z.floors, g.floors) AS floors,
             coalesce(u.waterfront, m.mode) AS waterfront, coalesce(u.sqft_lot, a.v, (SELECT avg(sqft_lot) FROM u)) AS sqft_lot,
             coalesce(u.airport_distance_km, b.v, (SELECT avg(airport_distance_km) FROM u)) AS airport_distance_km
      FROM u LEFT JOIN z ON u.zipcode = z.zipcode LEFT JOIN a ON u.id = a.id LEFT JOIN b ON u.id = b.id CROSS JOIN g CROSS JOIN m
      WHERE u.price IS NOT NULL),
q AS (SELECT quantile_cont(price, 0.01) AS lo, quantile_cont(price, 0.99) AS hi FROM f)
SELECT id, price, bathrooms, floors, waterfront, round(sqft_lot, 6) AS sqft_lot, round(airport_distance_km, 6) AS airport_distance_km
FROM f CROSS JOIN q WHERE price BETWEEN lo - 1.5e0 * (hi - lo) AND hi + 1.5e0 * (hi - lo)
""")
def q_clean_to_fence(spark: SparkSession, sf: str) -> DataFrame:
    """The deterministic part of the cleaning chain, up to the price fences."""
    d = CL.clean_to_fence(fx.properties_dirty(spark, sf))
    return d.select("id", "price", "bathrooms", "floors", "waterfront", r6("sqft_lot"), r6("airport_distance_km"))


@register("feature_matrix", "H9", "H10", sql=matrix_sql())
def q_feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Scaled ‖ ordinal ‖ one-hot ‖ target-encoded features of every listing (fit on all rows)."""
    e = materialise(enriched(spark, sf), "enriched")
    m = EN.apply_features(e, EN.fit_features(e), vector=False)
    return m.select(*[round6(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in m.dtypes])


def _cv(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    folds = TR.make_folds(enriched(spark, sf))
    out = materialise(TR.cross_validate(folds, kind, TR.DEFAULTS[kind]), "cv")
    return out.select("fold", "n", r6("r2"), r6("mae"), r6("rmse"))


@register("model_gbt", "M1", "M5", "C10")
def q_model_gbt(spark: SparkSession, sf: str) -> DataFrame:
    """3-fold CV of gradient-boosted trees (fold-safe features)."""
    return _cv(spark, sf, "gbt")


@register("model_forest", "M2", "M5", "C10")
def q_model_forest(spark: SparkSession, sf: str) -> DataFrame:
    """3-fold CV of a random forest."""
    return _cv(spark, sf, "forest")


@register("model_linear", "M3", "M5", "C10")
def q_model_linear(spark: SparkSession, sf: str) -> DataFrame:
    """3-fold CV of elastic-net linear regression."""
    return _cv(spark, sf, "linear")


@register("tuning_trials", "M4")
def q_tuning(spark: SparkSession, sf: str) -> DataFrame:
    """Seeded random search of every candidate, the full number of trials, each a 2-fold CV."""
    folds = TR.make_folds(enriched(spark, sf), TR.TUNE_FOLDS)
    out = reduce(DataFrame.unionByName, TR.tune_all(folds))
    return out.select("candidate", "trial", "params", r6("r2_mean"), r6("mae_mean"))


# The driver tables that the listings and their macro columns come from.
INPUTS = ("lineitem", "orders", "part", "customer", "nation")


def _version(spark: SparkSession, sf: str) -> list:
    """Digests of what a training run depends on besides its parameters: the files of its tables (name, size, time) and the code."""
    out = []
    for name in INPUTS:
        files = table(spark, sf, name).select("_metadata.file_name", "_metadata.file_size", "_metadata.file_modification_time").distinct()
        r = files.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)")).alias("h")).first()
        out.append([name, r["n"], str(r["h"])])
    code = hashlib.sha256()
    for package in ("hearth.operators", "hearth.sources", "hearth.functions", "hearth.plans"):
        for f in sorted((f for f in resources.files(package).iterdir() if f.name.endswith(".py")), key=lambda f: f.name):
            code.update(f.read_bytes())
    return [*out, code.hexdigest()]


def _artefacts(spark: SparkSession, sf: str) -> str:
    """Folder of the published training run on the tables in ``sf`` as they are now; trains and publishes one if there is none (A5)."""
    run = hashlib.sha256(json.dumps([sf, TR.DEFAULTS, TR.TRIALS, _version(spark, sf)], sort_keys=True).encode()).hexdigest()[:16]
    path = SK.default_path(spark, f"artefacts-{run}")
    if SK.current_run(spark, path) is None:
        res = TR.train(enriched(spark, sf))
        SK.save_run(spark, TR.report_frame(spark, res.report), res.importances, res.state, res.model, path)
    return SK.current_run(spark, path)


@register("train_report", "M6", "M9", "C11", "C14")
def q_train_report(spark: SparkSession, sf: str) -> DataFrame:
    """Clean → tune → CV → winner → refit → artefacts; the run report as one row, as written."""
    return SK.load_report(spark, _artefacts(spark, sf), TR.REPORT_SCHEMA)


@register("feature_importance_top", "M7", "T4")
def q_importance(spark: SparkSession, sf: str) -> DataFrame:
    """Top 12 feature importances of the refitted winner, read from the artefacts."""
    return SK.load_importances(spark, _artefacts(spark, sf)).orderBy(F.desc("importance"), "feature").limit(12)


@register("score_properties", "M8", "B24", "B27")
def q_score(spark: SparkSession, sf: str) -> DataFrame:
    """Every listing scored by the model loaded from the artefacts, with its ±12 % band and risk band."""
    state, model = SK.load_state(spark, _artefacts(spark, sf))
    x = EN.apply_features(enriched(spark, sf), state, keep=("id",))
    p = model.transform(x).select("id", F.col("prediction").alias("pred"))
    b = SC.with_risk_band(SC.with_band(p, "pred", 0.12))
    return b.select("id", r6("pred"), r6("lo"), r6("hi"), "risk_band")


@register("sink_state_roundtrip", "A5", "A6", sql="""
SELECT p.zipcode, round(p.zp, 6) AS zip_price_median, round(p.zs, 6) AS zip_sqft_median,
       round((p.n * p.m + 10 * g.prior) / (p.n + 10), 6) AS encoded, round(g.gp, 6) AS global_price_median
FROM (SELECT zipcode, quantile_cont(price, 0.5) AS zp, quantile_cont(sqft_living, 0.5) AS zs, avg(price) AS m, count(*) AS n
      FROM properties GROUP BY zipcode) p
CROSS JOIN (SELECT avg(price) AS prior, quantile_cont(price, 0.5) AS gp FROM properties) g
""")
def q_state_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Fit the feature state, write it to the shared folder, read it back: its tables by zipcode."""
    path = SK.default_path(spark, f"state-{uuid.uuid4().hex[:8]}")
    SK.save_state(EN.fit_features(materialise(enriched(spark, sf), "enriched")), None, path)
    st = SK.load_tables(spark, path)
    overall = st.engineer.global_stats.select("global_price_median").scalar()
    return st.engineer.zip_stats.join(st.target[0].table, "zipcode").select(
        "zipcode", r6("zip_price_median"), r6("zip_sqft_median"), r6("encoded"), r6(overall, "global_price_median"))


@register("sink_run_report", "A7", "C11", sql="""
SELECT 'stored' AS best_model, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std, round(avg(mae), 6) AS mae_mean,
       round(avg(rmse), 6) AS rmse_mean, CAST(sum(n) AS BIGINT) AS n_train_rows
FROM (SELECT fold, count(*) AS n, 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2, avg(abs(y - p)) AS mae,
             sqrt(avg((y - p) * (y - p))) AS rmse FROM predictions GROUP BY fold) f
""")
def q_run_report(spark: SparkSession, sf: str) -> DataFrame:
    """Report of the stored predictions, written as JSON to the shared folder and read back."""
    folds = materialise(EV.regression_metrics(fx.predictions(spark, sf), by=["fold"]), "stored-folds")
    report = EV.cv_summary(folds).select(F.lit("stored").alias("best_model"), "r2_mean", "r2_std", "mae_mean", "rmse_mean",
                                         folds.agg(F.sum("n")).scalar().alias("n_train_rows"))
    path = SK.default_path(spark, f"report-{uuid.uuid4().hex[:8]}")
    SK.write_report(report, path)
    read = spark.read.schema("best_model string, r2_mean double, r2_std double, mae_mean double, rmse_mean double, n_train_rows bigint").json(path)
    return read.select("best_model", r6("r2_mean"), r6("r2_std"), r6("mae_mean"), r6("rmse_mean"), "n_train_rows")
