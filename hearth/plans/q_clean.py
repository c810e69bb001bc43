"""Queries for cleaning steps and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as X
from ..operators import aggregates as A
from ..operators import cleaning as CL
from ..operators import encoders as EN
from ..operators import evaluation as EV
from ..operators import impute as IM
from ..operators import outliers as OU
from ..operators import standardise as S
from ..session import materialise
from ..sources import fixtures as fx
from .common import r6
from .registry import register

FENCE_SQL = """(SELECT quantile_cont(price, 0.01) AS q1, quantile_cont(price, 0.99) AS q3 FROM {src})"""


@register("clean_drop_unlabelled", "F3", sql="SELECT id, price FROM properties_dirty WHERE price IS NOT NULL")
def q_drop_unlabelled(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without a price removed."""
    return IM.drop_unlabelled(fx.properties_dirty(spark, sf)).select("id", "price")


@register("fence_filter", "F4", "C6", sql=f"""
SELECT id, price FROM properties_dirty, {FENCE_SQL.format(src="properties_dirty")} b
WHERE price BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)
""")
def q_fence(spark: SparkSession, sf: str) -> DataFrame:
    """Price inside P1/P99 ± 1.5·(P99 − P1), inclusive."""
    return OU.fence_filter(fx.properties_dirty(spark, sf)).select("id", "price")


@register("group_median_fill", "W1", "C2", "C3", sql="""
WITH g AS (SELECT zipcode, median(bathrooms) AS b, median(floors) AS f FROM properties_dirty GROUP BY zipcode),
f1 AS (SELECT d.id, coalesce(d.bathrooms, g.b) AS bathrooms, coalesce(d.floors, g.f) AS floors
       FROM properties_dirty d LEFT JOIN g ON d.zipcode = g.zipcode)
SELECT id, coalesce(bathrooms, (SELECT median(bathrooms) FROM f1)) AS bathrooms,
       coalesce(floors, (SELECT median(floors) FROM f1)) AS floors
FROM f1
""")
def q_group_median_fill(spark: SparkSession, sf: str) -> DataFrame:
    """NULL → zipcode median, then → global median of the filled column."""
    d = fx.properties_dirty(spark, sf)
    return IM.fill_group_median(d, ["bathrooms", "floors"]).select("id", "bathrooms", "floors")


@register("mode_fill", "W2", "C1", sql="""
SELECT id, coalesce(waterfront, (SELECT waterfront FROM properties_dirty WHERE waterfront IS NOT NULL
                                 GROUP BY waterfront ORDER BY count(*) DESC, waterfront LIMIT 1)) AS waterfront
FROM properties_dirty
""")
def q_mode_fill(spark: SparkSession, sf: str) -> DataFrame:
    """NULL flag → the column's mode."""
    return IM.fill_mode(fx.properties_dirty(spark, sf), ["waterfront"]).select("id", "waterfront")


@register("agg_mode", "C1", sql="""
SELECT zipcode, "view" AS view_mode FROM (
  SELECT zipcode, "view", row_number() OVER (PARTITION BY zipcode ORDER BY count(*) DESC, "view") AS rn
  FROM properties WHERE "view" IS NOT NULL GROUP BY zipcode, "view") t WHERE rn = 1
""")
def q_agg_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Most frequent view per zipcode, smallest value on ties."""
    return A.mode_of(fx.properties(spark, sf), "view", by=["zipcode"], alias="view_mode")


@register("agg_group_median", "C2", sql="""
SELECT zipcode, median(price) AS price, median(bathrooms) AS bathrooms, median(sqft_living) AS sqft_living
FROM properties_dirty GROUP BY zipcode
""")
def q_agg_group_median(spark: SparkSession, sf: str) -> DataFrame:
    """Exact medians per zipcode (NULLs skipped)."""
    return A.medians(fx.properties_dirty(spark, sf), ["price", "bathrooms", "sqft_living"], by=["zipcode"])


@register("agg_global_median", "C3", sql="""
SELECT median(price) AS price, median(bathrooms) AS bathrooms, median(floors) AS floors,
       median(sqft_lot) AS sqft_lot FROM properties_dirty
""")
def q_agg_global_median(spark: SparkSession, sf: str) -> DataFrame:
    """Exact medians over all rows."""
    return A.medians(fx.properties_dirty(spark, sf), ["price", "bathrooms", "floors", "sqft_lot"])


@register("agg_mean_count", "C5", sql="""
SELECT zipcode, round(avg(price), 6) AS mean, count(price) AS count FROM properties GROUP BY zipcode
""")
def q_mean_count(spark: SparkSession, sf: str) -> DataFrame:
    """Mean and count of price per zipcode."""
    m = A.mean_count(fx.properties(spark, sf), "zipcode", "price")
    return m.select("zipcode", r6("mean"), "count")


QS = [0.01, 0.25, 0.5, 0.75, 0.99]


@register("agg_quantiles", "C6", sql="SELECT " + ", ".join(
    f"quantile_cont(price, {q}) AS price_p{round(q * 100):02d}" for q in QS) + " FROM properties_dirty")
def q_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact price quantiles with linear interpolation."""
    return A.quantiles_wide(fx.properties_dirty(spark, sf), ["price"], QS)


NULL_COLS = ["bathrooms", "floors", "waterfront", "sqft_lot", "airport_distance_km", "price", "bedrooms"]


@register("null_profile", "C7", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE \"{c}\" IS NULL) AS nulls, "
    f"count(*) FILTER (WHERE \"{c}\" IS NULL) > 0 AS has_nulls FROM properties_dirty" for c in NULL_COLS))
def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    """NULL count per column in one pass."""
    return A.null_profile(fx.properties_dirty(spark, sf), NULL_COLS)


@register("cleaning_audit", "C8", "U1", "F3", "F4", sql=f"""
WITH d AS (SELECT DISTINCT * FROM properties_dirty),
l AS (SELECT * FROM d WHERE price IS NOT NULL),
b AS {FENCE_SQL.format(src="l")},
f AS (SELECT l.* FROM l, b WHERE price BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1))
SELECT 0 AS step_no, 'dedup' AS step, (SELECT count(*) FROM properties_dirty) AS rows_in,
       (SELECT count(*) FROM d) AS rows_out,
       (SELECT count(*) FROM properties_dirty) - (SELECT count(*) FROM d) AS removed
UNION ALL SELECT 1, 'drop_unlabelled', (SELECT count(*) FROM d), (SELECT count(*) FROM l),
       (SELECT count(*) FROM d) - (SELECT count(*) FROM l)
UNION ALL SELECT 2, 'fence', (SELECT count(*) FROM l), (SELECT count(*) FROM f),
       (SELECT count(*) FROM l) - (SELECT count(*) FROM f)
""")
def q_cleaning_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in / out of each cleaning step."""
    d = fx.properties_dirty(spark, sf)
    rows = materialise(d.groupBy(*d.columns).agg(F.count("*").alias("copies")), "audit-rows")
    bounds = OU.fence_bounds(rows, "price")  # rows without a price don't count in a quantile
    inside = F.col("price").between(bounds.select("lower").scalar(), bounds.select("upper").scalar())
    return A.audit(rows, "copies", [("drop_unlabelled", F.col("price").isNotNull()), ("fence", inside)])


def _nulls(cols: list[str]) -> str:
    return " + ".join(f'(SELECT count(*) - count("{c}") FROM u)' for c in cols)


@register("cleaning_audit_observed", "C8", "M10", "W1", "W2", "H1", sql=f"""
WITH u AS (SELECT DISTINCT * FROM properties_dirty),
l AS (SELECT * FROM u WHERE price IS NOT NULL),
b AS {FENCE_SQL.format(src="l")},
n AS (SELECT (SELECT count(*) FROM properties_dirty) AS n0, (SELECT count(*) FROM u) AS n1, (SELECT count(*) FROM l) AS n2,
             (SELECT count(*) FROM l, b WHERE price BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)) AS n3)
SELECT step_no, step, rows_in, rows_out, rows_in - rows_out AS removed, filled FROM (
  SELECT 0 AS step_no, 'dedup' AS step, n0 AS rows_in, n1 AS rows_out, CAST(0 AS BIGINT) AS filled FROM n
  UNION ALL SELECT 1, 'mode_fill', n1, n1, {_nulls(IM.FLAG_COLS)} FROM n
  UNION ALL SELECT 2, 'group_median_fill', n1, n1, {_nulls(IM.ORDINAL_COLS)} FROM n
  UNION ALL SELECT 3, 'knn_fill', n1, n1, {_nulls(IM.KNN_CANDIDATES)} FROM n
  UNION ALL SELECT 4, 'drop_unlabelled', n1, n2, 0 FROM n
  UNION ALL SELECT 5, 'fence', n2, n3, 0 FROM n) t
""")
def q_audit_observed(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and filled values of every step of the chain up to the fence, observed while the chain itself runs."""
    audit = CL.Audit()
    materialise(CL.clean_to_fence(fx.properties_dirty(spark, sf), audit), "clean-fenced")
    return audit.report(spark)


PROFILE_COLS = ["price", "sqft_living", "bathrooms", "yr_built"]


@register("profile", "C9", sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count({c}) AS DOUBLE) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM properties"
    for c in PROFILE_COLS))
def q_profile(spark: SparkSession, sf: str) -> DataFrame:
    """count, mean, std, min, quartiles, max per column."""
    p = A.profile(fx.properties(spark, sf), PROFILE_COLS)
    return p.select("column", "count", r6("mean"), r6("std"), "min", r6("p25"), r6("p50"), r6("p75"), "max")


@register("fold_assign", "W5", sql="""
SELECT id, CAST((((id % 1000003) * 40503 + 42) % 1000003) % 3 AS INTEGER) AS fold FROM properties
""")
def q_fold_assign(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic 3-fold assignment from the row key."""
    return EV.assign_fold(fx.properties(spark, sf).select("id"), "id", 3, 42)


# ----------------------------------------------------------------- encoders

TE_STATS = """(SELECT zipcode, avg(price) AS m, count(price) AS n FROM properties
               WHERE zipcode IS NOT NULL GROUP BY zipcode)"""


@register("target_encode", "H4", "J3", "C5", sql=f"""
SELECT p.id, p.zipcode,
  round(coalesce((s.n * s.m + 10 * g.prior) / (s.n + 10), g.prior), 6) AS zipcode_te
FROM properties p LEFT JOIN {TE_STATS} s ON p.zipcode = s.zipcode
CROSS JOIN (SELECT avg(price) AS prior FROM properties) g
""")
def q_target_encode(spark: SparkSession, sf: str) -> DataFrame:
    """Smoothed target encoding of zipcode (s = 10), unseen → prior."""
    p = fx.properties(spark, sf)
    out = EN.apply_target_encoder(p.select("id", "zipcode", "price"), EN.fit_target_encoder(p, "zipcode"))
    return out.select("id", "zipcode", r6("zipcode_te"))


@register("target_encode_sigmoid", "H5", "J3", sql=f"""
SELECT p.id, p.zipcode,
  round(coalesce(g.prior * (1 - 1 / (1 + exp(-(s.n - 20) / 10.0e0)))
                 + s.m * (1 / (1 + exp(-(s.n - 20) / 10.0e0))), g.prior), 6) AS zipcode_te
FROM properties p LEFT JOIN {TE_STATS} s ON p.zipcode = s.zipcode
CROSS JOIN (SELECT avg(price) AS prior FROM properties) g
""")
def q_target_encode_sigmoid(spark: SparkSession, sf: str) -> DataFrame:
    """Sigmoid-blended target encoding (min_samples_leaf 20, smoothing 10)."""
    p = fx.properties(spark, sf)
    te = EN.fit_target_encoder(p, "zipcode", kind="sigmoid")
    return EN.apply_target_encoder(p.select("id", "zipcode"), te).select("id", "zipcode", r6("zipcode_te"))


SCALE_COLS = ["sqft_living", "waterfront", "yr_renovated", "bathrooms", "price"]


OOF_SQL = """
WITH r AS (SELECT id, zipcode, price, CAST((((id % 1000003) * 40503 + 42) % 1000003) % 3 AS INTEGER) AS fold FROM properties),
z AS (SELECT zipcode, sum(price) AS s, count(price) AS n FROM r GROUP BY 1),
o AS (SELECT zipcode, fold, sum(price) AS s, count(price) AS n FROM r GROUP BY 1, 2),
f AS (SELECT fold, sum(price) AS s, count(price) AS n FROM r GROUP BY 1),
t AS (SELECT sum(price) AS s, count(price) AS n FROM r),
e AS (SELECT r.id, r.fold, z.n - o.n AS n, (z.s - o.s) / nullif(z.n - o.n, 0) AS m, (t.s - f.s) / (t.n - f.n) AS prior
      FROM r JOIN z USING (zipcode) JOIN o ON o.zipcode = r.zipcode AND o.fold = r.fold JOIN f ON f.fold = r.fold CROSS JOIN t)
SELECT id, fold, round((n * coalesce(m, prior) + 10 * prior) / (n + 10), 6) AS zipcode_te,
       round(coalesce(prior * (1 - 1 / (1 + exp(-(n - 20) / 10.0e0))) + m / (1 + exp(-(n - 20) / 10.0e0)), prior), 6) AS zipcode_te_sigmoid FROM e
"""


@register("target_encode_oof", "H4", "H5", "J3", "C5", sql=OOF_SQL)
def q_target_oof(spark: SparkSession, sf: str) -> DataFrame:
    """Both target encodings of zipcode out of fold: each row's from the rows of the other two folds."""
    rows = materialise(EV.assign_fold(fx.properties(spark, sf).select("id", "zipcode", "price"), "id"), "oof-rows")
    out = rows
    for name, kind in (("zipcode_te", "smoothed"), ("zipcode_te_sigmoid", "sigmoid")):
        te = EN.fit_target_parts(rows, "zipcode", {0: F.lit(True)}, inner="fold", kind=kind)[0]
        out = EN.apply_target_encoder(out, te, name, inner=F.col("fold"))
    return out.select("id", "fold", r6("zipcode_te"), r6("zipcode_te_sigmoid"))


@register("robust_scale", "H6", "C6", sql="SELECT id, " + ", ".join(
    f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM properties)) / "
    f"(SELECT CASE WHEN quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) = 0 THEN 1.0e0 "
    f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM properties), 6) AS {c}"
    for c in SCALE_COLS) + " FROM properties")
def q_robust_scale(spark: SparkSession, sf: str) -> DataFrame:
    """(x − median) / IQR with zero IQR → 1 (rare flags keep their signal)."""
    p = fx.properties(spark, sf)
    st = EN.fit_robust_scaler(p, SCALE_COLS)
    return p.select("id", *EN.robust_scale_columns(st)).select("id", *[r6(c) for c in SCALE_COLS])


ORD_COLS = ["grade", "sale_year", "view"]


@register("ordinal_encode", "H7", sql="SELECT p.id, " + ", ".join(
    f"CAST(o{i}.code AS INTEGER) AS \"{c}\"" for i, c in enumerate(ORD_COLS)) + " FROM properties p " + " ".join(
    f"LEFT JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
    f"(SELECT DISTINCT \"{c}\" AS v FROM properties WHERE \"{c}\" IS NOT NULL) d) o{i} ON p.\"{c}\" = o{i}.v"
    for i, c in enumerate(ORD_COLS)))
def q_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    """Ascending category codes; unknown → −1."""
    p = fx.properties(spark, sf)
    return EN.apply_ordinal(p.select("id", *ORD_COLS), EN.fit_ordinal(p, ORD_COLS))


SEASONS = ["fall", "spring", "summer", "winter"]


@register("one_hot", "H8", sql="SELECT id, " + ", ".join(
    f"CASE WHEN sale_season = '{s}' THEN 1.0e0 ELSE 0.0e0 END AS sale_season_{s}" for s in SEASONS)
    + """ FROM (SELECT id, CASE WHEN sale_month IN (12, 1, 2) THEN 'winter' WHEN sale_month IN (3, 4, 5) THEN 'spring'
       WHEN sale_month IN (6, 7, 8) THEN 'summer' WHEN sale_month IN (9, 10, 11) THEN 'fall'
       ELSE 'spring' END AS sale_season FROM properties) t""")
def q_one_hot(spark: SparkSession, sf: str) -> DataFrame:
    """One 0/1 column per season."""
    p = fx.properties(spark, sf).select("id", X.sale_season().alias("sale_season"))
    return p.select("id", *EN.one_hot_columns(EN.CATEGORIES))
