"""Hand-computed edge cases of the row-local functions (nulls, zero divisors, ties, defaults)."""

from pyspark.sql import functions as F

from hearth.functions import columns as X
from hearth.operators import standardise as S


def test_feature_edges(spark):
    df = spark.createDataFrame(
        [(1, 2000, 1990, 0, 500.0, 1000.0, 3, 0.0, 7, 4, 1, 2, 12),
         (2, 2000, None, 1995, 0.0, 0.0, 2, 5.0, 8, 3, 1, 0, 4),
         (3, 1990, 2000, 0, 2000.0, 1000.0, 1, 10.0, 5, 5, 0, 3, 13)],
        "id int, sale_year int, yr_built int, yr_renovated int, sqft_basement double, sqft_living double, "
        "schools_nearby int, airport_distance_km double, grade int, condition int, waterfront int, view int, "
        "sale_month int")
    r = {row["id"]: row for row in df.select(
        "id", X.property_age().alias("age"), X.has_renovated().alias("ren"),
        X.years_since_renovation(age=X.property_age()).alias("ysr"),
        X.basement_ratio().alias("br"), X.school_accessibility().alias("sa"),
        X.waterfront_view_premium().alias("wvp"), X.sale_season().alias("season")).collect()}
    assert r[1]["age"] == 10 and r[1]["ren"] == 0 and r[1]["ysr"] == 10
    assert r[2]["age"] is None and r[2]["ren"] == 1 and r[2]["ysr"] == 5
    assert r[3]["age"] == 0 and r[3]["ysr"] == 0           # clipped at zero
    assert r[1]["br"] == 0.5 and r[2]["br"] == 0.0 and r[3]["br"] == 1.0  # zero living → 0; clip 1
    assert r[1]["sa"] is None                               # ln(1 + 0) = 0
    assert abs(r[3]["sa"] - 1 / __import__("math").log1p(10.0)) < 1e-12
    assert r[1]["wvp"] == 1 and r[2]["wvp"] == 0
    assert [r[i]["season"] for i in (1, 2, 3)] == ["winter", "spring", "spring"]


def test_coercion_and_codes(spark):
    df = spark.createDataFrame([(" 3.6 ", "n/a", "Y", "Very Good"), ("-2.7", "12", "x", None)],
                               "a string, b string, w string, c string")
    out = df.select(X.to_int("a").alias("a"), X.to_number("b").alias("b"),
                    X.code_map("w", X.WATERFRONT_CODES, 0).alias("w"),
                    X.code_map("c", X.CONDITION_CODES, 3).alias("c")).collect()
    assert (out[0]["a"], out[0]["b"], out[0]["w"], out[0]["c"]) == (3, None, 1, 5)
    assert (out[1]["a"], out[1]["b"], out[1]["w"], out[1]["c"]) == (-2, 12.0, 0, 3)


def test_names_trim_dedup(spark):
    df = spark.createDataFrame([("  a\t", 1), ("  a\t", 1), ("b", 2)], ["Col One ", "x"])
    n = S.normalise_names(df)
    assert n.columns == ["col_one", "x"]
    t = S.dedup(S.trim_strings(n))
    assert sorted(r["col_one"] for r in t.collect()) == ["a", "b"]


def test_scoring_rules(spark):
    from hearth.operators import scoring as SC

    df = spark.createDataFrame([(1, 100.0, 1000.0, 1, 1.0, 0, 0, 0.0)],
                               "id int, pred double, sqft_living double, grade int, bathrooms double, "
                               "view int, waterfront int, airport_distance_km double")
    rb = SC.rule_based(df).first()
    assert rb["pred"] == 1.2e6 and abs(rb["lo"] - 1.2e6 * 0.88) < 1e-6  # floor applies
    b = SC.with_risk_band(SC.with_band(df, "pred", 0.12)).first()
    assert b["risk_band"] == "Moderate"
    assert SC.with_risk_band(SC.with_band(df, "pred", 0.05)).first()["risk_band"] == "Low"
    assert SC.with_risk_band(SC.with_band(df, "pred", 0.2)).first()["risk_band"] == "Elevated"
    sc = SC.scenarios(df, "pred").collect()
    assert [round(r["value"], 6) for r in sc] == [100.0, 108.0, 104.0, 106.0, 107.0]
    ms = df.select(X.market_score(F.lit(250.0), F.lit(150.0), F.lit(180.0), F.lit(0.0)).alias("m")).first()
    assert ms["m"] == 100.0
