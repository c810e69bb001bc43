"""Exact quantiles against numpy; mode ties; two-stage fills."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.operators import aggregates as A
from hearth.operators import impute as IM
from hearth.session import materialise


def _data(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 6, n))  # group 0 is hot
    v = np.round(rng.normal(100, 30, n), 2)
    v[rng.random(n) < 0.05] = np.nan
    rows = [(int(a), None if np.isnan(b) else float(b)) for a, b in zip(g, v)]
    return spark.createDataFrame(rows, "g int, v double"), g, v


LYING = lambda v: F.pmod(F.xxhash64(v), F.lit(5)).cast("double")


@pytest.mark.parametrize("sizes", [{}, {"DIVIDE": 2, "BY_VALUE": 1, "PER_OCTAVE": 1}, {"DIVIDE": 3, "BY_VALUE": 40, "_first_bin": LYING}])
def test_quantiles_match_numpy(spark, sizes, monkeypatch):
    """Whole bins, many rounds of division, and a first bin that lies about the order."""
    for name, value in sizes.items():
        monkeypatch.setattr(A, name, value)
    df, g, v = _data(spark)
    probs = [0.01, 0.25, 0.5, 0.97]
    out = A.quantile_table(df.repartition(7), ["v"], probs, by=["g"], with_total=True).collect()
    got = {(r["g"], r["_lvl"], r["q"]): r["value"] for r in out}
    for key in sorted(set(g.tolist())):
        x = v[(g == key) & ~np.isnan(v)]
        for p in probs:
            assert abs(got[(key, 0, p)] - np.quantile(x, p)) < 1e-9
    for p in probs:
        assert abs(got[(None, 1, p)] - np.nanquantile(v, p)) < 1e-9


def test_quantiles_of_few_values_and_of_extremes(spark, monkeypatch):
    """Many ties, beside columns of both signs over the whole range of doubles."""
    monkeypatch.setattr(A, "BY_VALUE", 10)
    rng = np.random.default_rng(8)
    x, y = rng.choice([1.0, 2.0, 7.0], 500, p=[0.3, 0.45, 0.25]), rng.normal(size=500)
    z = rng.choice([-1.0, 1.0], 500) * np.exp(rng.uniform(-700, 700, 500))
    z[:3] = 0.0, -0.0, 5e-324
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), z.tolist())), "x double, y double, z double")
    probs = [0.25, 0.3, 0.5, 0.75]
    got = {(r["column"], r["q"]): r["value"] for r in A.quantile_table(df, ["x", "y", "z"], probs).collect()}
    assert all(np.isclose(got[c, p], np.quantile(v, p), rtol=1e-12, atol=1e-300) for c, v in (("x", x), ("y", y), ("z", z)) for p in probs) and len(got) == 12


def test_quantiles_of_parts_come_from_the_same_passes(spark):
    rng = np.random.default_rng(3)
    x, fold = rng.normal(size=900), rng.integers(0, 3, 900)
    rows = [(int(f), float(a), *[float(a * (k + 1)) for k in range(3)]) for f, a in zip(fold, x)]
    df = spark.createDataFrame(rows, "fold int, x double, y0 double, y1 double, y2 double")
    out = A.quantile_table(df, ["x", "y"], [0.25, 0.5], parts={k: F.col("fold") != k for k in range(3)}, own={"y": {k: f"y{k}" for k in range(3)}})
    got = {(r["_part"], r["column"], r["q"]): r["value"] for r in out.collect()}
    for k in range(3):
        for q in (0.25, 0.5):
            want = np.quantile(x[fold != k], q)
            assert abs(got[k, "x", q] - want) < 1e-12 and abs(got[k, "y", q] - np.quantile(x[fold != k] * (k + 1), q)) < 1e-12


def test_mode_smallest_on_ties(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 3), (1, 1), (2, 5), (2, None)], "k int, v int")
    got = {r["k"]: r["v"] for r in A.mode_of(df, "v", by=["k"]).collect()}
    assert got == {1: 1, 2: 5}


def test_group_median_fill_two_stage(spark):
    rows = [(1, 1.0), (1, None), (1, 3.0), (2, None), (2, None), (3, 10.0)]
    df = spark.createDataFrame(rows, "zipcode int, floors double")
    out = [r["floors"] for r in IM.fill_group_median(df, ["floors"]).orderBy("zipcode").collect()]
    # zip 1 → 2.0; zip 2 has no value → global median of the FILLED column [1,2,3,10] = 2.5
    assert sorted(out) == sorted([1.0, 2.0, 3.0, 2.5, 2.5, 10.0])


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, 4)], "a int, b int")
    got = {r["column"]: r["nulls"] for r in A.null_profile(df).collect()}
    assert got == {"a": 1, "b": 2}


def test_columns_without_keys_are_counted_side_by_side(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(A, "BY_VALUE", 50)  # so that brackets are divided too
    rows = [(int(i % 3), float(a), None if i % 7 == 0 else float(b), float("nan") if i % 5 == 0 else float(np.round(b)))
            for i, (a, b) in enumerate(zip(rng.exponential(1e5, 3000) - 2e4, rng.normal(size=3000)))]
    df = spark.createDataFrame([*rows, (0, float("inf"), 0.0, -0.0), (1, 0.0, None, None)], "f int, a double, b double, c double").repartition(5)
    written = materialise(df, "side-by-side")
    got = {(r["_part"], r["column"], r["q"]): r["value"] for r in A.quantile_table(written, ["a", "b", "c"], [0.1, 0.5, 0.99], parts={0: F.col("f") != 0, 1: F.lit(True)}).collect()}
    pdf = written.toPandas()
    for p, part in ((0, pdf[pdf.f != 0]), (1, pdf)):
        for c in "abc":
            for q in (0.1, 0.5, 0.99):
                assert np.isclose(got[p, c, q], np.quantile(part[c].dropna().to_numpy(), q), rtol=1e-12, atol=1e-12)
    # the rows of the columns are never spread out, one row for each value
    seen = []
    plain = A.materialise
    monkeypatch.setattr(A, "materialise", lambda d, name: seen.append(d._jdf.queryExecution().optimizedPlan().toString()) or plain(d, name))
    A.quantile_table(written, ["a", "b"], [0.5], parts={0: F.lit(True)})
    assert any("MapInArrow" in plan for plan in seen) and not any("posexplode" in plan for plan in seen)
