"""File readers with typed schemas, entry hygiene, and the artefacts of a training run."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearth.functions import columns as X
from hearth.operators import encoders as EN
from hearth.operators import training as TR
from hearth.plans import q_models as QM
from hearth.sources import fixtures as fx
from hearth.sources import listings as L
from hearth.sources import sinks as SK
from hearth.sources.schemas import RAW_HEADER

SF = "/root/testdata/sf0.001"


def _file(folder, name, text, encoding="utf-8"):
    path = f"{folder}/{name}"
    with open(path, "w", encoding=encoding) as f:
        f.write(text)
    return path


def test_listings_file(spark, tmpdir_path):
    head = ",".join(raw for raw, _ in RAW_HEADER)
    row = ["7", "42492.0", *["3"] * (len(RAW_HEADER) - 3), "1250000.5"]
    bad = ["8", "n/a", "", *["x"] * (len(RAW_HEADER) - 4), "10"]
    df = L.read_listings(spark, _file(tmpdir_path, "a.csv", "\n".join([head, ",".join(row), ",".join(bad)])))
    types = dict(df.dtypes)
    assert types["id"] == "bigint" and types["bedrooms"] == types["sqft_living"] == types["price"] == "double"
    a, b = df.orderBy("id").collect()
    assert (a["date"], a["sale_year"], a["sale_month"], a["price"]) == (dt.date(2016, 5, 2), 2016, 5, 1250000.5)
    assert b["date"] is None and b["bedrooms"] is None and b["grade"] is None
    with pytest.raises(Exception):
        L.read_listings(spark, _file(tmpdir_path, "b.csv", head.replace("Price", "Cost") + "\n" + ",".join(row))).collect()


def test_second_market_file(spark, tmpdir_path):
    text = "id,date,price,waterfront,condition\n1,20141013T000000,221900.0,N,Good\n2,bad,1,Y,odd\n"
    a, b = L.read_second_market(spark, _file(tmpdir_path, "s.csv", text)).orderBy("id").collect()
    assert (a["date"], a["waterfront"], a["condition"], a["price"], a["schools_nearby"]) == (dt.datetime(2014, 10, 13), 0, 4, 221900.0, 2)
    assert b["date"] is None and (b["waterfront"], b["condition"], b["market_region"]) == (1, 3, "us_kc")


def test_series_file_is_latin_1(spark, tmpdir_path):
    text = "country_code,date,price\nCôte,2010-03-31,1.5\n5R,bad,x\n"
    a, b = L.read_series(spark, _file(tmpdir_path, "c.csv", text, "latin-1")).orderBy(F.desc("country_code")).collect()
    assert (a["country_code"], a["date"], a["price"]) == ("Côte", dt.date(2010, 3, 31), 1.5)
    assert b["date"] is None and b["price"] is None


def test_city_index_file(spark, tmpdir_path):
    """The shipped file's layout: seven cities, ten quarters, header names with a leading space."""
    from hearth.operators import macro as M

    quarters = ["06-2011", "09-2011", "12-2011", "03-2012", "06-2012", "09-2012", "12-2012", "03-2013", "06-2013", "09-2013"]
    last = {"All India": 169.2, "Ahmedabad": 171.7, "Bangalore": 150.4, "Chennai": 150.0, "Delhi": 215.7, "Kolkata": 173.5, "Mumbai": 169.2}
    lines = ["Particulars," + ",".join(" " + q for q in quarters)] + [c + "," + ",".join(["100.0"] * 9 + [str(v)]) for c, v in last.items()]
    wide = L.read_city_index(spark, _file(tmpdir_path, "i.csv", "\n".join(lines)))
    assert wide.columns == ["Particulars", *quarters] and dict(wide.dtypes)["06-2011"] == "double"
    assert M.latest_hpi(wide, "All India").first()[0] == 169.2
    assert M.to_long(wide).count() == 70
    assert {r["city"]: r["hpi"] for r in M.latest_slice(M.to_long(wide)).collect()} == last


def test_numbers_from_text(spark):
    df = spark.createDataFrame([(" 3.6 ", "42492.0"), ("nan", "n/a"), ("Infinity", None), ("x", "42492")], "a string, d string")
    rows = df.select(X.to_number("a").alias("n"), X.to_int("a").alias("i"), X.excel_date("d").alias("d")).collect()
    assert [(r["n"], r["i"]) for r in rows] == [(3.6, 3), (None, None), (None, None), (None, None)]
    assert [r["d"] for r in rows] == [dt.date(2016, 5, 2), None, None, dt.date(2016, 5, 2)]


def test_training_run_and_its_artefacts(spark, tmpdir_path):
    """E1 on few rows: clean, tune, cross-validate, refit, save; loading scores like the fitted objects."""
    p = fx.properties(spark, SF).drop("noise")
    small = {"gbt": {"maxIter": 2, "maxDepth": 2}, "linear": TR.DEFAULTS["linear"]}
    res = TR.train(p, candidates=("gbt", "linear"), trials={"linear": 1}, k=2, params=small)
    r = res.report
    assert r["best_model"] == max(r["all_results"], key=lambda c: r["all_results"][c]["r2_mean"])
    for one in r["all_results"].values():
        assert abs(one["r2_mean"] - np.mean(one["r2_folds"])) < 1e-9 and abs(one["r2_std"] - np.std(one["r2_folds"])) < 1e-9
    assert r["n_train_rows"] < p.count()  # the forest and the fences removed rows
    values = [v for _, v in res.importances]
    assert values == sorted(values, reverse=True) and values[0] > 0 and len(values) == r["n_features"]
    path = f"{tmpdir_path}/run"
    assert SK.current_run(spark, path) is None
    SK.save_run(spark, TR.report_frame(spark, r), res.importances, res.state, res.model, path)
    path = SK.current_run(spark, path)
    state, model = SK.load_state(spark, path)
    want = res.model.transform(EN.apply_features(p, res.state)).select("id", "prediction")
    got = model.transform(EN.apply_features(p, state)).select("id", F.col("prediction").alias("q"))
    assert want.join(got, "id").where("abs(prediction - q) > 1e-6").isEmpty()
    assert SK.load_importances(spark, path).first()["feature"] == res.importances[0][0]
    assert SK.load_report(spark, path, TR.REPORT_SCHEMA).first()["best_model"] == r["best_model"]


def test_missing_ordinals_do_not_reach_the_vector(spark):
    p = fx.properties(spark, SF).drop("noise").limit(500).withColumn("grade", F.when(F.col("id") % 2 == 0, F.col("grade")))
    m = EN.apply_features(p, EN.fit_features(p), vector=False)
    assert m.where("grade_ord is null or grade_ord = -2").count() == p.where("grade is null").count() > 0
    assert m.where("grade_ord is null").isEmpty()


def test_model_queries_ask_for_the_full_search(spark, monkeypatch):
    """No query cuts rounds, trees, trials or candidates below the operators' own defaults."""
    asked = []
    scores = spark.createDataFrame([(0, 1, 0.5, 1.0, 1.0)], "fold int, n long, r2 double, mae double, rmse double")

    def train(df, *args, **kwargs):
        asked.append(("train", args, kwargs))
        raise StopIteration

    monkeypatch.setattr(QM, "enriched", lambda spark, sf: None)
    monkeypatch.setattr(TR, "make_folds", lambda df, *a: TR.Folds([scores]))
    monkeypatch.setattr(TR, "cross_validate", lambda folds, kind, params: asked.append((kind, params)) or scores)
    monkeypatch.setattr(TR, "train", train)
    QM.q_model_gbt(spark, SF)
    QM.q_model_forest(spark, SF)
    assert asked == [("gbt", TR.DEFAULTS["gbt"]), ("forest", TR.DEFAULTS["forest"])]
    assert TR.DEFAULTS["gbt"]["maxIter"] >= 200 and TR.DEFAULTS["forest"]["numTrees"] >= 200
    asked.clear()
    with pytest.raises(StopIteration):
        QM.q_train_report(spark, SF)
    assert asked == [("train", (), {})]
    trials = []
    monkeypatch.setattr(TR.Folds, "binned", lambda self: [])
    monkeypatch.setattr(TR, "tune", lambda folds, kind, n: trials.append((kind, n)) or spark.createDataFrame(
        [(kind, 0, "{}", 0.1, 0.1)], "candidate string, trial int, params string, r2_mean double, mae_mean double"))
    assert QM.q_tuning(spark, SF).count() == 3 and sorted(trials) == [("forest", TR.TRIALS), ("gbt", TR.TRIALS), ("linear", TR.TRIALS)]


def test_artefacts_follow_the_tables(spark, tmpdir_path, monkeypatch):
    paths = []
    monkeypatch.setattr(SK, "current_run", lambda spark, path: paths.append(path) or path)
    for name in QM.INPUTS:
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmpdir_path}/{name}.parquet")
    for _ in range(2):
        QM._artefacts(spark, tmpdir_path)
    spark.read.parquet(f"{SF}/part.parquet").limit(5).write.mode("overwrite").parquet(f"{tmpdir_path}/part.parquet")
    QM._artefacts(spark, tmpdir_path)
    assert paths[0] == paths[2] != paths[4]
