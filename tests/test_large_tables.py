"""The steps of the fit whose cost grew fastest: quantile rounds by key, and what is written."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from hearth.operators import aggregates as A
from hearth.operators import encoders as EN
from hearth.session import materialise


def _watched(monkeypatch):
    seen, plain = [], A.materialise
    monkeypatch.setattr(A, "materialise", lambda d, name: seen.append((name, d._jdf.queryExecution().optimizedPlan().toString())) or plain(d, name))
    return seen


def test_overall_quantiles_are_not_counted_row_by_row_again(spark, monkeypatch):
    """Two key columns, some keys null: the first counts of the overall level are sums of the groups' counts, and later rounds read bracketed rows only."""
    monkeypatch.setattr(A, "BY_VALUE", 10)
    monkeypatch.setattr(A, "DIVIDE", 4)
    rng = np.random.default_rng(9)
    rows = [(None if i % 11 == 0 else int(i % 3), "ab"[i % 2] if i % 13 else None, float(v), None if i % 5 == 0 else float(np.round(v)))
            for i, v in enumerate(rng.exponential(1e3, 3000) - 200)]
    df = materialise(spark.createDataFrame(rows, "g int, kind string, v double, w double").repartition(5), "by-two-keys")
    seen = _watched(monkeypatch)
    out = A.quantile_table(df, ["v", "w"], [0.25, 0.5], by=["g", "kind"], with_total=True).collect()
    pdf = pd.DataFrame(rows, columns=["g", "kind", "v", "w"])
    got = {(r["_lvl"], r["g"], r["kind"], r["column"], r["q"]): r["value"] for r in out}
    want = {(1, None, None, c, q): np.quantile(pdf[c].dropna(), q) for c in "vw" for q in (0.25, 0.5)}
    want |= {(0, int(g), h, c, q): np.quantile(part[c].dropna(), q) for (g, h), part in pdf.groupby(["g", "kind"]) for c in "vw" for q in (0.25, 0.5)}
    assert got.keys() == want.keys() and all(np.isclose(got[k], v, rtol=1e-12) for k, v in want.items())
    bins = [plan for name, plan in seen if name == "quantile-bins"]
    levels = next(line for line in bins[0].splitlines() if "Generate explode" in line and "_lvl" in line)
    assert bins[0].index("Aggregate") < bins[0].index(levels) < bins[0].rindex("Aggregate")  # the counts are dealt to the levels, not the rows
    assert len(bins) > 2 and not any("posexplode" in plan for plan in bins[1:-1])


def test_fit_writes_only_the_columns_that_it_reads(spark, monkeypatch):
    rows = [(i, 98000 + i % 3, 100.0 + i, 50.0 + i % 7, i % 5, f"note {i}") for i in range(60)]
    df = materialise(spark.createDataFrame(rows, "id bigint, zipcode int, price double, sqft_living double, grade int, remark string"), "fit-rows")
    wrote, plain = {}, EN.materialise
    monkeypatch.setattr(EN, "materialise", lambda d, name: wrote.setdefault(name, d.columns) and plain(d, name))
    state = EN.fit_features(df)
    assert set(wrote["engineered"]) == {"sqft_living", "market_demand_index", "size_vs_neighborhood", "grade", "zipcode", "price"}
    assert state.scaler["sqft_living"] == (float(np.median([r[3] for r in rows])), float(np.subtract(*np.quantile([r[3] for r in rows], [0.75, 0.25]))))
    assert state.target[0].table.agg(F.count("*")).first()[0] == 3


def test_cleaning_and_fits_leave_no_table_that_nothing_reads(spark):
    """The rows of the chain are on disk twice at most, compressed; what the next table was made from is gone."""
    from hearth.operators import cleaning as CL
    from hearth.session import ensure_checkpoint_dir
    from hearth.sources import fixtures as fx

    top = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:").replace("///", "/"), "tables")
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    rows = CL.clean_listings(fx.properties_dirty(spark, "/root/testdata/sf0.001"))
    kept = rows.count()
    EN.fit_feature_parts(rows.drop("noise"), {0: F.col("id") % 2 == 0, 1: F.lit(True)})
    left = sorted(set(os.listdir(top)) - before)
    names = {n.rsplit("-", 1)[0] for n in left}
    assert kept > 5000 and not names & {"clean-structure", "iforest-input", "part-rows"} and {"clean-filled", "iforest-scored", "engineered"} <= names
    scored = next(n for n in left if n.startswith("iforest-scored"))
    assert any(f.endswith(".zstd.parquet") for f in os.listdir(f"{top}/{scored}"))
