import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import folds, metrics, models, stats
from candlewick.plans import macro


def _macro(spark):
    rows = []
    line = 0
    for y in (2017, 2018):
        for m in range(1, 13):
            line += 1
            q = float(line) if m in (3, 6, 9, 12) else None
            rows.append((line, y if m == 1 else None, m, float(line * 10), q))
    return spark.createDataFrame(rows, "line_no int, year int, month_idx int, "
                                       "cpi_monthly double, gdp_quarterly double")


def _calendar(spark):
    d = pd.date_range("2017-01-01", "2019-03-31", freq="D")
    pdf = pd.DataFrame({"Date": d.date, "Quarter": ["Q%d" % q for q in d.quarter]})
    return spark.createDataFrame(pdf, "Date date, Quarter string")


def test_macro_alignment_shifts_one_period(spark):
    out = macro.align_macro(_macro(spark), _calendar(spark), dropna=False)
    rows = {r.Date.isoformat(): r for r in out.collect()}
    # January 2017 value (line 1) becomes usable in February 2017
    assert rows["2017-02-10"].cpi_monthly == 10.0
    assert rows["2017-01-10"].cpi_monthly is None
    # December 2017 (line 12) -> January 2018
    assert rows["2018-01-05"].cpi_monthly == 120.0
    # Q4 2017 (line 12, December) -> Q1 2018; Q1 2017 (line 3) -> Q2 2017
    assert rows["2018-02-01"].gdp_quarterly == 12.0
    assert rows["2017-05-01"].gdp_quarterly == 3.0
    assert rows["2017-03-01"].gdp_quarterly is None
    # Q4 2018 (December 2018) reaches Q1 2019
    assert rows["2019-03-31"].gdp_quarterly == 24.0


def test_last_writer_wins_including_nulls(spark):
    m = _macro(spark)
    dup = spark.createDataFrame([(99, 2017, 1, None, None)], m.schema)
    out = macro.align_macro(m.unionByName(dup), _calendar(spark), dropna=False)
    feb = out.where(F.col("Date") == F.lit("2017-02-10").cast("date")).first()
    assert feb.cpi_monthly is None          # the later source row (line 99) overwrote with null


def test_lag_features_dispatch(spark):
    a = macro.align_macro(_macro(spark), _calendar(spark), dropna=False).where(
        F.col("cpi_monthly").isNotNull())
    a = a.withColumn("fx_daily", F.datediff("Date", F.lit("2017-01-01")).cast("double"))
    out = macro.lag_features(a, {"fx_daily": [1, 0], "cpi_monthly": [1, -1],
                                 "gdp_quarterly": [1], "other_weekly": [1]})
    assert "fx_daily_lag0" not in out.columns and "other_weekly_lag1" not in out.columns
    r = out.where(F.col("Date") == F.lit("2017-04-15").cast("date")).first()
    assert r.fx_daily_lag1 == r.fx_daily - 1
    assert r.cpi_monthly_lag1 == 20.0 and r["cpi_monthly_lag-1"] == 40.0


@pytest.mark.parametrize("sort_rows", [40, 100_000])
def test_describe_equals_pandas_whatever_one_task_sorts(spark, monkeypatch, sort_rows):
    monkeypatch.setattr(stats, "SORT_ROWS", sort_rows)
    rng = np.random.default_rng(4)
    n = 20_000
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], n, p=[0.9, 0.0995, 0.0005]),
                        "x.y": rng.normal(size=n), "heavy": np.exp(rng.normal(0, 60, n)),
                        "ties": rng.choice([0.0, 1.0, 2.0], n, p=[0.3, 0.2, 0.5]), "none": np.full(n, np.nan)})
    pdf.loc[rng.random(n) < 0.1, "x.y"] = np.nan
    df = spark.createDataFrame(pdf).repartition(6)
    cols = ["x.y", "heavy", "ties", "none"]
    got = stats.describe(df, cols, ["g"]).toPandas()
    assert len(got) == 4 * 3
    for r in got.itertuples():
        x = pdf[pdf["g"].isna() if pd.isna(r.g) else pdf["g"] == r.g][r.column].describe()
        assert int(got.loc[r.Index, "count"]) == int(x["count"])
        for a, b in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"),
                     ("max", "max")):
            assert got.loc[r.Index, a] == pytest.approx(x[b], rel=1e-9, abs=1e-12, nan_ok=True), (r.g, r.column, a)
    whole = stats.describe(df, ["ties"]).collect()
    assert [tuple(r)[5:8] for r in whole] == [tuple(pdf["ties"].quantile([0.25, 0.5, 0.75]))]


def test_corr_at_eighty_columns_equals_pandas(spark):
    rng = np.random.default_rng(8)
    k, n = 80, 3000
    x = rng.normal(size=(n, k)) @ rng.normal(size=(k, k)) * 0.2 + rng.normal(size=(n, k))
    x += 10.0 ** rng.integers(-3, 9, k)                       # levels far from zero
    x[rng.random((n, k)) < 0.1] = np.nan
    x[:, 7] = 3.25                                            # constant
    x[:, 9] = np.nan                                          # never there
    x[::2, 11], x[1::2, 12] = np.nan, np.nan                  # never there together
    x[5, 13] = np.inf
    pdf = pd.DataFrame(x, columns=[f"c {i}.x" for i in range(k)])
    pdf["g"] = [None if i % 3 == 0 else f"g{i % 3}" for i in range(n)]
    df = spark.createDataFrame(pdf).repartition(7)
    got = stats.corr_long(df, list(pdf.columns[:k]), ["g"]).toPandas()
    assert len(got) == 3 * k * k
    for g, part in got.groupby("g", dropna=False):
        want = pdf[pdf["g"].isna() if pd.isna(g) else pdf["g"] == g][pdf.columns[:k]]
        with np.errstate(invalid="ignore"):
            want = want.corr().to_numpy()
        m = np.full((k, k), 9.0)
        m[part["i"], part["j"]] = part["corr"]
        level = 1e-5                                          # pandas' own error at levels of 1e8
        assert np.array_equal(np.isnan(m), np.isnan(want))
        assert np.nanmax(np.abs(m - want)) < level


def test_corr_shift_keeps_small_variances_on_high_levels(spark):
    x = np.arange(1000.0)
    df = spark.createDataFrame(pd.DataFrame({"a": 1e12 + x, "b": 1e12 - x, "c": 1e12 + (x % 2)})).repartition(5)
    m = {(r.i, r.j): r.corr for r in stats.corr_long(df, ["a", "b", "c"]).collect()}
    assert m[(0, 1)] == pytest.approx(-1, abs=1e-12)
    assert m[(0, 2)] == pytest.approx(np.corrcoef(x, x % 2)[0, 1], rel=1e-9)


def test_corr_holds_few_groups_at_a_time(spark):
    n = stats.GROUPS_HELD * 3 + 1
    rows = [(g, float(v), float((v * g) % 5)) for g in range(n) for v in range(6)]
    df = spark.createDataFrame(rows, "g int, a double, b double").repartition(3)
    got = {(r.g, r.i, r.j): r.corr for r in stats.corr_long(df, ["a", "b"], ["g"]).collect()}
    assert len(got) == 4 * n
    want = pd.DataFrame(rows, columns=["g", "a", "b"]).groupby("g")[["a", "b"]].corr()
    for g in range(n):
        assert got[(g, 0, 1)] == pytest.approx(want.loc[(g, "a"), "b"], abs=1e-12, nan_ok=True)


def test_corr_constant_column_is_nan_and_screen_lower_triangle(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=50)
    pdf = pd.DataFrame({"a": x, "b": 2 * x + 0.001 * rng.normal(size=50),
                        "c": np.ones(50), "d": rng.normal(size=50)})
    df = spark.createDataFrame(pdf)
    m = {(r.col_i, r.col_j): r.corr for r in stats.corr_long(df, list(pdf.columns)).collect()}
    assert math.isnan(m[("a", "c")]) and m[("a", "a")] == 1.0
    assert m[("a", "b")] == pytest.approx(pdf.corr().loc["a", "b"], rel=1e-12)
    pairs = stats.corr_screen(df, list(pdf.columns), 0.85).collect()
    assert [(p.col_i, p.col_j) for p in pairs] == [("b", "a")]   # later column flagged


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"v": rng.normal(size=101)})
    d = stats.describe(spark.createDataFrame(pdf), ["v"]).first()
    ref = pdf["v"].describe()
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("p25", "25%"), ("p50", "50%"),
                         ("p75", "75%"), ("min", "min"), ("max", "max")]:
        assert d[ours] == pytest.approx(ref[theirs], rel=1e-12)


def _frame(spark, n=61):
    rng = np.random.default_rng(9)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 0.5 * x1 - 0.2 * x2 + 0.3 * rng.normal(size=n)
    pdf = pd.DataFrame({"sector": "s", "date": pd.date_range("2020-01-01", periods=n).date,
                        "x1": x1, "x2": x2 * 10, "y": y, "label": (y > 0).astype(int)})
    return spark.createDataFrame(pdf), pdf


def test_time_series_folds_match_rule(spark):
    df, _ = _frame(spark)
    f = folds.time_series_folds(df, ["sector"], "date", 5)
    r = metrics.fold_ranges(f, ["sector"], "date").orderBy("fold", "role").collect()
    ts = 61 // 6
    for k in range(5):
        test_start = 61 - (5 - k) * ts
        tr = [x for x in r if x.fold == k and x.role == "train"][0]
        te = [x for x in r if x.fold == k and x.role == "test"][0]
        assert (tr.first_row, tr.last_row, tr.rows) == (0, test_start - 1, test_start)
        assert (te.first_row, te.last_row, te.rows) == (test_start, test_start + ts - 1, ts)


def test_gaussian_nb_and_ridge_match_numpy(spark):
    df, pdf = _frame(spark)
    feats = ["x1", "x2"]
    f = folds.time_series_folds(df, ["sector"], "date", 5)
    sc = folds.apply_scaler(f, folds.fit_scaler(f, feats, ["sector"]), feats, ["sector"])
    nb = models.gaussian_nb(sc, feats, ["sector"]).toPandas()
    rd = models.ridge(sc, feats, ["sector"], "y", alpha=1.0).toPandas()
    ts = 61 // 6
    for k in range(5):
        s = 61 - (5 - k) * ts
        X, Xt = pdf[feats].to_numpy()[:s], pdf[feats].to_numpy()[s:s + ts]
        mu, sd = X.mean(0), X.std(0)
        Xs, Xts = (X - mu) / sd, (Xt - mu) / sd
        y, lab = pdf["y"].to_numpy()[:s], pdf["label"].to_numpy()[:s]
        eps = 1e-9 * Xs.var(0).max()
        jll = []
        for c in (0, 1):
            Z = Xs[lab == c]
            m, v = Z.mean(0), Z.var(0) + eps
            jll.append(math.log(len(Z) / s) - 0.5 * np.log(2 * np.pi * v).sum()
                       - 0.5 * (((Xts - m) ** 2) / v).sum(1))
        exp_nb = np.argmax(np.vstack(jll), axis=0)
        got_nb = nb[nb.fold == k].sort_values("row_idx")["prediction"].to_numpy()
        assert (got_nb == exp_nb).all()
        xc, yc = Xs - Xs.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(2), xc.T @ yc)
        exp_rd = y.mean() - Xs.mean(0) @ w + Xts @ w
        got_rd = rd[rd.fold == k].sort_values("row_idx")["prediction"].to_numpy()
        np.testing.assert_allclose(got_rd, exp_rd, rtol=1e-9, atol=1e-12)


def test_classification_report_zero_division(spark):
    pred = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, prediction int")
    rep = {r["class"]: r for r in metrics.classification_report(
        pred.withColumn("g", F.lit(1)), ["g"]).collect()}
    assert rep["0"].precision == 0.0 and rep["0"].recall == 0.0 and rep["0"].f1 == 0.0
    assert rep["1"].precision == pytest.approx(2 / 3) and rep["1"].recall == 1.0
    assert rep["weighted avg"].support == 3


def test_adaboost_stumps_learn_a_threshold(spark):
    from candlewick.operators import boosting
    rng = np.random.default_rng(0)
    x = rng.normal(size=80)
    pdf = pd.DataFrame({"sector": "s", "fold": 0, "role": ["train"] * 40 + ["test"] * 40,
                        "row_idx": range(80), "x": x, "label": (x > 0.2).astype(float)})
    pred, weight = boosting.fit_groups(spark.createDataFrame(pdf), ["x"], ["sector"], "adaboost")
    out = pred.toPandas()
    assert (out["prediction"] == out["label"]).mean() > 0.95
    assert [tuple(r) for r in weight.collect()] == [("s", 0, "x", 1.0)]
