import math

import numpy as np
import pandas as pd

from candlewick.operators import recursive


def _loop_rsi(x, n=14):
    """Independent loop form of the RSI seeding rule (first difference seeds)."""
    out = [math.nan] * len(x)
    g = l_ = None
    for t in range(1, len(x)):
        d = x[t] - x[t - 1]
        up, dn = max(d, 0.0), max(-d, 0.0)
        if g is None:
            g, l_ = up, dn
        else:
            g = (1 - 1 / n) * g + up / n
            l_ = (1 - 1 / n) * l_ + dn / n
        if t >= n and g + l_ != 0:
            out[t] = 100 * g / (g + l_)
    return out


def _loop_ema(x, n, start=0):
    out = [math.nan] * len(x)
    a = 2 / (n + 1)
    if len(x) - start < n:
        return out
    e = sum(x[start:start + n]) / n
    out[start + n - 1] = e
    for t in range(start + n, len(x)):
        e = (1 - a) * e + a * x[t]
        out[t] = e
    return out


def _pandas_ewm(x, alpha):
    return pd.Series(x).replace([np.inf, -np.inf], np.nan).ewm(alpha=alpha, adjust=False).mean().to_numpy()


def _momentum(spark, series, **kw):
    """Columns of add_momentum by key, from lists of prices."""
    rows = [(k, i, None if v is None else float(v)) for k, x in series.items() for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "symbol string, d int, close_price double").repartition(4)
    out = recursive.add_momentum(df, "symbol", "d", "close_price", **kw).toPandas().sort_values("d")
    return {k: g.reset_index(drop=True) for k, g in out.groupby("symbol")}


def test_rsi_macd_match_loop_rules(spark):
    rng = np.random.default_rng(11)
    series = {str(n): list(100 + np.cumsum(rng.normal(0, 2, n))) for n in (1, 2, 14, 15, 16, 26, 34, 35, 300, 1200)}
    for k, g in _momentum(spark, series).items():
        x = series[k]
        np.testing.assert_allclose(g["stock_RSI"], _loop_rsi(x), rtol=1e-10, equal_nan=True)
        line = np.array(_loop_ema(x, 12)) - np.array(_loop_ema(x, 26))
        sig = np.full(len(x), np.nan)
        if len(x) > 33:
            sig[25:] = _loop_ema(list(line[25:]), 9)
        np.testing.assert_allclose(g["MACD"], line, rtol=1e-9, atol=1e-11, equal_nan=True)
        np.testing.assert_allclose(g["MACD_signal"], sig, rtol=1e-9, atol=1e-11, equal_nan=True)
        np.testing.assert_allclose(g["MACD_hist"], line - sig, rtol=1e-9, atol=1e-10, equal_nan=True)


def test_a_hundred_thousand_bars_agree_with_the_loop(spark):
    rng = np.random.default_rng(12)
    x = list(1000 + np.cumsum(rng.normal(0, 1, 100_000)))
    g = _momentum(spark, {"long": x})["long"]
    line = np.array(_loop_ema(x, 12)) - np.array(_loop_ema(x, 26))
    assert np.nanmax(np.abs(g["stock_RSI"].to_numpy() - _loop_rsi(x))) < 1e-9
    assert np.nanmax(np.abs(g["MACD"].to_numpy() - line)) < 1e-9
    assert np.nanmax(np.abs(g["MACD_signal"].to_numpy()[25:] - _loop_ema(list(line[25:]), 9))) < 1e-9


def test_missing_and_infinite_values_decay_as_in_pandas(spark):
    rng = np.random.default_rng(3)
    x = 50 + np.cumsum(rng.normal(0, 1, 900))
    sparse = [float(v) if rng.random() < 0.1 else None for v in x]
    gaps = [None if 100 < i < 560 or i < 4 else float(v) for i, v in enumerate(x)]
    odd = [float("nan") if i % 11 == 3 else float("inf") if i == 200 else float(v) for i, v in enumerate(x)]
    series = {"sparse": sparse, "gaps": gaps, "odd": odd}
    for k, g in _momentum(spark, series).items():
        s = pd.Series([np.nan if v is None else v for v in series[k]], dtype="float64")
        with np.errstate(invalid="ignore"):
            d = s.diff()
        up, down = (_pandas_ewm(v, 1 / 14) for v in (d.clip(lower=0), (-d).clip(lower=0)))
        enough = np.minimum(*(np.isfinite(v).cumsum() for v in (d.clip(lower=0), (-d).clip(lower=0)))) >= 14
        with np.errstate(invalid="ignore", divide="ignore"):
            want = np.where(enough & (up + down != 0), 100 * up / (up + down), np.nan)
        np.testing.assert_allclose(g["stock_RSI"], want, rtol=1e-9, equal_nan=True)
        ema = []
        for n in (12, 26):
            first = s.first_valid_index()
            y = s.copy()
            y.iloc[first + n - 1] = s.iloc[first:first + n].mean()
            y.iloc[:first + n - 1] = np.nan
            ema.append(_pandas_ewm(y, 2 / (n + 1)))
        np.testing.assert_allclose(g["MACD"], ema[0] - ema[1], rtol=1e-8, atol=1e-10, equal_nan=True)


def test_rsi_edge_cases(spark):
    rng = np.random.default_rng(5)
    series = {"flat": [5.0] * 30, "fall": [6.0] + [5.0] * 6000, "walk": list(100 + np.cumsum(rng.normal(0, 3, 500))),
              "none": [None] * 40}
    out = _momentum(spark, series, macd_names=None)
    assert out["flat"]["stock_RSI"].isna().all() and out["none"]["stock_RSI"].isna().all()     # 0 / 0
    fall = out["fall"]["stock_RSI"]
    assert fall[:14].isna().all() and fall[14:].eq(0.0).all()
    assert out["walk"]["stock_RSI"].dropna().between(0, 100).all()
    assert list(out["walk"].columns) == ["symbol", "d", "close_price", "stock_RSI"]


def test_plans_of_the_features_have_no_python_node(spark):
    import __spark_entry__ as E
    for q in ("ticker_features", "sector_features"):
        plan = E.queries()[q](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Pandas" not in plan and "Arrow" not in plan and "Python" not in plan


def test_add_momentum_grouped(spark):
    rng = np.random.default_rng(2)
    rows = []
    for sym in ("A", "B"):
        x = 100 + np.cumsum(rng.normal(0, 1, 80))
        for i, v in enumerate(x):
            rows.append((sym, i, float(v)))
    df = spark.createDataFrame(rows, "symbol string, d int, close_price double")
    out = recursive.add_momentum(df, "symbol", "d", "close_price").toPandas()
    for sym, g in out.groupby("symbol"):
        g = g.sort_values("d")
        np.testing.assert_allclose(g["stock_RSI"].to_numpy(), _loop_rsi(list(g.close_price)),
                                   rtol=1e-10, equal_nan=True)
