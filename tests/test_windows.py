import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import windows as W
from candlewick.plans import ticker


def _series(spark, closes, symbol="AAA", volume=None):
    dates = pd.date_range("2020-01-01", periods=len(closes), freq="D").date
    vol = volume if volume is not None else [float(i + 1) for i in range(len(closes))]
    pdf = pd.DataFrame({"symbol": symbol, "trade_date": dates, "close_price": closes,
                        "volume": vol})
    return spark.createDataFrame(pdf, "symbol string, trade_date date, close_price double, "
                                      "volume double")


def test_windows_match_pandas(spark):
    rng = np.random.default_rng(7)
    closes = list(100 + np.cumsum(rng.normal(0, 1, 60)))
    df = _series(spark, closes)
    out = ticker.ticker_features(df, min_rows=None, dropna=False, ma_items=(5, 20),
                                 vol_items=(20,), lag_items=(1, 5)).orderBy("trade_date").toPandas()
    ref = pd.DataFrame({"close": closes})
    ref["ret"] = ref["close"].pct_change() * 100
    np.testing.assert_allclose(out["returns_pct"][1:], ref["ret"][1:], rtol=1e-12)
    np.testing.assert_allclose(out["lag_return5"][6:], ref["ret"].shift(5)[6:], rtol=1e-12)
    for n in (5, 20):
        exp = ref["close"].rolling(n).mean()
        assert out[f"stock_MA_{n}"][: n - 1].isna().all()
        np.testing.assert_allclose(out[f"stock_MA_{n}"][n - 1:], exp[n - 1:], rtol=1e-12)
    exp = ref["ret"].rolling(20).std()
    np.testing.assert_allclose(out["returns_volatility_20"][20:], exp[20:], rtol=1e-10)
    assert out["returns_volatility_20"][:20].isna().all()


def test_zero_prices_give_inf_and_nan(spark):
    df = _series(spark, [0.0, 5.0, 0.0, 0.0, 2.0])
    w = W.series_window("symbol", "trade_date")
    out = W.pct_change(df, "close_price", "r", w, scale=100.0).orderBy("trade_date").toPandas()
    r = out["r"].tolist()
    assert r[0] is None or math.isnan(r[0])
    assert r[1] == math.inf            # 0 -> 5
    assert r[2] == -100.0
    assert math.isnan(r[3])            # 0 -> 0
    assert r[4] == math.inf


def test_null_price_is_padded(spark):
    df = _series(spark, [10.0, None, 11.0])
    w = W.series_window("symbol", "trade_date")
    out = W.pct_change(df, "close_price", "r", w).orderBy("trade_date").toPandas()
    assert out["r"][1] == 0.0                                # pandas pct_change pads
    assert out["r"][2] == pytest.approx(0.1)


def test_rolling_treats_inf_as_missing(spark):
    df = _series(spark, [1.0, 2.0, float("inf"), 4.0, 5.0, 6.0, 7.0])
    w = W.series_window("symbol", "trade_date")
    out = df.withColumn("ma", W.rolling_mean("close_price", w, 3)).orderBy("trade_date").toPandas()
    exp = pd.Series([1.0, 2.0, np.inf, 4.0, 5.0, 6.0, 7.0]).rolling(3).mean()
    assert out["ma"].isna().tolist() == exp.isna().tolist()
    np.testing.assert_allclose(out["ma"].dropna(), exp.dropna())


def test_compounded_index_handles_total_loss(spark):
    df = spark.createDataFrame([("s", d, r) for d, r in
                                enumerate([0.0, 10.0, -100.0, 50.0])],
                               "sector string, d int, r double")
    w = W.series_window("sector", "d")
    out = [x.idx for x in df.withColumn("idx", W.compounded_index("r", w)).orderBy("d").collect()]
    assert out == pytest.approx([100.0, 110.0, 0.0, 0.0])
    df2 = spark.createDataFrame([("s", 0, -150.0), ("s", 1, 10.0)], "sector string, d int, r double")
    out2 = [x.idx for x in df2.withColumn("idx", W.compounded_index("r", w)).orderBy("d").collect()]
    assert out2 == pytest.approx([-50.0, -55.0])


def test_gate_is_strictly_greater(spark):
    a = _series(spark, [1.0 + i for i in range(400)], symbol="A400")
    b = _series(spark, [1.0 + i for i in range(401)], symbol="B401")
    kept = ticker.gate_min_history(a.unionByName(b), "symbol", "trade_date", 400)
    assert {r.symbol for r in kept.select("symbol").distinct().collect()} == {"B401"}


def test_no_look_ahead(spark):
    """Truncating the future never changes a past feature row."""
    rng = np.random.default_rng(3)
    closes = list(50 + np.cumsum(rng.normal(0, 1, 120)))
    full = ticker.ticker_features(_series(spark, closes), min_rows=None).toPandas()
    cut = ticker.ticker_features(_series(spark, closes[:90]), min_rows=None).toPandas()
    m = cut.merge(full, on=["symbol", "trade_date"], suffixes=("_c", "_f"))
    assert len(m) == len(cut)
    for c in ticker.FEATURE_COLUMNS:
        np.testing.assert_allclose(m[c + "_c"], m[c + "_f"], rtol=1e-12)
