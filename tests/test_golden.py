"""Golden checks against already engineered files, read where they lie and never copied.

CANDLEWICK_GOLDEN_TICKERS and _SECTORS name folders of engineered ticker and sector CSV files,
CANDLEWICK_GOLDEN_MACRO a monthly macro CSV; a test whose variable is unset is skipped.
"""

import glob
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.functions.columns import by_suffix
from candlewick.operators import windows as W
from candlewick.plans import macro, ticker
from candlewick.sources import files

LAST = "2026-02-06"        # a bar was cut from the files after this day, behind the windows
CUT = 50                   # bars that the widest window removes from the head of every file


def golden(name: str) -> str:
    path = os.environ.get(f"CANDLEWICK_GOLDEN_{name}")
    if not path or not os.path.exists(path):
        pytest.skip(f"CANDLEWICK_GOLDEN_{name} is not set")
    return path


def head_of(values: np.ndarray, mean: np.ndarray, n: int) -> np.ndarray:
    """The n - 1 values before the first, from the moving means over n: each mean drops the value
    that left its window."""
    k = np.arange(n - 1)
    return values[k + 1] - n * (mean[k + 1] - mean[k])


def raw_closes(rows: pd.DataFrame) -> np.ndarray:
    """All closes, those of the cut head included. The 50-day means give all but the very first,
    and the first 50-day volatility leaves two roots for the first return, of which the relative
    strength index knows the right one. Prices have few decimals, which mends equal roots."""
    close = np.concatenate([head_of(rows["close_price"].to_numpy(), rows["stock_MA_50"].to_numpy(), CUT),
                            rows["close_price"].to_numpy()])
    r = 100 * (close[1:CUT] / close[:CUT - 1] - 1)                # returns 2..50 of the first window
    # sum of squares around the mean, as a quadratic in the unknown first return
    total, squares = r.sum(), (r ** 2).sum()
    a, b = 1 - 1 / CUT, -2 * total / CUT
    c = squares - total ** 2 / CUT - (CUT - 1) * rows["returns_volatility_50"].iloc[0] ** 2
    root = np.sqrt(max(b * b - 4 * a * c, 0.0))
    first = {round(close[0] / (1 + x / 100), digits) for x in ((-b + root) / (2 * a), (-b - root) / (2 * a))
             for digits in (2, 3, 4)}
    stored = rows.iloc[0]
    return min((np.round(np.concatenate([[x], close]), 4) for x in first),
               key=lambda x: abs(first_rsi(x) - stored["stock_RSI"])
               + abs(np.std(100 * (x[1:CUT + 1] / x[:CUT] - 1), ddof=1) - stored["returns_volatility_50"]))


def first_rsi(close: np.ndarray, length: int = 14) -> float:
    up, down = np.maximum(np.diff(close), 0), np.maximum(-np.diff(close), 0)
    mean = [pd.Series(x[:CUT]).ewm(alpha=1 / length, adjust=False).mean().iloc[-1] for x in (up, down)]
    return 100 * mean[0] / (mean[0] + mean[1])


def raw_bars(path: str) -> pd.DataFrame:
    rows = pd.read_csv(path, dtype={"symbol": str}, keep_default_na=False, na_values=[""])
    rows = rows[rows["trade_date"] <= LAST].reset_index(drop=True)
    volume = rows["volume"].to_numpy(float)
    early = head_of(volume, rows["stock_volume_MA_20"].to_numpy(), 20)
    day = pd.Timestamp(rows["trade_date"].iloc[0])
    return pd.DataFrame({
        "symbol": rows["symbol"].iloc[0],
        "trade_date": [*[(day - pd.Timedelta(days=CUT - k)).strftime("%Y-%m-%d") for k in range(CUT)], *rows["trade_date"]],
        "close_price": raw_closes(rows),
        "volume": np.concatenate([np.zeros(CUT - 19), early, volume])})


def test_ticker_features_equal_the_engineered_files(spark):
    paths = sorted(p for p in glob.glob(os.path.join(golden("TICKERS"), "*")) if os.path.isfile(p))
    expected = pd.concat([pd.read_csv(p, dtype={"symbol": str}, keep_default_na=False, na_values=[""]) for p in paths])
    expected = expected[expected["trade_date"] <= LAST]
    bars = spark.createDataFrame(pd.concat([raw_bars(p) for p in paths]))
    bars = bars.withColumn("trade_date", F.to_date("trade_date"))
    got = ticker.ticker_features(bars, min_rows=None).withColumn("trade_date", F.col("trade_date").cast("string")).toPandas()
    order = ["symbol", "trade_date"]
    got, expected = (x.sort_values(order, ignore_index=True) for x in (got, expected))
    assert got[order].equals(expected[order]) and len(got) > 1000
    for c in ticker.FEATURE_COLUMNS:
        scale = np.maximum(1.0, expected[c].abs())
        worst = ((got[c] - expected[c]).abs() / scale).groupby(got["symbol"]).max()
        assert worst.max() < 1e-6, (c, worst[worst >= 1e-6].to_dict())


def test_sector_index_recomputes_from_the_stored_returns(spark):
    sectors = (spark.read.option("header", True).option("recursiveFileLookup", True)
               .option("pathGlobFilter", "*_sector")
               .schema("date date, sector string, weighted_sector_returns double, n_stocks_contributing double, "
                       "sector_index double, sector_volume double").csv(golden("SECTORS")))
    w = W.series_window("sector", "date")
    rows = sectors.withColumn("again", W.compounded_index("weighted_sector_returns", w)).toPandas()
    assert len(rows) and rows.groupby("sector")["sector_index"].first().eq(100).all()
    np.testing.assert_allclose(rows["again"], rows["sector_index"], rtol=1e-12)


def test_macro_file_is_aligned_without_look_ahead(spark):
    path = golden("MACRO")
    table = files.read_macro(spark, path)
    monthly, quarterly = by_suffix(table, "_monthly"), by_suffix(table, "_quarterly")
    days = pd.bdate_range("2017-01-02", "2026-12-31")
    cal = spark.createDataFrame(pd.DataFrame({"Date": days.date, "Quarter": [f"Q{q}" for q in days.quarter]}))
    got = macro.align_macro(table, cal, dropna=False).toPandas().sort_values("Date", ignore_index=True)
    assert len(got) == len(days)

    raw = pd.read_csv(path)
    raw.columns = [c.strip() for c in raw.columns]
    raw["year"] = raw["year"].ffill().astype(int)
    assert len(monthly) + len(quarterly) > 70 and set(monthly + quarterly) <= set(raw.columns)
    by_month = {(r["year"] + r["month_idx"] // 12, r["month_idx"] % 12 + 1): r for _, r in raw.iterrows()}
    ends = raw[raw["month_idx"] % 3 == 0].dropna(subset=quarterly, how="all")
    by_quarter = {(r["year"] + r["month_idx"] // 12, r["month_idx"] // 3 % 4 + 1): r for _, r in ends.iterrows()}
    for cols, rows, part in ((monthly, by_month, days.month), (quarterly, by_quarter, days.quarter)):
        empty = pd.Series(np.nan, index=cols)
        want = [rows.get(k, empty)[cols].to_numpy(float) for k in zip(days.year, part)]
        np.testing.assert_allclose(got[cols].to_numpy(float), np.array(want), rtol=1e-12)
