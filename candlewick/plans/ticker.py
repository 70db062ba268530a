"""C1/C2 ticker feature pipeline: one plan over every symbol at once.

gate (P9) -> drop high/low (P1) -> returns (W1) -> lags (W4) -> price MAs (W6) ->
volatility (W8) -> volume MA (W10) -> RSI + MACD (W12, W14) -> dropna (P10).

Physical shape: one ``Exchange hashpartitioning(symbol)``, one ``Sort(symbol, date)``;
the gate count, all windows and the grouped fold run on that same partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlewick.functions.nulls import drop_any_null
from candlewick.operators import recursive, windows as W

FEATURE_COLUMNS = [
    "returns_pct", "lag_return1", "lag_return5", "lag_return10", "stock_MA_5", "stock_MA_20",
    "stock_MA_50", "returns_volatility_20", "returns_volatility_50", "stock_RSI", "MACD",
    "MACD_hist", "MACD_signal", "stock_volume_MA_20"]


def gate_min_history(df: DataFrame, key: str, order: str, min_rows: int = 400) -> DataFrame:
    """Keep keys with strictly more than ``min_rows`` rows.

    The count uses the same partition + order as the later windows (full frame), so it
    adds no exchange and no extra sort.
    """
    full = W.series_window(key, order).rowsBetween(Window.unboundedPreceding,
                                                    Window.unboundedFollowing)
    n = F.count(F.lit(1)).over(full)
    return df.withColumn("__n", n).filter(F.col("__n") > min_rows).drop("__n")


def ticker_features(bars: DataFrame, key: str = "symbol", order: str = "trade_date",
                    price: str = "close_price", volume: str = "volume",
                    lag_items: Sequence[int] = (1, 5, 10),
                    ma_items: Sequence[int] = (5, 20, 50),
                    vol_items: Sequence[int] = (20, 50),
                    rsi_length: int = 14, volume_items: Sequence[int] = (20,),
                    min_rows: int | None = 400,
                    drop_items: Sequence[str] = ("high_price", "low_price"),
                    dropna: bool = True) -> DataFrame:
    df = bars.drop(*[c for c in drop_items if c in bars.columns])
    if min_rows is not None:
        df = gate_min_history(df, key, order, min_rows)
    w = W.series_window(key, order)
    df = W.pct_change(df, price, "returns_pct", w, scale=100.0)
    cols = {}
    cols.update(W.lags("returns_pct", w, lag_items, name="lag_return{n}"))
    cols.update(W.moving_averages(price, w, ma_items, name="stock_MA_{n}"))
    cols.update(W.volatilities("returns_pct", w, vol_items, name="returns_volatility_{n}"))
    cols.update(W.moving_averages(volume, w, volume_items, name="stock_volume_MA_{n}"))
    df = df.withColumns(cols)
    # The grouped fold comes last: it reuses the windows' hashpartitioning(key). Placed
    # before them, its new output attributes would make Spark shuffle the bars again.
    df = recursive.add_momentum(df, key, order, price, rsi_name="stock_RSI",
                                rsi_length=rsi_length)
    # column order of the reference's engineered files: carried, returns, lags, MAs,
    # volatility, RSI, MACD, volume MA
    carried = [c for c in bars.columns if c in df.columns]
    ordered = (carried + ["returns_pct"] + list(W.lags("returns_pct", w, lag_items,
                                                       name="lag_return{n}"))
               + [f"stock_MA_{n}" for n in ma_items]
               + [f"returns_volatility_{n}" for n in vol_items]
               + ["stock_RSI", "MACD", "MACD_hist", "MACD_signal"]
               + [f"stock_volume_MA_{n}" for n in volume_items])
    df = df.select(*ordered)
    return drop_any_null(df) if dropna else df


def clean_and_save(features: DataFrame, path: str, key: str = "symbol",
                   fmt: str = "parquet") -> None:
    """Dropna then one output folder per key (``partitionBy``), like file-per-ticker."""
    (drop_any_null(features).withColumn(key, F.upper(F.col(key)))
        .repartition(key).write.mode("overwrite").partitionBy(key).format(fmt)
        .option("header", True).save(path))
