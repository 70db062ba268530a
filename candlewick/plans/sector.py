"""Sector pipelines C3-C8: cap-weighted sector returns, index, volume and features.

One long table of all sectors replaces the reference's folder-per-sector loop:

  bars --W1 by symbol--> returns --join members (broadcast, size-checked)-->
  --join shares (broadcast, size-checked)--> daily cap --groupBy(sector, date)--> one
  partial-aggregated shuffle computing total cap, weighted return, coverage and volume
  in a single pass --W16 running product by sector--> sector index.

A hot sector or a hot date only grows the partial aggregates, never one task's input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from candlewick.functions.dates import parse_date
from candlewick.functions.nulls import drop_any_null, nan_to_null, sum0
from candlewick.operators import recursive, windows as W

SECTOR_DAILY_COLUMNS = ["date", "sector", "weighted_sector_returns", "n_stocks_contributing",
                        "sector_index", "sector_volume"]


def _member_bars(bars: DataFrame, members: DataFrame, key: str, order: str,
                 start: str | None, end: str | None) -> DataFrame:
    day = F.col(order)
    if dict(bars.dtypes)[order] == "string":                   # F1: bad text -> null
        day = parse_date(day)
    b = bars.select(key, day.alias(order), "close_price", "volume")
    w = W.series_window(key, order)
    b = W.pct_change(b, "close_price", "returns_pct", w, scale=100.0)
    b = b.filter(F.col(order).isNotNull())                      # A6: NaT keys are dropped
    if start is not None:
        b = b.filter(F.col(order) >= F.lit(start).cast("date"))
    if end is not None:
        b = b.filter(F.col(order) <= F.lit(end).cast("date"))
    return b.join(members.select("sector", key), key)


def sector_daily(bars: DataFrame, members: DataFrame, shares: DataFrame,
                 key: str = "symbol", order: str = "trade_date",
                 start: str | None = None, end: str | None = None,
                 base: float = 100.0) -> DataFrame:
    """C5 + C6 + C7 with W24 daily cap weights.

    ``shares``: (symbol, shares_outstanding), one row per symbol. Symbols without a row
    there contribute volume only (they are skipped for returns, as in the reference).
    Per (sector, date):
      weighted_sector_returns = sum(ret_i * cap_i / total_cap), 0.0 when nothing sums
      n_stocks_contributing   = number of non-null caps
      sector_volume           = sum of all members' volume (0.0 when all null)
    Dates with no priced member are dropped; then the base-100 running index.
    """
    x = _member_bars(bars, members, key, order, start, end)
    sh = shares.select(key, F.col("shares_outstanding").cast("double").alias("__shares"),
                       F.lit(True).alias("__priced"))
    x = x.join(sh, key, "left").withColumn("__cap", F.col("close_price") * F.col("__shares"))
    contrib = nan_to_null(F.col("returns_pct") * F.col("__cap"))
    agg = (x.groupBy("sector", F.col(order).alias("date"))
             .agg(sum0(contrib).alias("__num"),
                  sum0("__cap").alias("__total"),
                  F.count("__cap").cast("double").alias("n_stocks_contributing"),
                  F.count("__priced").alias("__n_priced"),
                  sum0("volume").alias("sector_volume"))
             .filter(F.col("__n_priced") > 0))
    ret = F.when(F.col("__total") == 0, F.lit(0.0)).otherwise(F.col("__num") / F.col("__total"))
    agg = agg.withColumn("weighted_sector_returns", ret)
    ws = W.series_window("sector", "date")
    agg = agg.withColumn("sector_index", W.compounded_index("weighted_sector_returns", ws, base))
    return agg.select(*SECTOR_DAILY_COLUMNS)


def sector_static_weighted(bars: DataFrame, members: DataFrame, caps: DataFrame,
                           key: str = "symbol", order: str = "trade_date",
                           start: str | None = None, end: str | None = None,
                           base: float = 100.0) -> DataFrame:
    """C3 + C4: one fixed weight per symbol = market_cap / sector market cap (today's cap
    used for all history), summed per (sector, date), then the running index."""
    x = _member_bars(bars, members, key, order, start, end)
    c = caps.select(key, F.col("market_cap").cast("double").alias("market_cap"))
    mc = members.select("sector", key).join(c, key)
    sector_cap = mc.groupBy("sector").agg(F.sum("market_cap").alias("__sector_cap"))
    weights = (mc.join(sector_cap, "sector")
                 .select("sector", key, (F.col("market_cap") / F.col("__sector_cap"))
                         .alias("stock_weight")))
    x = x.join(weights, ["sector", key])
    agg = (x.groupBy("sector", F.col(order).alias("date"))
             .agg(sum0(nan_to_null(F.col("returns_pct") * F.col("stock_weight")))
                  .alias("weighted_sector_returns")))
    ws = W.series_window("sector", "date")
    return (agg.withColumn("sector_index",
                           W.compounded_index("weighted_sector_returns", ws, base))
               .select("date", "sector", "weighted_sector_returns", "sector_index"))


def sector_features(sector_df: DataFrame, lag_returns: Sequence[int] | None = None,
                    moving_avg: Sequence[int] | None = None,
                    rolling_vol: Sequence[int] | None = None, rsi: int | None = None,
                    ma_con_div: bool = True, vol_moving_avg: Sequence[int] | None = None,
                    key: str = "sector", order: str = "date") -> DataFrame:
    """C8 with the reference's defaults ([1], [5], [20], 14, MACD on, [20]) then dropna."""
    lag_returns = list(lag_returns or [1])
    moving_avg = list(moving_avg or [5])
    rolling_vol = list(rolling_vol or [20])
    vol_moving_avg = list(vol_moving_avg or [20])
    w = W.series_window(key, order)
    cols = {}
    cols.update(W.lags("weighted_sector_returns", w, lag_returns, name="sector_lag_return{n}"))
    cols.update(W.moving_averages("sector_index", w, moving_avg, name="sector_index_MA_{n}"))
    cols.update(W.volatilities("weighted_sector_returns", w, rolling_vol,
                               name="sector_returns_volatility_{n}"))
    cols.update(W.moving_averages("sector_volume", w, vol_moving_avg,
                                  name="sector_stock_volume_MA_{n}"))
    df = sector_df.withColumns(cols)            # all windows share one exchange + sort
    macd_names = ("sector_MACD", "sector_MACD_hist", "sector_MACD_signal") if ma_con_div else None
    df = recursive.add_momentum(df, key, order, "sector_index", rsi_name="sector_index_RSI",
                                rsi_length=rsi or 14, macd_names=macd_names)
    vol_ma = [f"sector_stock_volume_MA_{n}" for n in vol_moving_avg]
    ordered = [c for c in df.columns if c not in vol_ma] + vol_ma
    return drop_any_null(df.select(*ordered))
