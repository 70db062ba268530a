"""Training frames C10-C12: sector features joined to aligned macro series.

All sectors are handled at once (the reference fits one sector at a time); per-sector
lags use ``partitionBy(sector)``; the macro side has one row per calendar day, and Spark decides
by its size how to join it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlewick.functions.columns import col
from candlewick.functions.nulls import drop_any_null, drop_inf_and_null, safe_div
from candlewick.operators import stats, windows as W

RESERVE_COLUMNS = ("foreign_reserve_gross(USD)_daily", "foreign_reserve_liquid(USD)_daily")
MACRO_KEYS = ("Year", "Month_idx", "Quarter", "Month")


def training_frame(sector_df: DataFrame, macro_df: DataFrame,
                   sector_lag: Sequence[str] = ("sector_volume",),
                   macro_lag: Sequence[str] = RESERVE_COLUMNS,
                   drop: Sequence[str] = MACRO_KEYS, key: str = "sector",
                   date: str = "date", macro_date: str = "Date") -> DataFrame:
    """Lag leaky columns by one row (W17), dropna each side, join on date (J1 + J8:
    left join then dropna = inner join), drop calendar keys. Keeps (sector, date)."""
    s = sector_df.withColumns({c: F.lag(col(c), 1).over(W.series_window(key, date))
                               for c in sector_lag})
    s = drop_any_null(s)
    m = macro_df.withColumnRenamed(macro_date, date)
    m = m.withColumns({c: F.lag(col(c), 1).over(Window.orderBy(date)) for c in macro_lag
                       if c in m.columns})
    m = drop_any_null(m)
    out = s.join(m, date, "inner")
    return drop_any_null(out.drop(*[c for c in drop if c in out.columns]))


def daily_training_frame(sector_df: DataFrame, reserves: DataFrame, key: str = "sector",
                         date: str = "date") -> DataFrame:
    """C11: sector table plus the daily reserve series only, both lagged one row."""
    r = reserves.withColumnsRenamed({"Date": date, "Gross (USD)": RESERVE_COLUMNS[0],
                                     "Liquid (USD)": RESERVE_COLUMNS[1]})
    r = r.withColumns({c: F.lag(col(c), 1).over(Window.orderBy(date)) for c in RESERVE_COLUMNS})
    s = sector_df.withColumn("sector_volume", F.lag("sector_volume", 1).over(
        W.series_window(key, date)))
    out = s.join(drop_any_null(r), date, "inner")
    return drop_any_null(out)


def stationary_transform(frame: DataFrame, collinear: Sequence[str], key: str = "sector",
                         date: str = "date") -> DataFrame:
    """C12 step 2: ``pct_change()`` of the collinear columns per key, inf treated as
    missing (P14), then dropna."""
    w = W.series_window(key, date)
    up_to_now = w.rowsBetween(Window.unboundedPreceding, 0)
    # pad-filled levels in one projection, then all changes in a second one
    filled = frame.withColumns({f"__f{i}": F.last(W.nan_to_null(col(c)), ignorenulls=True)
                                .over(up_to_now) for i, c in enumerate(collinear)})
    changes = {c: safe_div(F.col(f"__f{i}"), F.lag(f"__f{i}", 1).over(w)) - F.lit(1.0)
               for i, c in enumerate(collinear)}
    out = filled.withColumns(changes).select(*frame.columns)
    return drop_inf_and_null(out, collinear)


def feature_columns(frame: DataFrame, exclude: Sequence[str] = ("sector", "date")) -> list[str]:
    """Numeric columns, keys excluded."""
    from candlewick.functions.nulls import numeric_columns
    return [c for c in numeric_columns(frame) if c not in exclude]


def screen(frame: DataFrame, threshold: float = 0.85, key: str = "sector") -> DataFrame:
    """A13 on every sector's numeric features."""
    return stats.corr_screen(frame, feature_columns(frame), threshold, group=[key])
