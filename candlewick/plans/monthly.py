"""C13 monthly roll-up: lagged monthly macro series joined to each sector's last trading
row of the month, plus the month-over-month index return.

All sectors at once: the per-month "last row" is a grouped ``max_by`` (A4, per column,
last non-null), the macro side has one row per month and is broadcast behind a size
check, and the monthly return is a per-sector window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlewick.functions.columns import by_suffix, col
from candlewick.functions.nulls import drop_any_null
from candlewick.operators import windows as W


def monthly_macro(macro: DataFrame, date: str = "FR_Date", line_col: str = "line_no",
                  drop: Sequence[str] = ("year", "month", "month_idx")) -> DataFrame:
    """Month-end macro rows with every ``_monthly`` column lagged one month (W19; the
    reference's lag, lag, lead of the reserve pair nets to the same lag of one)."""
    m = macro.withColumn("date", F.last_day(F.col(date)))
    w = Window.orderBy(line_col)
    m = m.withColumns({c: F.lag(col(c), 1).over(w) for c in by_suffix(macro, "_monthly")})
    keep = [c for c in m.columns if c not in set(drop) | {date, line_col}]
    return m.select(*keep).withColumn("month", F.trunc("date", "MM"))


def last_row_per_month(sector_df: DataFrame, key: str = "sector",
                       date: str = "date") -> DataFrame:
    """A4 ``sort_values(date).groupby(month).last()``: per column, the last non-null value
    of the month (each column on its own)."""
    vals = [c for c in sector_df.columns if c not in (key, date)]
    return (sector_df.withColumn("month", F.trunc(date, "MM"))
            .groupBy(key, "month")
            .agg(*[F.max_by(col(c), F.when(col(c).isNotNull(), F.col(date))).alias(c)
                   for c in vals]))


def monthly_rollup(sector_df: DataFrame, macro: DataFrame, key: str = "sector",
                   date: str = "date") -> DataFrame:
    s = sector_df.withColumn("sector_volume", F.lag("sector_volume", 1).over(
        W.series_window(key, date)))
    s = last_row_per_month(drop_any_null(s), key, date)
    mm = monthly_macro(macro).drop("date")
    out = drop_any_null(s.join(mm, "month"))   # J4 + J8
    w = W.series_window(key, "month")
    out = W.pct_change(out, "sector_index", "new_monthly_returns", w, scale=100.0, fill=None)
    return out
