"""C9 macro alignment without look-ahead, and W20-W23 frequency-aware lag features.

A value published for month m becomes usable in month m+1; a quarter-end value becomes
usable in the following quarter; daily series are joined on the same day. The
reference's row loops (``for row in iterrows(): receiving.loc[mask] = row``) are
equi-joins here, with "last writer wins" kept by picking each key's last source row.

Macro tables hold one row per month (or day): they are bounded by the calendar, so the
few order-only windows below (year fill, lag by period) run on small inputs, and the
monthly / quarterly sides are broadcast behind a size check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlewick.functions.columns import by_suffix, col
from candlewick.functions.dates import next_month, next_month_year, next_quarter_of_month
from candlewick.functions.nulls import drop_all_null, drop_any_null

RESERVE_RENAMES = {"Date": "fr_date_daily",
                   "Gross (USD)": "foreign_reserve_gross(USD)_daily",
                   "Liquid (USD)": "foreign_reserve_liquid(USD)_daily"}


def _last_row_per_key(df: DataFrame, keys: Sequence[str], order: str,
                      cols: Sequence[str]) -> DataFrame:
    """Last writer wins: the whole row with the greatest ``order`` per key (nulls kept)."""
    packed = F.max(F.struct(F.col(order).alias("__o"), *[col(c).alias(c) for c in cols]))
    return (df.groupBy(*keys).agg(packed.alias("__last"))
              .select(*keys, *[F.col("__last")[c].alias(c) for c in cols]))


def fill_year(macro: DataFrame, line_col: str = "line_no", year: str = "year") -> DataFrame:
    """P12 ``year.ffill()`` in file-line order."""
    w = Window.orderBy(line_col).rowsBetween(Window.unboundedPreceding, 0)
    return macro.withColumn(year, F.last(year, ignorenulls=True).over(w).cast("int"))


def align_macro(macro: DataFrame, calendar: DataFrame, reserves: DataFrame | None = None,
                line_col: str = "line_no", year: str = "year", month_idx: str = "month_idx",
                date: str = "Date", quarter: str = "Quarter",
                drop: Sequence[str] = ("FR_Date", "fr_date_daily"),
                dropna: bool = True) -> DataFrame:
    m = fill_year(macro, line_col, year)
    m = m.withColumns({"target_month": next_month(F.col(month_idx)),
                       "target_year": next_month_year(F.col(year), F.col(month_idx))})
    monthly = by_suffix(macro, "_monthly")
    quarterly = by_suffix(macro, "_quarterly")

    mon = _last_row_per_key(m, ["target_year", "target_month"], line_col, monthly)
    q = drop_all_null(m, quarterly) if quarterly else m          # P11
    q = (q.withColumn("target_quarter", next_quarter_of_month(F.col(month_idx)))
          .filter(F.col("target_quarter").isNotNull()))
    qtr = _last_row_per_key(q, ["target_year", "target_quarter"], line_col, quarterly)

    cal = calendar.drop(*[c for c in monthly + quarterly if c in calendar.columns])
    cal = cal.withColumns({"Year": F.year(date), "Month_idx": F.month(date)})
    out = (cal.join(mon,
                    (F.col("Year") == F.col("target_year"))
                    & (F.col("Month_idx") == F.col("target_month")), "left")
              .drop("target_year", "target_month"))
    out = (out.join(qtr,
                    (F.col(quarter) == F.col("target_quarter"))
                    & (F.col("Year") == F.col("target_year")), "left")
              .drop("target_year", "target_quarter"))
    if reserves is not None:
        r = reserves.withColumnsRenamed({k: v for k, v in RESERVE_RENAMES.items()
                                         if k in reserves.columns})
        out = out.join(r, F.col(date) == F.col("fr_date_daily"), "left")
    out = out.drop(*[c for c in drop if c in out.columns])
    return drop_any_null(out) if dropna else out


def lag_features(data: DataFrame, features_lag: Mapping[str, Sequence[int]] | None,
                 date: str = "Date", year: str = "Year", month_idx: str = "Month_idx",
                 quarter: str = "Quarter") -> DataFrame:
    """Dispatch on the frequency suffix; unknown suffixes are ignored.

    _daily     -> ``lag(f, n)`` by date, only n > 0                            (W20)
    _monthly   -> first non-null per (Year, Month_idx), lag by month present,
                  joined back; n may be negative (a lead)                        (W21)
    _quarterly -> the same per (Year, Quarter)                                   (W22)
    Output columns are ``{feature}_lag{n}``.
    """
    if not features_lag:
        return data
    daily_cols = {}
    w_day = Window.orderBy(date)
    for f, lags in features_lag.items():
        if f.endswith("_daily"):
            for n in lags:
                if n > 0:
                    daily_cols[f"{f}_lag{n}"] = F.lag(col(f), n).over(w_day)
    out = data.withColumns(daily_cols) if daily_cols else data
    for suffix, keys in (("_monthly", [year, month_idx]), ("_quarterly", [year, quarter])):
        feats = {f: lags for f, lags in features_lag.items() if f.endswith(suffix)}
        if not feats:
            continue
        first_day = {f: F.min_by(col(f), F.when(col(f).isNotNull(), F.col(date))).alias(f)
                     for f in feats}
        per = data.groupBy(*keys).agg(*first_day.values())
        w = Window.orderBy(*keys)
        lagged = per.select(*keys, *[
            (F.lag(col(f), n) if n >= 0 else F.lead(col(f), -n)).over(w).alias(f"{f}_lag{n}")
            for f, lags in feats.items() for n in lags])
        out = out.join(lagged, keys, "left")
    return out
