"""Date parsing and calendar label functions (F1-F8), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: Column | str, fmt: str | None = "yyyy-MM-dd") -> Column:
    """F1/F2 ``pd.to_datetime(..., errors='coerce')``: bad text becomes null, never raises."""
    c = _c(c)
    if fmt is None:
        return F.try_to_date(c.cast("string"))
    return F.try_to_date(c.cast("string"), fmt)


def format_date(c: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """F3 ``strftime``."""
    return F.date_format(_c(c), fmt)


def month_period(c: Column | str) -> Column:
    """F5 ``to_period('M')``: first day of the month as a date."""
    return F.trunc(_c(c), "MM")


def quarter_label(c: Column | str) -> Column:
    """'Q1'..'Q4' for any date (the daily calendar's Quarter column)."""
    return F.concat(F.lit("Q"), F.quarter(_c(c)).cast("string"))


# Quarter-end month -> quarter label, and quarter-end month -> the label of
# the following quarter (only months 3, 6, 9, 12 map; every other month gives null).
QUARTER_OF_END_MONTH = {3: "Q1", 6: "Q2", 9: "Q3", 12: "Q4"}
NEXT_QUARTER_OF_END_MONTH = {3: "Q2", 6: "Q3", 9: "Q4", 12: "Q1"}


def _month_map(m: Column, table: dict[int, str]) -> Column:
    out = None
    for k, v in table.items():
        out = (F.when(m == k, F.lit(v)) if out is None else out.when(m == k, F.lit(v)))
    return out


def quarter_of_month(month_idx: Column | str) -> Column:
    """month 3/6/9/12 -> Q1..Q4, any other month -> null."""
    return _month_map(_c(month_idx), QUARTER_OF_END_MONTH)


def next_quarter_of_month(month_idx: Column | str) -> Column:
    """month 3/6/9/12 -> the label of the next quarter (12 -> Q1), else null."""
    return _month_map(_c(month_idx), NEXT_QUARTER_OF_END_MONTH)


def next_month(month_idx: Column | str) -> Column:
    """F8 target month: m + 1, with 12 rolling over to 1."""
    m = _c(month_idx)
    return F.when(m == 12, F.lit(1)).otherwise(m + 1)


def next_month_year(year: Column | str, month_idx: Column | str) -> Column:
    """F8 target year: the year advances only for December rows."""
    return _c(year) + F.when(_c(month_idx) == 12, F.lit(1)).otherwise(F.lit(0))
