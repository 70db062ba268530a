"""Per-series window operators.

Every series is one key (symbol or sector) ordered by date. All functions here share a
single ``Window.partitionBy(key).orderBy(order)`` spec, so Catalyst plans one
``Exchange hashpartitioning(key)`` plus one ``Sort`` for the whole chain; frames are
always explicit ``rowsBetween`` (Spark's default frame with ``orderBy`` is RANGE).

A series holds one row per (key, date) -- bounded by the calendar, not by data volume --
so a whole key in one window task is safe even when that key is the hottest one.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from candlewick.functions.nulls import safe_div

UNBOUNDED = Window.unboundedPreceding


def series_window(key: str | Sequence[str] | None, order: str | Sequence[str]) -> WindowSpec:
    keys = [key] if isinstance(key, str) else list(key or [])
    orders = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*keys) if keys else Window
    return w.orderBy(*orders)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def _q(name: str) -> Column:
    return F.col("`" + name + "`")


def finite(c: Column) -> Column:
    """``c`` where it is a finite number, else null. pandas rolling / ewm windows treat
    +-inf exactly like NaN (missing), so windows aggregate this instead of ``c``."""
    return F.when(~F.isnan(c) & ~c.isin(float("inf"), float("-inf")), c)


def rolling_mean(c: str, w: WindowSpec, n: int) -> Column:
    """pandas ``rolling(n).mean()`` (min_periods = n): null until n finite values."""
    f, v = trailing(w, n), finite(_q(c))
    return F.when(F.count(v).over(f) == n, F.avg(v).over(f))


def rolling_std(c: str, w: WindowSpec, n: int) -> Column:
    """pandas ``rolling(n).std()`` (ddof 1, min_periods = n, non-finite = missing)."""
    f, v = trailing(w, n), finite(_q(c))
    return F.when(F.count(v).over(f) == n, F.stddev_samp(v).over(f))


def forward_fill(df: DataFrame, cols: Iterable[str], w: WindowSpec,
                 suffix: str = "") -> DataFrame:
    """P12 ``ffill``: last non-null value up to and including the current row."""
    f = w.rowsBetween(UNBOUNDED, 0)
    return df.withColumns({c + suffix: F.last(_q(c), ignorenulls=True).over(f) for c in cols})


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def pct_change(df: DataFrame, col: str, out: str, w: WindowSpec, scale: float = 1.0,
               fill: str | None = "pad", periods: int = 1) -> DataFrame:
    """W1/W2/W3 ``pct_change(periods) * scale`` with pandas zero semantics.

    ``fill='pad'`` forward-fills nulls first (the pandas default), so a null price
    yields a 0 return instead of breaking the chain; ``fill=None`` leaves them null.
    """
    src = col
    if fill == "pad":                       # pandas ffill: NaN is missing as well
        src = f"__{out}_filled"
        df = df.withColumn(src, F.last(nan_to_null(_q(col)), ignorenulls=True).over(
            w.rowsBetween(UNBOUNDED, 0)))
    prev = F.lag(_q(src), periods).over(w)
    ret = safe_div(_q(src), prev) - F.lit(1.0)
    if scale != 1.0:
        ret = ret * F.lit(float(scale))
    df = df.withColumn(out, ret)
    return df.drop(src) if src != col else df


def lags(col: str, w: WindowSpec, lag_list: Iterable[int], name: str = "{col}_lag{n}",
         ) -> dict[str, Column]:
    """W4/W5/W17/W20 ``shift(n)``; a negative n is a lead (pandas ``shift(-n)``)."""
    out = {}
    for n in lag_list:
        expr = F.lag(_q(col), n).over(w) if n >= 0 else F.lead(_q(col), -n).over(w)
        out[name.format(col=col, n=n)] = expr
    return out


def moving_averages(col: str, w: WindowSpec, sizes: Iterable[int], name: str) -> dict[str, Column]:
    """``{name.format(n=n): rolling(n).mean()}``."""
    return {name.format(n=n): rolling_mean(col, w, n) for n in sizes}


def volatilities(col: str, w: WindowSpec, sizes: Iterable[int], name: str) -> dict[str, Column]:
    """``{name.format(n=n): rolling(n).std()}``."""
    return {name.format(n=n): rolling_std(col, w, n) for n in sizes}


def compounded_index(ret: str, w: WindowSpec, base: float = 100.0) -> Column:
    """``b_t = b_{t-1} * (1 + r_t / 100)`` from ``base``, as a running product.

    ``product`` multiplies in frame order, so the result equals the sequential loop and,
    unlike ``exp(sum(log))``, handles r <= -100 (zero or sign change).
    """
    return F.lit(float(base)) * F.product(F.lit(1.0) + _q(ret) / F.lit(100.0)).over(
        w.rowsBetween(UNBOUNDED, 0))


def series_length(key: str | Sequence[str]) -> Column:
    """Rows per key, for the P9 minimum-history gate (``len(data) > 400``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))
