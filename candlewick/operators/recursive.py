"""Recursive indicators (W12-W15): RSI and MACD line / signal / histogram, without Python workers.

An exponential average is a first-order recurrence, which no window frame can express. A key's bars
are gathered into one array, which a fold steps through in date order: its state holds the averages,
and each step appends the next state. Appending copies the array so far, so the fold runs in blocks of
``BLOCK`` bars, each started from the last state of the block before; work grows with the length of a
series. The same steps serve every length. A key's array has one bar a calendar day, so its size is
bounded by the calendar (~252 bars a year), not by how much data the table holds, and it is built on
the partitioning that the caller's windows over the same key already have.

Seeding rules (fixed values that decide the numbers):
  * RSI: Wilder smoothing with alpha = 1/length (14), recursive form (``adjust=False``),
    seeded by the first price difference; null until ``length`` differences are seen;
    RSI = 100 * G / (G + L), null when G + L = 0.
  * MACD: EMA(fast=12) - EMA(slow=26), each EMA with alpha = 2/(n+1) seeded by the simple
    mean of its own first n values (null before that bar).
  * Signal: EMA(9) of the MACD line, seeded by the mean of the first 9 non-null MACD
    values. Histogram = MACD - signal.

Missing values (null, NaN, and infinite ones inside an average) are skipped as pandas does: the
average stays, and the next value meets the older weight decayed once a bar.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.functions.columns import col
from candlewick.operators.windows import finite

BLOCK = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _average(state: Column, name: str, value: Column, alpha: float) -> list[Column]:
    """Next average ``name`` and ``name_gap``, the bars since its last value."""
    y, gap = state[name], state[f"{name}_gap"]
    old = F.pow(F.lit(1.0 - alpha), gap)
    met = (F.when(gap == 1, (1.0 - alpha) * y + alpha * value)
           .otherwise((old * y + alpha * value) / (old + F.lit(alpha))))
    return [F.when(value.isNull(), y).when(y.isNull(), value).otherwise(met).alias(name),
            F.when(value.isNull(), gap + 1).otherwise(F.lit(1.0)).alias(f"{name}_gap")]


def _seeded(state: Column, name: str, value: Column, bar: Column, n: int) -> list[Column]:
    """``_average`` for an EMA(span=n) that the mean of the first ``n`` bars starts; ``bar`` counts
    them from 1. Sum and count of the first bars are kept in ``name_sum`` and ``name_n``."""
    there = (bar <= n) & value.isNotNull()
    total = state[f"{name}_sum"] + F.when(there, value).otherwise(F.lit(0.0))
    count = state[f"{name}_n"] + F.when(there, F.lit(1.0)).otherwise(F.lit(0.0))
    start = finite(F.when(count > 0, total / count))
    own = F.when(bar == n, start).when(bar > n, finite(value))
    return [*_average(state, name, own, 2.0 / (n + 1)), total.alias(f"{name}_sum"), count.alias(f"{name}_n")]


AVERAGES, SEEDED = ("g", "l"), ("fast", "slow", "sig")


def _fields(macd: bool) -> list[str]:
    """Doubles of the state."""
    seeded = SEEDED if macd else ()
    return ["x", "d", "seen_g", "seen_l", *[f for n in (*AVERAGES, *seeded) for f in (n, f"{n}_gap")],
            *([f for n in seeded for f in (f"{n}_sum", f"{n}_n")] + ["bar", "line", "line_bar"] if macd else [])]


def _step(length: int, macd: bool, fast: int, slow: int, signal: int) -> Callable[[Column, Column], Column]:
    names = _fields(macd)

    def build(parts: list[Column], names_of: list[str], rest: Column) -> Column:
        by = dict(zip(names_of, parts))
        return F.struct(*[(by[n] if n in by else rest[n]).cast("double").alias(n) for n in names])

    def step(state: Column, price: Column) -> Column:
        # 1. the difference; 2. averages of prices and differences; 3. the signal of their line
        change = price - state["x"]
        known = build([price, F.when(~F.isnan(change), change)], ["x", "d"], state)

        def averages(t: Column) -> Column:
            d = t["d"]
            gain, loss = (finite(F.when(d.isNotNull(), F.greatest(c, F.lit(0.0)))) for c in (d, -d))
            more = lambda c: F.when(c.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0))
            parts = [*_average(t, "g", gain, 1.0 / length), *_average(t, "l", loss, 1.0 / length),
                     t["seen_g"] + more(gain), t["seen_l"] + more(loss)]
            of = ["g", "g_gap", "l", "l_gap", "seen_g", "seen_l"]
            if macd:
                bar = F.when((t["bar"] > 0) | t["x"].isNotNull(), t["bar"] + 1).otherwise(t["bar"])
                for name, n in (("fast", fast), ("slow", slow)):
                    parts += _seeded(t, name, t["x"], bar, n)
                    of += [name, f"{name}_gap", f"{name}_sum", f"{name}_n"]
                parts.append(bar)
                of.append("bar")
            return build(parts, of, t)

        def line(t: Column) -> Column:
            own = t["fast"] - t["slow"]
            bar = F.when((t["line_bar"] > 0) | own.isNotNull(), t["line_bar"] + 1).otherwise(t["line_bar"])
            return build([own, bar], ["line", "line_bar"], t)

        def smoothed(t: Column) -> Column:
            return build(_seeded(t, "sig", t["line"], t["line_bar"], signal),
                         ["sig", "sig_gap", "sig_sum", "sig_n"], t)

        out = _let(known, averages)
        return _let(_let(out, line), smoothed) if macd else out

    return step


def add_momentum(df: DataFrame, key: str | Sequence[str], order: str, price: str,
                 rsi_name: str = "stock_RSI", rsi_length: int = 14,
                 macd_names: tuple[str, str, str] | None = ("MACD", "MACD_hist", "MACD_signal"),
                 fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Append RSI (and, when ``macd_names`` is given, MACD line/hist/signal) per key.

    Columns already in ``df`` pass through unchanged, so the caller's per-key partitioning and the
    carried columns are kept without a join back.
    """
    keys = [key] if isinstance(key, str) else list(key)
    length, macd = int(rsi_length or 14), bool(macd_names)
    number = col(price).cast("double")
    bar = F.struct(col(order).alias("o"), F.when(~F.isnan(number), number).alias("x"),
                   F.struct(*[col(c) for c in df.columns]).alias("r"))
    series = df.groupBy(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.array_sort(F.collect_list(bar)).alias("bars"))
    zero = lambda n: n in ("seen_g", "seen_l", "bar", "line_bar") or n.endswith(("_sum", "_n"))
    first = F.struct(*[(F.lit(0.0) if zero(n) else F.lit(None)).cast("double").alias(n) for n in _fields(macd)])
    step = _step(length, macd, fast, slow, signal)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("bars") - 1) / BLOCK).cast("int")),
                         lambda b: F.slice("bars", b * BLOCK + 1, BLOCK))

    def fold(done: Column, block: Column) -> Column:
        last = F.element_at(F.element_at(done, -1), -1)
        states = F.aggregate(block, F.array(last), lambda acc, e: F.concat(
            acc, F.array(step(F.element_at(acc, -1), e["x"]))))
        return F.concat(done, F.array(states))

    folded = F.aggregate(blocks, F.array(F.array(first)), fold)
    states = F.flatten(F.transform(F.slice(folded, 2, F.size("bars")),
                                   lambda a: F.slice(a, 2, BLOCK)))       # without the state it started from
    t = series.select(F.inline(F.arrays_zip(F.col("bars").alias("bar"), states.alias("state"))))
    state = lambda n: F.col(f"state.{n}")
    total = state("g") + state("l")
    enough = F.least(state("seen_g"), state("seen_l")) >= length
    new = [F.when(enough & (total != 0), 100.0 * state("g") / total).alias(rsi_name)]
    if macd:
        new += [state("line").alias(macd_names[0]), (state("line") - state("sig")).alias(macd_names[1]),
                state("sig").alias(macd_names[2])]
    return t.select("bar.r.*", *new)
