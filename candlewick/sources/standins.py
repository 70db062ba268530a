"""Engine tables derived from the driver's TPC-H-like parquet (all lazy, all distributed).

| engine table      | derived from                                                      |
|-------------------|-------------------------------------------------------------------|
| bars              | lineitem by (l_suppkey, ship day): symbol = 'T' + suppkey, 5 digits up |
| sector_members    | supplier -> nation -> region (sector = lower-case region name)    |
| stock_info        | supplier: shares = |s_acctbal| + 1, market_cap = shares x last close|
| macro             | orders by month (monthly series) and by quarter (quarter-end rows)|
| daily_calendar    | every day between the first and last order date                   |
| daily_reserve     | orders by day                                                     |
| event_series      | events by (user_id, day): a short-history series                  |

Each builder aggregates with map-side partial aggregation before its shuffle, so a hot
key (one supplier holding a third of lineitem) collapses to one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from candlewick.functions.nulls import null_div


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def symbol_of(suppkey) -> F.Column:
    """Zero-padded to five digits and never cut: longer keys stay distinct."""
    return F.format_string("T%05d", suppkey)


#: Unit prices are unrelated from day to day, so they enter the price level divided by 100 on
#: top of a base of 1000: daily returns stay within a few percent and indexes stay finite.
PRICE_BASE, PRICE_SCALE = 1000.0, 100.0


def price_level(total, quantity) -> F.Column:
    return F.lit(PRICE_BASE) + null_div(total, quantity) / F.lit(PRICE_SCALE)


def bars(spark: SparkSession, sf_dir: str, start: str | None = None,
         end: str | None = None) -> DataFrame:
    """Daily OHLCV bars, one row per (symbol, trade_date).

    ``start`` / ``end`` (S7, the fetch's from/to) bound the ship day; they are written on
    the raw timestamp column so Parquet receives them as pushed filters (row groups
    outside the range are skipped).
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_shipdate")
    if start is not None:
        li = li.filter(F.col("l_shipdate") >= F.to_timestamp_ntz(F.lit(start)))
    if end is not None:
        li = li.filter(F.col("l_shipdate") < F.date_add(F.to_date(F.lit(end)), 1)
                       .cast("timestamp_ntz"))
    px = price_level(F.col("l_extendedprice"), F.col("l_quantity"))
    return (li.groupBy(symbol_of(F.col("l_suppkey")).alias("symbol"),
                       F.col("l_shipdate").cast("date").alias("trade_date"))
              .agg(F.min_by(px, F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("open_price"),
                   F.max(px).alias("high_price"),
                   F.min(px).alias("low_price"),
                   price_level(F.sum("l_extendedprice"), F.sum("l_quantity")).alias("close_price"),
                   F.sum("l_quantity").alias("volume")))


def sector_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sector, symbol): a supplier's sector is its nation's region."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (s.join(n, s.s_nationkey == n.n_nationkey)
             .join(r, n.n_regionkey == r.r_regionkey)
             .select(F.lower(F.replace(F.col("r_name"), F.lit(" "), F.lit("_"))).alias("sector"),
                     symbol_of(F.col("s_suppkey")).alias("symbol")))


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(symbol, shares_outstanding): the part of stock_info that needs no prices."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return s.select(symbol_of(F.col("s_suppkey")).alias("symbol"),
                    (F.abs(F.col("s_acctbal")) + F.lit(1.0)).alias("shares_outstanding"))


def stock_info(spark: SparkSession, sf_dir: str, bars_df: DataFrame | None = None) -> DataFrame:
    """(symbol, market_cap, shares_outstanding): cap is shares x the symbol's last close."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    b = bars_df if bars_df is not None else bars(spark, sf_dir)
    last_close = b.groupBy("symbol").agg(
        F.max_by("close_price", "trade_date").alias("last_close"))
    info = s.select(symbol_of(F.col("s_suppkey")).alias("symbol"),
                    (F.abs(F.col("s_acctbal")) + F.lit(1.0)).alias("shares_outstanding"))
    return (info.join(last_close, "symbol", "left")
                .select("symbol",
                        (F.col("shares_outstanding") * F.col("last_close")).alias("market_cap"),
                        "shares_outstanding"))


_MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august",
           "september", "october", "november", "december"]


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly macro table in the reference's layout.

    Columns: line_no, year (only on each year's first row, as in the source CSV),
    month (lower-case name), month_idx, three ``_monthly`` series and two ``_quarterly``
    series (filled on quarter-end months only), plus ``FR_Date`` (month end).
    """
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    d = F.col("o_orderdate").cast("date")
    monthly = o.groupBy(F.trunc(d, "MM").alias("m")).agg(
        F.count(F.lit(1)).cast("double").alias("order_count_monthly"),
        F.avg("o_totalprice").alias("avg_order_value_monthly"),
        F.sum("o_totalprice").alias("order_value_monthly"))
    quarterly = o.groupBy(F.add_months(F.trunc(d, "quarter"), 2).alias("m")).agg(
        F.count(F.lit(1)).cast("double").alias("order_count_quarterly"),
        F.sum("o_totalprice").alias("order_value_quarterly"))
    months = F.array(*[F.lit(m) for m in _MONTHS])
    w = Window.orderBy("m")   # the macro table has one row per month: a single small partition
    return (monthly.join(quarterly, "m", "left")
            .select(F.row_number().over(w).cast("int").alias("line_no"),
                    F.when(F.month("m") == F.min(F.month("m")).over(
                        Window.partitionBy(F.year("m"))), F.year("m")).cast("int").alias("year"),
                    F.element_at(months, F.month("m")).alias("month"),
                    F.month("m").cast("int").alias("month_idx"),
                    "order_count_monthly", "avg_order_value_monthly", "order_value_monthly",
                    "order_count_quarterly", "order_value_quarterly",
                    F.last_day("m").alias("FR_Date")))


def daily_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Receiving calendar: every day from the first to the last order date."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    bounds = o.agg(F.min("d").alias("lo"), F.max("d").alias("hi"))
    return (bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("Date"))
                  .select("Date", F.concat(F.lit("Q"), F.quarter("Date").cast("string")).alias("Quarter")))


def daily_reserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily series with the reference's reserve column names (Date, Gross, Liquid)."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice", "o_orderstatus")
    return (o.groupBy(F.col("o_orderdate").cast("date").alias("Date"))
             .agg(F.sum("o_totalprice").alias("Gross (USD)"),
                  F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
                        .otherwise(F.lit(0.0))).alias("Liquid (USD)")))


def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short daily series per user: close = mean event value of the day."""
    e = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    return (e.groupBy(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
                      F.col("ts").cast("date").alias("trade_date"))
             .agg(F.avg("value").alias("close_price"),
                  F.count(F.lit(1)).cast("double").alias("volume")))


def aligned_macro_inputs(spark: SparkSession, sf_dir: str):
    """(macro, daily_calendar, daily_reserve) for ``plans.macro.align_macro``."""
    return macro(spark, sf_dir), daily_calendar(spark, sf_dir), daily_reserve(spark, sf_dir)
