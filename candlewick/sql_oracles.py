"""DuckDB oracle SQL for every registered query (independent re-statements in SQL).

The driver registers the parquet tables as views; each string here recomputes a query
from those base tables. Floats are rounded to 4 places on both sides.
"""

from __future__ import annotations

# Stand-in tables as SQL common table expressions (mirrors candlewick.sources.standins).
BARS_CTE = """
li AS (
  SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         CAST(l_shipdate AS DATE) AS d,
         CASE WHEN l_quantity = 0 THEN NULL ELSE 1000 + l_extendedprice / l_quantity / 100 END AS px
  FROM lineitem),
bars AS (
  SELECT printf('T%05d', l_suppkey) AS symbol, d AS trade_date,
         arg_min(px, l_orderkey * 8 + l_linenumber) AS open_price,
         max(px) AS high_price, min(px) AS low_price,
         CASE WHEN sum(l_quantity) = 0 THEN NULL
              ELSE 1000 + sum(l_extendedprice) / sum(l_quantity) / 100 END AS close_price,
         sum(l_quantity) AS volume
  FROM li GROUP BY 1, 2)"""


def roll(fn: str, col: str, n: int, w: str = "w") -> str:
    """pandas rolling(n) with min_periods = n; non-finite values count as missing."""
    v = f"CASE WHEN isfinite({col}) THEN {col} END"
    frame = f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({v}) OVER {frame} = {n} THEN {fn}({v}) OVER {frame} END"


def momentum_ctes(src: str, key: str, price: str, prefix: str, macd: bool = True) -> str:
    """Recursive CTE computing RSI(14) and MACD(12,26,9) row by row per key.

    ``src`` must have columns (key, rn, price, sma12, sma26) with rn = 1..n per key.
    Produces CTE ``{prefix}_mom(key, rn, rsi, macd, macd_signal)``.
    """
    return f"""
{prefix}_rec AS (
  SELECT {key} AS k, rn, {price} AS c,
         CAST(NULL AS DOUBLE) AS g, CAST(NULL AS DOUBLE) AS l,
         CAST(NULL AS DOUBLE) AS e12, CAST(NULL AS DOUBLE) AS e26,
         CAST(NULL AS DOUBLE) AS msum, CAST(NULL AS DOUBLE) AS sig
  FROM {src} WHERE rn = 1
  UNION ALL
  SELECT k, rn, c, g, l, e12, e26,
         CASE WHEN rn < 26 THEN NULL WHEN rn = 26 THEN e12 - e26
              ELSE pmsum + (e12 - e26) END AS msum,
         CASE WHEN rn < 34 THEN NULL WHEN rn = 34 THEN (pmsum + (e12 - e26)) / 9.0
              ELSE (2.0 / 10.0) * (e12 - e26) + (1 - 2.0 / 10.0) * psig END AS sig
  FROM (
    SELECT s.{key} AS k, s.rn, s.{price} AS c,
           CASE WHEN s.rn = 2 THEN greatest(s.{price} - r.c, 0)
                ELSE (1 - 1.0 / 14) * r.g + (1.0 / 14) * greatest(s.{price} - r.c, 0) END AS g,
           CASE WHEN s.rn = 2 THEN greatest(r.c - s.{price}, 0)
                ELSE (1 - 1.0 / 14) * r.l + (1.0 / 14) * greatest(r.c - s.{price}, 0) END AS l,
           CASE WHEN s.rn < 12 THEN NULL WHEN s.rn = 12 THEN s.sma12
                ELSE (1 - 2.0 / 13) * r.e12 + (2.0 / 13) * s.{price} END AS e12,
           CASE WHEN s.rn < 26 THEN NULL WHEN s.rn = 26 THEN s.sma26
                ELSE (1 - 2.0 / 27) * r.e26 + (2.0 / 27) * s.{price} END AS e26,
           r.msum AS pmsum, r.sig AS psig
    FROM {prefix}_rec r JOIN {src} s ON s.{key} = r.k AND s.rn = r.rn + 1)),
{prefix}_mom AS (
  SELECT k AS {key}, rn,
         CASE WHEN rn >= 15 AND g + l <> 0 THEN 100 * g / (g + l) END AS rsi,
         e12 - e26 AS macd, sig AS macd_signal
  FROM {prefix}_rec)"""


def r4(expr: str) -> str:
    """Same rounding as ``candlewick.plans.presentation.round_half_away``."""
    return f"round(({expr}) * 10000.0) / 10000.0"


def _r(expr: str, name: str) -> str:
    return f"{r4(expr)} AS {name}"


def _s(expr: str, name: str) -> str:
    """7 significant digits, as ``presentation.round_significant``."""
    return f"CAST(printf('%.6e', {expr}) AS DOUBLE) AS {name}"


def not_nan(*cols: str) -> str:
    """Spark's ``na.drop`` removes NaN as well as null."""
    return " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in cols)


TICKER_FEATURES = f"""
WITH RECURSIVE {BARS_CTE},
g AS (
  SELECT symbol, trade_date, open_price, close_price, volume,
         row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS rn,
         count(*) OVER (PARTITION BY symbol) AS n
  FROM bars),
r AS (
  SELECT *,
    (close_price / lag(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) - 1) * 100
        AS returns_pct,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY trade_date
        ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS sma12,
    avg(close_price) OVER (PARTITION BY symbol ORDER BY trade_date
        ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) AS sma26
  FROM g WHERE n > 400),
f AS (
  SELECT *,
    lag(returns_pct, 1) OVER w AS lag_return1,
    lag(returns_pct, 5) OVER w AS lag_return5,
    lag(returns_pct, 10) OVER w AS lag_return10,
    {roll("avg", "close_price", 5)} AS stock_MA_5,
    {roll("avg", "close_price", 20)} AS stock_MA_20,
    {roll("avg", "close_price", 50)} AS stock_MA_50,
    {roll("stddev_samp", "returns_pct", 20)} AS returns_volatility_20,
    {roll("stddev_samp", "returns_pct", 50)} AS returns_volatility_50,
    {roll("avg", "volume", 20)} AS stock_volume_MA_20
  FROM r
  WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)),
{momentum_ctes("f", "symbol", "close_price", "t")}
SELECT f.symbol, f.trade_date, {_r("f.open_price", "open_price")}, {_r("f.close_price", "close_price")},
       {_r("f.volume", "volume")}, {_r("returns_pct", "returns_pct")},
       {_r("lag_return1", "lag_return1")}, {_r("lag_return5", "lag_return5")},
       {_r("lag_return10", "lag_return10")}, {_r("stock_MA_5", "stock_MA_5")},
       {_r("stock_MA_20", "stock_MA_20")}, {_r("stock_MA_50", "stock_MA_50")},
       {_r("returns_volatility_20", "returns_volatility_20")},
       {_r("returns_volatility_50", "returns_volatility_50")},
       {_r("m.rsi", "stock_RSI")}, {_r("m.macd", "MACD")},
       {_r("m.macd - m.macd_signal", "MACD_hist")}, {_r("m.macd_signal", "MACD_signal")},
       {_r("stock_volume_MA_20", "stock_volume_MA_20")}
FROM f JOIN t_mom m ON m.symbol = f.symbol AND m.rn = f.rn
WHERE returns_pct IS NOT NULL AND lag_return10 IS NOT NULL AND stock_MA_50 IS NOT NULL
  AND returns_volatility_50 IS NOT NULL AND m.rsi IS NOT NULL AND m.macd_signal IS NOT NULL
  AND stock_volume_MA_20 IS NOT NULL AND open_price IS NOT NULL
"""


MEMBERS_CTE = """
mem AS (
  SELECT lower(replace(r_name, ' ', '_')) AS sector,
         printf('T%05d', s_suppkey) AS symbol,
         abs(s_acctbal) + 1 AS shares
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""

RET_CTE = """
ret AS (
  SELECT symbol, trade_date, close_price, volume,
         (close_price / lag(close_price) OVER (PARTITION BY symbol ORDER BY trade_date) - 1) * 100
           AS returns_pct
  FROM bars)"""

SECTOR_AGG_CTE = """
sx AS (
  SELECT m.sector, r.trade_date, r.returns_pct, r.volume, r.close_price * m.shares AS cap
  FROM ret r JOIN mem m USING (symbol)),
sagg AS (
  SELECT sector, trade_date AS date,
         CASE WHEN coalesce(sum(cap), 0) = 0 THEN 0.0
              ELSE coalesce(sum(returns_pct * cap), 0) / sum(cap) END AS weighted_sector_returns,
         CAST(count(cap) AS DOUBLE) AS n_stocks_contributing,
         coalesce(sum(volume), 0) AS sector_volume
  FROM sx GROUP BY 1, 2),
sd AS (
  SELECT date, sector, weighted_sector_returns, n_stocks_contributing,
         100 * product(1 + weighted_sector_returns / 100) OVER (
           PARTITION BY sector ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS sector_index,
         sector_volume
  FROM sagg)"""

SECTOR_DAILY = f"""
WITH {BARS_CTE}, {RET_CTE}, {MEMBERS_CTE}, {SECTOR_AGG_CTE}
SELECT date, sector, {_r("weighted_sector_returns", "weighted_sector_returns")},
       {_r("n_stocks_contributing", "n_stocks_contributing")},
       {_s("sector_index", "sector_index")}, {_r("sector_volume", "sector_volume")}
FROM sd
"""

SECTOR_STATIC = f"""
WITH {BARS_CTE}, {RET_CTE}, {MEMBERS_CTE},
lastc AS (SELECT symbol, arg_max(close_price, trade_date) AS last_close FROM bars GROUP BY 1),
caps AS (SELECT m.sector, m.symbol, m.shares * l.last_close AS market_cap
         FROM mem m JOIN lastc l USING (symbol)),
wts AS (SELECT sector, symbol, market_cap / sum(market_cap) OVER (PARTITION BY sector)
               AS stock_weight FROM caps),
agg AS (
  SELECT w.sector, r.trade_date AS date,
         coalesce(sum(r.returns_pct * w.stock_weight), 0) AS weighted_sector_returns
  FROM ret r JOIN wts w USING (symbol) GROUP BY 1, 2)
SELECT date, sector, {_r("weighted_sector_returns", "weighted_sector_returns")},
       {_s('''100 * product(1 + weighted_sector_returns / 100) OVER (
             PARTITION BY sector ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)''',
           "sector_index")}
FROM agg
"""

SECTOR_FEATURES = f"""
WITH RECURSIVE {BARS_CTE}, {RET_CTE}, {MEMBERS_CTE}, {SECTOR_AGG_CTE},
sf AS (
  SELECT *,
    row_number() OVER w AS rn,
    avg(sector_index) OVER (w ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS sma12,
    avg(sector_index) OVER (w ROWS BETWEEN 25 PRECEDING AND CURRENT ROW) AS sma26,
    lag(weighted_sector_returns, 1) OVER w AS sector_lag_return1,
    {roll("avg", "sector_index", 5)} AS sector_index_MA_5,
    {roll("stddev_samp", "weighted_sector_returns", 20)} AS sector_returns_volatility_20,
    {roll("avg", "sector_volume", 20)} AS sector_stock_volume_MA_20
  FROM sd WINDOW w AS (PARTITION BY sector ORDER BY date)),
{momentum_ctes("sf", "sector", "sector_index", "s")}
SELECT date, f.sector, {_r("weighted_sector_returns", "weighted_sector_returns")},
       {_r("n_stocks_contributing", "n_stocks_contributing")},
       {_s("sector_index", "sector_index")}, {_r("sector_volume", "sector_volume")},
       {_r("sector_lag_return1", "sector_lag_return1")},
       {_s("sector_index_MA_5", "sector_index_MA_5")},
       {_r("sector_returns_volatility_20", "sector_returns_volatility_20")},
       {_r("m.rsi", "sector_index_RSI")}, {_s("m.macd", "sector_MACD")},
       {_s("m.macd - m.macd_signal", "sector_MACD_hist")},
       {_s("m.macd_signal", "sector_MACD_signal")},
       {_r("sector_stock_volume_MA_20", "sector_stock_volume_MA_20")}
FROM sf f JOIN s_mom m ON m.sector = f.sector AND m.rn = f.rn
WHERE {not_nan("weighted_sector_returns", "sector_index", "sector_lag_return1",
              "sector_index_MA_5", "sector_returns_volatility_20", "m.rsi", "m.macd",
              "m.macd_signal", "sector_stock_volume_MA_20")}
"""


MACRO_CTE = """
mo AS (
  SELECT date_trunc('month', CAST(o_orderdate AS DATE)) AS m,
         CAST(count(*) AS DOUBLE) AS order_count_monthly,
         avg(o_totalprice) AS avg_order_value_monthly,
         sum(o_totalprice) AS order_value_monthly
  FROM orders GROUP BY 1),
qo AS (
  SELECT CAST(date_trunc('quarter', CAST(o_orderdate AS DATE)) + INTERVAL 2 MONTH AS DATE) AS m,
         CAST(count(*) AS DOUBLE) AS order_count_quarterly,
         sum(o_totalprice) AS order_value_quarterly
  FROM orders GROUP BY 1),
macro AS (
  SELECT year(mo.m) AS yr, month(mo.m) AS month_idx,
         order_count_monthly, avg_order_value_monthly, order_value_monthly,
         order_count_quarterly, order_value_quarterly
  FROM mo LEFT JOIN qo ON CAST(mo.m AS DATE) = qo.m),
tgt AS (
  SELECT *, CASE WHEN month_idx = 12 THEN 1 ELSE month_idx + 1 END AS tm,
         yr + CASE WHEN month_idx = 12 THEN 1 ELSE 0 END AS ty,
         CASE month_idx WHEN 3 THEN 'Q2' WHEN 6 THEN 'Q3' WHEN 9 THEN 'Q4' WHEN 12 THEN 'Q1' END AS tq
  FROM macro),
cal AS (
  SELECT CAST(d AS DATE) AS "Date"
  FROM (SELECT unnest(generate_series(min(CAST(o_orderdate AS DATE)),
                                      max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d
        FROM orders)),
res AS (
  SELECT CAST(o_orderdate AS DATE) AS fr_date_daily,
         sum(o_totalprice) AS gross,
         sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS liquid
  FROM orders GROUP BY 1),
aligned AS (
  SELECT c."Date", 'Q' || CAST(quarter(c."Date") AS VARCHAR) AS "Quarter",
         year(c."Date") AS "Year", month(c."Date") AS "Month_idx",
         mm.order_count_monthly, mm.avg_order_value_monthly, mm.order_value_monthly,
         qq.order_count_quarterly, qq.order_value_quarterly,
         r.gross AS "foreign_reserve_gross(USD)_daily",
         r.liquid AS "foreign_reserve_liquid(USD)_daily"
  FROM cal c
  LEFT JOIN tgt mm ON year(c."Date") = mm.ty AND month(c."Date") = mm.tm
  LEFT JOIN (SELECT * FROM tgt WHERE tq IS NOT NULL AND NOT (order_count_quarterly IS NULL
                                                          AND order_value_quarterly IS NULL)) qq
         ON 'Q' || CAST(quarter(c."Date") AS VARCHAR) = qq.tq AND year(c."Date") = qq.ty
  LEFT JOIN res r ON c."Date" = r.fr_date_daily),
aligned_clean AS (
  SELECT * FROM aligned
  WHERE order_count_monthly IS NOT NULL AND avg_order_value_monthly IS NOT NULL
    AND order_value_monthly IS NOT NULL AND order_count_quarterly IS NOT NULL
    AND order_value_quarterly IS NOT NULL AND "foreign_reserve_gross(USD)_daily" IS NOT NULL
    AND "foreign_reserve_liquid(USD)_daily" IS NOT NULL)"""

_ALIGNED_COLS = ('"Date", "Quarter", CAST("Year" AS INTEGER) AS "Year", '
                 'CAST("Month_idx" AS INTEGER) AS "Month_idx", '
                 + ", ".join(_r(c, c) for c in ["order_count_monthly", "avg_order_value_monthly",
                                                 "order_value_monthly", "order_count_quarterly",
                                                 "order_value_quarterly"])
                 + ", " + _r('"foreign_reserve_gross(USD)_daily"', '"foreign_reserve_gross(USD)_daily"')
                 + ", " + _r('"foreign_reserve_liquid(USD)_daily"',
                             '"foreign_reserve_liquid(USD)_daily"'))

MACRO_ALIGNED = f"""
WITH {MACRO_CTE}
SELECT {_ALIGNED_COLS} FROM aligned_clean
"""

MACRO_LAGS = f"""
WITH {MACRO_CTE},
mfirst AS (
  SELECT "Year", "Month_idx", arg_min(order_value_monthly, "Date") AS f
  FROM aligned_clean WHERE order_value_monthly IS NOT NULL GROUP BY 1, 2),
mlag AS (
  SELECT "Year", "Month_idx",
         lag(f, 1) OVER (ORDER BY "Year", "Month_idx") AS order_value_monthly_lag1,
         lag(f, 2) OVER (ORDER BY "Year", "Month_idx") AS order_value_monthly_lag2
  FROM mfirst),
qfirst AS (
  SELECT "Year", "Quarter", arg_min(order_value_quarterly, "Date") AS f
  FROM aligned_clean WHERE order_value_quarterly IS NOT NULL GROUP BY 1, 2),
qlag AS (
  SELECT "Year", "Quarter", lag(f, 1) OVER (ORDER BY "Year", "Quarter") AS order_value_quarterly_lag1
  FROM qfirst),
lagged AS (
  SELECT a.*,
    lag("foreign_reserve_liquid(USD)_daily", 1) OVER (ORDER BY "Date") AS "foreign_reserve_liquid(USD)_daily_lag1",
    lag("foreign_reserve_liquid(USD)_daily", 5) OVER (ORDER BY "Date") AS "foreign_reserve_liquid(USD)_daily_lag5",
    lag("foreign_reserve_liquid(USD)_daily", 10) OVER (ORDER BY "Date") AS "foreign_reserve_liquid(USD)_daily_lag10"
  FROM aligned_clean a)
SELECT {_ALIGNED_COLS},
       {_r('"foreign_reserve_liquid(USD)_daily_lag1"', '"foreign_reserve_liquid(USD)_daily_lag1"')},
       {_r('"foreign_reserve_liquid(USD)_daily_lag5"', '"foreign_reserve_liquid(USD)_daily_lag5"')},
       {_r('"foreign_reserve_liquid(USD)_daily_lag10"', '"foreign_reserve_liquid(USD)_daily_lag10"')},
       {_r("order_value_monthly_lag1", "order_value_monthly_lag1")},
       {_r("order_value_monthly_lag2", "order_value_monthly_lag2")},
       {_r("order_value_quarterly_lag1", "order_value_quarterly_lag1")}
FROM lagged l
LEFT JOIN mlag USING ("Year", "Month_idx")
LEFT JOIN qlag USING ("Year", "Quarter")
"""


TRAIN_FEATURES = ["weighted_sector_returns", "n_stocks_contributing", "sector_volume",
                  "order_count_monthly", "avg_order_value_monthly", "order_value_monthly",
                  "order_count_quarterly", "order_value_quarterly",
                  "foreign_reserve_gross(USD)_daily", "foreign_reserve_liquid(USD)_daily"]
COLLINEAR = ["order_count_monthly", "order_value_monthly", "order_count_quarterly",
             "order_value_quarterly", "foreign_reserve_gross(USD)_daily",
             "foreign_reserve_liquid(USD)_daily"]


def _q(c: str) -> str:
    return '"' + c + '"'


TRAIN_CTE = f"""
sdl AS (
  SELECT date, sector, weighted_sector_returns, n_stocks_contributing, sector_index,
         lag(sector_volume) OVER (PARTITION BY sector ORDER BY date) AS sector_volume
  FROM sd),
ml AS (
  SELECT "Date" AS date, order_count_monthly, avg_order_value_monthly, order_value_monthly,
         order_count_quarterly, order_value_quarterly,
         lag("foreign_reserve_gross(USD)_daily") OVER (ORDER BY "Date")
           AS "foreign_reserve_gross(USD)_daily",
         lag("foreign_reserve_liquid(USD)_daily") OVER (ORDER BY "Date")
           AS "foreign_reserve_liquid(USD)_daily"
  FROM aligned_clean),
tf AS (
  SELECT sdl.date, sdl.sector, weighted_sector_returns, n_stocks_contributing, sector_index,
         sector_volume, order_count_monthly, avg_order_value_monthly, order_value_monthly,
         order_count_quarterly, order_value_quarterly, "foreign_reserve_gross(USD)_daily",
         "foreign_reserve_liquid(USD)_daily"
  FROM sdl JOIN ml ON sdl.date = ml.date
  WHERE {not_nan("sector_volume", "sector_index", "weighted_sector_returns",
                 '"foreign_reserve_gross(USD)_daily"', '"foreign_reserve_liquid(USD)_daily"')})"""

TRAIN_WITH = f"WITH {BARS_CTE}, {RET_CTE}, {MEMBERS_CTE}, {SECTOR_AGG_CTE}, {MACRO_CTE}, {TRAIN_CTE}"

TRAINING_FRAME = f"""
{TRAIN_WITH}
SELECT date, sector, {_s("sector_index", "sector_index")},
       {", ".join(_r(_q(c), _q(c)) for c in TRAIN_FEATURES)}
FROM tf
"""


def _corr_matrix_sql(frame: str, cols: list[str], extra_ctes: str = "") -> str:
    aggs = ", ".join(f"corr({_q(cols[i])}, {_q(cols[j])}) AS c_{i}_{j}"
                     for i in range(len(cols)) for j in range(i + 1, len(cols)))
    aggs += ", " + ", ".join(f"var_pop({_q(c)}) AS v_{i}" for i, c in enumerate(cols))
    parts = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            v = (f"CASE WHEN v_{i} > 0 THEN 1.0 ELSE 'NaN'::DOUBLE END" if i == j
                 else f"c_{min(i, j)}_{max(i, j)}")
            parts.append(f"SELECT sector, {i} AS i, '{cols[i]}' AS col_i, {j} AS j, "
                         f"'{cols[j]}' AS col_j, {r4(v)} AS corr FROM agg")
    return (f"{TRAIN_WITH}{extra_ctes},\nagg AS (SELECT sector, {aggs} FROM {frame} "
            f"GROUP BY sector)\n" + "\nUNION ALL\n".join(parts))


CORR_MATRIX = _corr_matrix_sql("tf", TRAIN_FEATURES)

CORR_SCREEN = f"""
SELECT * FROM ({CORR_MATRIX}) m WHERE j < i AND NOT isnan(corr) AND abs(corr) > 0.85
"""

CORR_TARGET = f"""
{TRAIN_WITH}
""" + "\nUNION ALL\n".join(
    f"SELECT sector, '{c}' AS feature, "
    + (r4("1.0") if c == "weighted_sector_returns" else r4(f"corr({_q(c)}, weighted_sector_returns)"))
    + " AS corr FROM tf GROUP BY sector" for c in TRAIN_FEATURES)

def stationary_cte(changed: list[str]) -> str:
    """Relative changes of ``changed`` per sector, rows with a missing change dropped."""
    pct = ",\n".join(f"{_q(c)} / lag({_q(c)}) OVER (PARTITION BY sector ORDER BY date) - 1 AS {_q(c)}"
                     for c in changed)
    return f""",
st0 AS (
  SELECT date, sector, {", ".join(_q(c) for c in TRAIN_FEATURES if c not in changed)},
         {pct}
  FROM tf),
st AS (SELECT * FROM st0 WHERE {not_nan(*[_q(c) for c in changed])}
       AND {" AND ".join(f"isfinite({_q(c)})" for c in changed)})"""


STATIONARY_CTE = stationary_cte(COLLINEAR)

CORR_FLAGGED = f"SELECT DISTINCT sector, col_i FROM ({CORR_SCREEN}) s"

STATIONARY_SCREEN = f"""
SELECT * FROM ({_corr_matrix_sql("st", TRAIN_FEATURES, STATIONARY_CTE)}) m
WHERE j < i AND NOT isnan(corr) AND abs(corr) > 0.85
"""

_EVERY = [c for c in TRAIN_FEATURES if c != "weighted_sector_returns"]
STATIONARY_ALL = f"""
SELECT * FROM ({_corr_matrix_sql("st", TRAIN_FEATURES, stationary_cte(_EVERY))}) m
WHERE j < i AND NOT isnan(corr) AND abs(corr) > 0.85
"""

DESCRIBE = f"""
{TRAIN_WITH}
""" + "\nUNION ALL\n".join(
    f"SELECT sector, '{c}' AS \"column\", count({_q(c)}) AS \"count\", "
    f"{r4(f'avg({_q(c)})')} AS mean, {r4(f'stddev_samp({_q(c)})')} AS std, "
    f"{r4(f'min({_q(c)})')} AS min, {r4(f'quantile_cont({_q(c)}, 0.25)')} AS p25, "
    f"{r4(f'quantile_cont({_q(c)}, 0.5)')} AS p50, {r4(f'quantile_cont({_q(c)}, 0.75)')} AS p75, "
    f"{r4(f'max({_q(c)})')} AS max FROM tf GROUP BY sector" for c in TRAIN_FEATURES)

DESCRIBE_FACTS = "\nUNION ALL\n".join(
    f"SELECT l_returnflag, '{c}' AS \"column\", count({c}) AS \"count\", "
    f"{r4(f'avg({c})')} AS mean, {r4(f'stddev_samp({c})')} AS std, {r4(f'CAST(min({c}) AS DOUBLE)')} AS min, "
    f"{r4(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS p25, {r4(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS p50, "
    f"{r4(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS p75, {r4(f'CAST(max({c}) AS DOUBLE)')} AS max "
    f"FROM lineitem GROUP BY l_returnflag" for c in ("l_quantity", "l_extendedprice", "l_discount"))

LABEL_COUNTS = f"""
{TRAIN_WITH}
SELECT sector, CASE WHEN weighted_sector_returns > 0 THEN 1 ELSE 0 END AS value,
       count(*) AS "count"
FROM tf GROUP BY 1, 2
"""


MODEL_FEATURES = [c for c in TRAIN_FEATURES if c != "weighted_sector_returns"]

FOLDS_CTE = f"""
pos AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY sector ORDER BY date) - 1 AS BIGINT) AS row_idx,
         count(*) OVER (PARTITION BY sector) AS n_rows,
         CASE WHEN weighted_sector_returns > 0 THEN 1 ELSE 0 END AS label
  FROM st),
pos2 AS (
  SELECT *, n_rows // 6 AS ts, n_rows - 5 * (n_rows // 6) AS first_test FROM pos),
pos3 AS (
  SELECT *, CASE WHEN row_idx >= first_test THEN (row_idx - first_test) // ts ELSE -1 END AS tf
  FROM pos2 WHERE ts > 0),
folds AS (
  SELECT *, CAST(tf AS INTEGER) AS fold, 'test' AS role FROM pos3 WHERE tf >= 0
  UNION ALL
  SELECT p.*, CAST(f.fold AS INTEGER) AS fold, 'train' AS role
  FROM pos3 p JOIN (SELECT unnest(range(5)) AS fold) f ON f.fold > p.tf)"""

FOLD_WITH = f"{TRAIN_WITH}{STATIONARY_CTE},{FOLDS_CTE}"

FOLD_REPORT = f"""
{FOLD_WITH}
SELECT sector, fold, role, count(*) AS rows, min(row_idx) AS first_row, max(row_idx) AS last_row,
       min(date) AS first_date, max(date) AS last_date
FROM folds GROUP BY sector, fold, role
"""

HOLDOUT = f"""
{TRAIN_WITH}{STATIONARY_CTE},
p AS (SELECT *, row_number() OVER (PARTITION BY sector ORDER BY date) - 1 AS row_idx,
             count(*) OVER (PARTITION BY sector) AS n_rows FROM st),
r AS (SELECT *, CASE WHEN row_idx >= n_rows - ceil(n_rows * 0.2) THEN 'test' ELSE 'train' END
             AS role FROM p)
SELECT sector, role, count(*) AS rows, min(row_idx) AS first_row, max(row_idx) AS last_row
FROM r GROUP BY sector, role
"""

BASELINE_RMSE = f"""
{FOLD_WITH},
mu AS (SELECT sector, fold, avg(weighted_sector_returns) AS m FROM folds WHERE role = 'train'
       GROUP BY 1, 2)
SELECT f.sector, f.fold, {r4("sqrt(avg(power(weighted_sector_returns - mu.m, 2)))")} AS baseline_rmse
FROM folds f JOIN mu USING (sector, fold) WHERE role = 'test' GROUP BY 1, 2
"""

_MAJ = """
vc AS (SELECT sector, fold, label, count(*) AS n FROM folds WHERE role = 'train' GROUP BY 1, 2, 3),
maj AS (SELECT sector, fold, label AS majority_class FROM (
          SELECT *, row_number() OVER (PARTITION BY sector, fold ORDER BY n DESC, label) AS r
          FROM vc) WHERE r = 1),
base AS (SELECT f.sector, f.fold, majority_class,
                avg(CASE WHEN label = majority_class THEN 1.0 ELSE 0.0 END) AS baseline_accuracy
         FROM folds f JOIN maj USING (sector, fold) WHERE role = 'test' GROUP BY 1, 2, 3)"""

BASELINE_ACCURACY = f"""
{FOLD_WITH},{_MAJ}
SELECT sector, fold, majority_class, {r4("baseline_accuracy")} AS baseline_accuracy FROM base
"""

_K = len(MODEL_FEATURES)
_SCALER = ",\n".join(
    [f"avg({_q(c)}) AS mu{i}, CASE WHEN stddev_pop({_q(c)}) = 0 THEN 1.0 "
     f"ELSE stddev_pop({_q(c)}) END AS sd{i}" for i, c in enumerate(MODEL_FEATURES)])
_SCALED = ",\n".join(f"({_q(c)} - mu{i}) / sd{i} AS x{i}" for i, c in enumerate(MODEL_FEATURES))
_CLS = ",\n".join([f"avg(x{i}) AS m{i}, var_pop(x{i}) AS v{i}" for i in range(_K)])
_LL = " ".join(f"- 0.5 * (ln(2 * pi() * (c.v{i} + c.eps)) + power(t.x{i} - c.m{i}, 2) / (c.v{i} + c.eps))"
               for i in range(_K))
NB_CTE = f"""
sc AS (SELECT sector, fold, {_SCALER} FROM folds WHERE role = 'train' GROUP BY 1, 2),
xs AS (SELECT f.sector, f.fold, f.role, f.row_idx, f.label, {_SCALED}
       FROM folds f JOIN sc USING (sector, fold)),
ev AS (SELECT sector, fold, greatest({", ".join(f"var_pop(x{i})" for i in range(_K))}) AS maxvar,
              count(*) AS n FROM xs WHERE role = 'train' GROUP BY 1, 2),
cls AS (SELECT xs.sector, xs.fold, label AS cls, count(*) AS nc, {_CLS}
        FROM xs WHERE role = 'train' GROUP BY 1, 2, 3),
cl AS (SELECT cls.*, 1e-9 * ev.maxvar AS eps, ev.n FROM cls JOIN ev USING (sector, fold)),
sco AS (SELECT t.sector, t.fold, t.row_idx, t.label, c.cls,
               ln(c.nc / c.n) {_LL} AS ll
        FROM xs t JOIN cl c ON t.sector = c.sector AND t.fold = c.fold WHERE t.role = 'test'),
nbp AS (SELECT sector, fold, row_idx, label, cls AS prediction FROM (
          SELECT *, row_number() OVER (PARTITION BY sector, fold, row_idx ORDER BY ll DESC, cls) AS r
          FROM sco) WHERE r = 1)"""

NB_SCORES = f"""
{FOLD_WITH},{_MAJ},{NB_CTE},
acc AS (SELECT sector, fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy
        FROM nbp GROUP BY 1, 2)
SELECT sector, fold, {r4("accuracy")} AS accuracy, {r4("baseline_accuracy")} AS baseline_accuracy,
       accuracy > baseline_accuracy AS beats_baseline
FROM acc JOIN base USING (sector, fold)
"""

NB_SUMMARY = f"""
{FOLD_WITH},{_MAJ},{NB_CTE},
acc AS (SELECT sector, fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy
        FROM nbp GROUP BY 1, 2)
SELECT sector, {r4("avg(accuracy)")} AS mean_accuracy,
       {r4("avg(baseline_accuracy)")} AS mean_baseline_accuracy,
       {r4("avg(accuracy) - avg(baseline_accuracy)")} AS mean_edge,
       CAST(count_if(accuracy > baseline_accuracy) AS BIGINT) AS folds_beating_baseline,
       count(*) AS folds
FROM acc JOIN base USING (sector, fold) GROUP BY sector
"""

NB_REPORT = f"""
{FOLD_WITH},{NB_CTE},
pc AS (SELECT sector, fold, c AS cls,
              count_if(label = c AND prediction = c) AS tp, count_if(prediction = c) AS pp,
              count_if(label = c) AS support
       FROM nbp, (SELECT unnest([0, 1]) AS c) GROUP BY 1, 2, 3),
pr AS (SELECT sector, fold, CAST(cls AS VARCHAR) AS class,
              CASE WHEN pp = 0 THEN 0.0 ELSE tp / pp END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, support FROM pc),
pf AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
                      ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM pr),
allr AS (
  SELECT sector, fold, class, precision, recall, f1, support FROM pf
  UNION ALL
  SELECT sector, fold, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)
  FROM pf GROUP BY 1, 2
  UNION ALL
  SELECT sector, fold, 'weighted avg', sum(precision * support) / sum(support),
         sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
  FROM pf GROUP BY 1, 2)
SELECT sector, fold, class, {r4("precision")} AS precision, {r4("recall")} AS recall,
       {r4("f1")} AS f1, CAST(support AS BIGINT) AS support FROM allr
"""

NB_CONFUSION = f"""
{FOLD_WITH},{NB_CTE}
SELECT sector, fold, c AS true_class, CAST(count_if(label = c AND prediction = 0) AS BIGINT) AS pred_0,
       CAST(count_if(label = c AND prediction = 1) AS BIGINT) AS pred_1
FROM nbp, (SELECT unnest([0, 1]) AS c) GROUP BY 1, 2, 3
"""


# Ridge: Gauss-Jordan elimination of the centred normal equations, one pivot a recursion step
# (the matrix is positive definite, so no pivot search is needed).
_NORMAL = ", ".join(
    "[" + ", ".join([f"count(*) * covar_pop(x{i}, x{j}) + {float(i == j)}" for j in range(_K)]
                    + [f"count(*) * covar_pop(x{i}, y)"]) + "]" for i in range(_K))
_MEANS = ", ".join(f"avg(x{i})" for i in range(_K))
RIDGE_SCORES = f"""
{FOLD_WITH.replace("WITH", "WITH RECURSIVE", 1)},
sc AS (SELECT sector, fold, {_SCALER} FROM folds WHERE role = 'train' GROUP BY 1, 2),
xs AS (SELECT f.sector, f.fold, f.role, f.weighted_sector_returns AS y, {_SCALED}
       FROM folds f JOIN sc USING (sector, fold)),
mat AS (SELECT sector, fold, avg(y) AS my, [{_MEANS}] AS mx, [{_NORMAL}] AS m
        FROM xs WHERE role = 'train' GROUP BY 1, 2),
gj AS (
  SELECT sector, fold, my, mx, CAST(1 AS BIGINT) AS p, m FROM mat
  UNION ALL
  SELECT sector, fold, my, mx, p + 1,
         list_transform(range(1, {_K + 1}), lambda i: list_transform(range(1, {_K + 2}), lambda j:
           CASE WHEN i = p THEN m[p][j] / m[p][p] ELSE m[i][j] - m[i][p] / m[p][p] * m[p][j] END))
  FROM gj WHERE p <= {_K}),
w AS (SELECT sector, fold, my, mx, list_transform(m, lambda r: r[{_K + 1}]) AS w FROM gj WHERE p = {_K + 1}),
pr AS (SELECT t.sector, t.fold, y,
              my + {" + ".join(f"w[{i + 1}] * (x{i} - mx[{i + 1}])" for i in range(_K))} AS p,
              avg(y) OVER (PARTITION BY t.sector, t.fold) AS ym
       FROM xs t JOIN w ON t.sector = w.sector AND t.fold = w.fold WHERE t.role = 'test'),
s AS (SELECT sector, fold, sqrt(avg(power(y - p, 2))) AS rmse, sum(power(y - p, 2)) AS res,
             sum(power(y - ym, 2)) AS tot FROM pr GROUP BY 1, 2),
mu AS (SELECT sector, fold, avg(weighted_sector_returns) AS m FROM folds WHERE role = 'train' GROUP BY 1, 2),
b AS (SELECT f.sector, f.fold, sqrt(avg(power(weighted_sector_returns - mu.m, 2))) AS baseline_rmse
      FROM folds f JOIN mu USING (sector, fold) WHERE role = 'test' GROUP BY 1, 2)
SELECT sector, fold, {r4("rmse")} AS rmse,
       {r4("CASE WHEN tot = 0 THEN CASE WHEN res = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - res / tot END")} AS r2,
       {r4("baseline_rmse")} AS baseline_rmse
FROM s JOIN b USING (sector, fold)
"""



_GRAM = ", ".join("[" + ", ".join(f"covar_pop(x{i}, x{j})" for j in range(_K)) + "]" for i in range(_K))


def elastic_net_sql(l1: float, l2: float, sweeps: int = 120) -> str:
    """Coordinate descent on the Gram matrix, one coordinate a recursion step."""
    return f"""
{FOLD_WITH.replace("WITH", "WITH RECURSIVE", 1)},
sc AS (SELECT sector, fold, {_SCALER} FROM folds WHERE role = 'train' GROUP BY 1, 2),
xs AS (SELECT f.sector, f.fold, f.role, f.weighted_sector_returns AS y, {_SCALED}
       FROM folds f JOIN sc USING (sector, fold)),
mat AS (SELECT sector, fold, avg(y) AS my, [{_MEANS}] AS mx, [{_GRAM}] AS g,
               [{", ".join(f"covar_pop(x{i}, y)" for i in range(_K))}] AS c
        FROM xs WHERE role = 'train' GROUP BY 1, 2),
cd AS (
  SELECT sector, fold, my, mx, g, c, 0 AS s, list_transform(range({_K}), lambda i: 0.0::DOUBLE) AS w FROM mat
  UNION ALL
  SELECT sector, fold, my, mx, g, c, s + 1, list_transform(range(1, {_K} + 1), lambda i:
           CASE WHEN i <> s % {_K} + 1 THEN w[i] WHEN g[i][i] + {l2} <= 0 THEN 0.0
                ELSE sign(rho) * greatest(abs(rho) - {l1}, 0.0) / (g[i][i] + {l2}) END)
  FROM (SELECT *, c[s % {_K} + 1] - list_inner_product(g[s % {_K} + 1], w)
                  + g[s % {_K} + 1][s % {_K} + 1] * w[s % {_K} + 1] AS rho FROM cd)
  WHERE s < {_K * sweeps}),
w AS (SELECT sector, fold, my, mx, w FROM cd WHERE s = {_K * sweeps}),
pr AS (SELECT t.sector, t.fold, t.role, y, list_sum(list_transform(w, lambda v: abs(v))) AS size,
              my + {" + ".join(f"w[{i + 1}] * (x{i} - mx[{i + 1}])" for i in range(_K))} AS p,
              avg(y) OVER (PARTITION BY t.sector, t.fold, t.role) AS ym
       FROM xs t JOIN w ON t.sector = w.sector AND t.fold = w.fold)
SELECT sector, fold, role, count(*) AS n, {r4("any_value(size)")} AS coef_l1, {r4("sqrt(avg(power(y - p, 2)))")} AS rmse,
       {r4("CASE WHEN sum(power(y - ym, 2)) = 0 THEN CASE WHEN sum(power(y - p, 2)) = 0 THEN 1.0 ELSE 0.0 END "
           "ELSE 1 - sum(power(y - p, 2)) / sum(power(y - ym, 2)) END")} AS r2
FROM pr GROUP BY 1, 2, 3
"""


LASSO_SCORES = elastic_net_sql(1.0, 0.0)
ELASTICNET_SCORES = elastic_net_sql(0.5, 0.5)

# Logistic regression: steps of a fixed matrix that bounds every Hessian, X'X / 4 + I without the
# intercept's part; its inverse comes from Gauss-Jordan elimination, one pivot a recursion step.
_ONE = ["1.0", *(f"x{i}" for i in range(_K))]
_BOUND = ", ".join(
    "[" + ", ".join([f"sum({a} * {b}) / 4" + (" + 1.0" if i == j and i else "") for j, b in enumerate(_ONE)]
                    + [f"{float(i == j)}" for j in range(_K + 1)]) + "]" for i, a in enumerate(_ONE))
_Z = " + ".join(f"it.w[{i + 1}] * {a}" for i, a in enumerate(_ONE))


def logistic_ctes(steps: int = 150) -> str:
    return f"""
sc AS (SELECT sector, fold, {_SCALER} FROM folds WHERE role = 'train' GROUP BY 1, 2),
xs AS (SELECT f.sector, f.fold, f.role, f.row_idx, f.label, {_SCALED}
       FROM folds f JOIN sc USING (sector, fold)),
mat AS (SELECT sector, fold, [{_BOUND}] AS m FROM xs WHERE role = 'train' GROUP BY 1, 2),
gj AS (
  SELECT sector, fold, CAST(1 AS BIGINT) AS p, m FROM mat
  UNION ALL
  SELECT sector, fold, p + 1,
         list_transform(range(1, {_K + 2}), lambda i: list_transform(range(1, {2 * _K + 3}), lambda j:
           CASE WHEN i = p THEN m[p][j] / m[p][p] ELSE m[i][j] - m[i][p] / m[p][p] * m[p][j] END))
  FROM gj WHERE p <= {_K + 1}),
inv AS (SELECT sector, fold, list_transform(m, lambda r: r[{_K + 2}:]) AS b FROM gj WHERE p = {_K + 2}),
it AS (
  SELECT sector, fold, b, 0 AS s, list_transform(range({_K + 1}), lambda i: 0.0::DOUBLE) AS w FROM inv
  UNION ALL
  SELECT sector, fold, b, s + 1, list_transform(range(1, {_K + 2}), lambda i: w[i] - list_inner_product(b[i], g))
  FROM (SELECT it.sector, it.fold, any_value(it.b) AS b, any_value(it.s) AS s, any_value(it.w) AS w,
               [{", ".join(f"sum((1 / (1 + exp(-({_Z}))) - label) * {a})" + (f" + any_value(it.w[{i + 1}])" if i else "")
                           for i, a in enumerate(_ONE))}] AS g
        FROM it JOIN xs ON xs.sector = it.sector AND xs.fold = it.fold
        WHERE xs.role = 'train' AND it.s < {steps} GROUP BY 1, 2)),
lgp AS (SELECT xs.sector, xs.fold, role, row_idx, label, CASE WHEN {_Z} > 0 THEN 1 ELSE 0 END AS prediction
        FROM xs JOIN it ON xs.sector = it.sector AND xs.fold = it.fold AND it.s = {steps})"""


LOGISTIC_SCORES = f"""
{FOLD_WITH.replace("WITH", "WITH RECURSIVE", 1)},{_MAJ},{logistic_ctes()},
acc AS (SELECT sector, fold, avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FILTER (role = 'train') AS train_accuracy,
               avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FILTER (role = 'test') AS test_accuracy
        FROM lgp GROUP BY 1, 2)
SELECT sector, fold, {r4("train_accuracy")} AS train_accuracy, {r4("test_accuracy")} AS test_accuracy,
       {r4("baseline_accuracy")} AS baseline_accuracy, test_accuracy > baseline_accuracy AS beats_baseline
FROM acc JOIN base USING (sector, fold)
"""

LOGISTIC_REPORT = NB_REPORT.replace(FOLD_WITH, FOLD_WITH.replace("WITH", "WITH RECURSIVE", 1), 1).replace(
    NB_CTE, logistic_ctes()).replace("FROM nbp", "FROM (SELECT * FROM lgp WHERE role = 'test')")
LOGISTIC_CONFUSION = NB_CONFUSION.replace(FOLD_WITH, FOLD_WITH.replace("WITH", "WITH RECURSIVE", 1), 1).replace(
    NB_CTE, logistic_ctes()).replace("FROM nbp", "FROM (SELECT * FROM lgp WHERE role = 'test')")

MONTHLY_ROLLUP = f"""
WITH {BARS_CTE}, {RET_CTE}, {MEMBERS_CTE}, {SECTOR_AGG_CTE}, {MACRO_CTE},
mmac AS (
  SELECT CAST(mo.m AS DATE) AS month,
         lag(order_count_monthly) OVER (ORDER BY mo.m) AS order_count_monthly,
         lag(avg_order_value_monthly) OVER (ORDER BY mo.m) AS avg_order_value_monthly,
         lag(order_value_monthly) OVER (ORDER BY mo.m) AS order_value_monthly,
         order_count_quarterly, order_value_quarterly
  FROM mo LEFT JOIN qo ON CAST(mo.m AS DATE) = qo.m),
sl AS (
  SELECT date, sector, weighted_sector_returns, n_stocks_contributing, sector_index,
         lag(sector_volume) OVER (PARTITION BY sector ORDER BY date) AS sector_volume
  FROM sd),
slm AS (
  SELECT sector, CAST(date_trunc('month', date) AS DATE) AS month,
         arg_max(weighted_sector_returns, date) AS weighted_sector_returns,
         arg_max(n_stocks_contributing, date) AS n_stocks_contributing,
         arg_max(sector_index, date) AS sector_index,
         arg_max(sector_volume, date) AS sector_volume
  FROM sl WHERE {not_nan("sector_volume", "sector_index", "weighted_sector_returns")}
  GROUP BY 1, 2),
j AS (
  SELECT s.*, m.order_count_monthly, m.avg_order_value_monthly, m.order_value_monthly,
         m.order_count_quarterly, m.order_value_quarterly
  FROM slm s JOIN mmac m USING (month)
  WHERE {not_nan("order_count_monthly", "avg_order_value_monthly", "order_value_monthly",
                 "order_count_quarterly", "order_value_quarterly")})
SELECT sector, month, {_r("weighted_sector_returns", "weighted_sector_returns")},
       {_r("n_stocks_contributing", "n_stocks_contributing")},
       {_s("sector_index", "sector_index")}, {_r("sector_volume", "sector_volume")},
       {_r("order_count_monthly", "order_count_monthly")},
       {_r("avg_order_value_monthly", "avg_order_value_monthly")},
       {_r("order_value_monthly", "order_value_monthly")},
       {_r("order_count_quarterly", "order_count_quarterly")},
       {_r("order_value_quarterly", "order_value_quarterly")},
       {_s("(sector_index / lag(sector_index) OVER (PARTITION BY sector ORDER BY month) - 1) * 100",
           "new_monthly_returns")}
FROM j
"""


EVENT_PROPS = """
WITH p AS (
  SELECT event_type, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT event_type, count(*) AS events, count(k) AS parsed, count(*) - count(k) AS rejected,
       CAST(sum(k) AS BIGINT) AS k_sum
FROM p GROUP BY event_type
"""

EVENT_GATE = """
WITH s AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS trade_date
  FROM events GROUP BY 1, 2)
SELECT symbol, count(*) AS n_bars, count(*) > 400 AS passes_gate FROM s GROUP BY symbol
"""

BAR_QUALITY = f"""
WITH {BARS_CTE}
SELECT c AS "column", non_null, missing, infinite FROM (
  SELECT 'open_price' AS c, count(open_price) AS non_null,
         CAST(count(*) - count(open_price) + count_if(isnan(open_price)) AS BIGINT) AS missing,
         CAST(count_if(isinf(open_price)) AS BIGINT) AS infinite FROM bars
  UNION ALL
  SELECT 'close_price', count(close_price),
         CAST(count(*) - count(close_price) + count_if(isnan(close_price)) AS BIGINT),
         CAST(count_if(isinf(close_price)) AS BIGINT) FROM bars
  UNION ALL
  SELECT 'volume', count(volume),
         CAST(count(*) - count(volume) + count_if(isnan(volume)) AS BIGINT),
         CAST(count_if(isinf(volume)) AS BIGINT) FROM bars)
"""

MONTH_SPINE = """
WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi
           FROM orders),
sp AS (SELECT CAST(last_day(CAST(m AS DATE)) AS DATE) AS date
       FROM b, (SELECT unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS m
                FROM b) g),
spine AS (SELECT date FROM sp, b WHERE date >= lo AND date <= hi),
mo AS (SELECT CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS date, count(*) AS orders
       FROM orders GROUP BY 1)
SELECT spine.date, strftime(spine.date, '%Y-%m-%d') AS date_text, coalesce(mo.orders, 0) AS orders
FROM spine LEFT JOIN mo USING (date)
"""

SYMBOL_BATCHES = f"""
WITH {BARS_CTE},
s AS (SELECT DISTINCT symbol FROM bars),
b AS (SELECT symbol, CAST((row_number() OVER (ORDER BY symbol) - 1) // 10 AS INTEGER) AS batch FROM s)
SELECT batch, count(*) AS symbols, min(symbol) AS first_symbol, max(symbol) AS last_symbol
FROM b GROUP BY batch
"""

SERIES_ENDS = f"""
WITH {BARS_CTE},
n AS (SELECT symbol, trade_date, close_price,
             row_number() OVER (PARTITION BY symbol ORDER BY trade_date) AS head_no,
             row_number() OVER (PARTITION BY symbol ORDER BY trade_date DESC) AS tail_no FROM bars)
SELECT symbol, trade_date, {r4("close_price")} AS close_price, head_no <= 3 AS in_head, tail_no <= 3 AS in_tail
FROM n WHERE head_no <= 3 OR tail_no <= 3
"""

SECTOR_LOOKUP = f"""
WITH {BARS_CTE}, {MEMBERS_CTE},
f AS (SELECT symbol, arg_min(close_price, trade_date) AS first_close FROM bars GROUP BY 1)
SELECT sector, count(*) AS members, CAST(count_if(f.symbol IS NULL) AS BIGINT) AS missing_bars,
       {r4("sum(first_close)")} AS first_close_sum,
       {r4("sum(CASE WHEN mem.symbol IN ('T00001', 'T00002', 'T00003', 'T00005', 'T00008') THEN shares END)")}
         AS listed_shares
FROM mem LEFT JOIN f ON f.symbol = mem.symbol GROUP BY sector
"""

PAYLOAD_PRICES = f"""
WITH {BARS_CTE}
SELECT symbol, symbol LIKE '%7' AS rejected,
       CAST(CASE WHEN symbol LIKE '%7' THEN 0 ELSE count(*) END AS BIGINT) AS n_rows,
       {r4("CASE WHEN symbol LIKE '%7' THEN 0.0 ELSE sum(volume) END")} AS volume
FROM bars GROUP BY symbol
"""

_ODD = "CASE symbol WHEN 'T00001' THEN 'INFINITY' WHEN 'T00002' THEN '007' ELSE symbol END AS symbol"
_BAR = ", ".join(_r(c, c) for c in ("open_price", "high_price", "low_price", "close_price", "volume"))
PARTITIONED_BARS = f"""
WITH {BARS_CTE}
SELECT {_ODD}, trade_date, {_BAR} FROM bars
WHERE symbol IN ('T00001', 'T00002', 'T00003', 'T00005', 'T00008')
"""

CSV_BARS = f"""
WITH {BARS_CTE},
b AS (SELECT {_ODD}, trade_date, close_price, CASE WHEN day(trade_date) <> 13 THEN volume END AS volume FROM bars)
SELECT symbol, count(*) AS n_rows, count(volume) AS n_volume, {_r("sum(volume)", "volume")},
       min(trade_date) AS first_date, {_r("sum(close_price)", "close_sum")},
       count(*) FILTER (volume IS NULL) AS n_rejected
FROM b GROUP BY symbol
"""

SECTOR_TREE = f"""
WITH {MEMBERS_CTE}
SELECT sector, count(*) AS members, min(symbol) AS first_symbol, max(symbol) AS last_symbol FROM mem GROUP BY sector
UNION ALL SELECT '(files at another depth)', 1, NULL, NULL
"""

BARS_WINDOW = f"""
WITH {BARS_CTE}
SELECT symbol, trade_date, {_BAR} FROM bars WHERE trade_date BETWEEN DATE '1996-03-01' AND DATE '1996-05-31'
"""

SECTOR_MARKET_CAP = f"""
WITH {BARS_CTE}, {MEMBERS_CTE},
lastc AS (SELECT symbol, arg_max(close_price, trade_date) AS last_close FROM bars GROUP BY 1)
SELECT m.sector, count(*) AS members, count(l.last_close) AS priced,
       CAST(count(*) - count(l.symbol) AS BIGINT) AS missing_info,
       {r4("sum(m.shares * l.last_close)")} AS sector_market_cap
FROM mem m LEFT JOIN lastc l USING (symbol) GROUP BY m.sector
"""


DAILY_TRAINING_FRAME = f"""
WITH {BARS_CTE}, {RET_CTE}, {MEMBERS_CTE}, {SECTOR_AGG_CTE},
res AS (
  SELECT CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS g,
         sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS l
  FROM orders GROUP BY 1),
rl AS (SELECT date, lag(g) OVER (ORDER BY date) AS g1, lag(l) OVER (ORDER BY date) AS l1 FROM res),
sl AS (
  SELECT date, sector, weighted_sector_returns, n_stocks_contributing, sector_index,
         lag(sector_volume) OVER (PARTITION BY sector ORDER BY date) AS sector_volume
  FROM sd),
j AS (SELECT sl.*, rl.g1, rl.l1 FROM sl JOIN rl USING (date)
      WHERE {not_nan("sector_volume", "sector_index", "weighted_sector_returns", "g1", "l1")})
SELECT date, sector, {_r("weighted_sector_returns", "weighted_sector_returns")},
       {_r("n_stocks_contributing", "n_stocks_contributing")},
       {_s("sector_index", "sector_index")}, {_r("sector_volume", "sector_volume")},
       {_r("g1", '"foreign_reserve_gross(USD)_daily"')},
       {_r("l1", '"foreign_reserve_liquid(USD)_daily"')}
FROM j
"""
