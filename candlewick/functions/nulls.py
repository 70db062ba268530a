"""pandas-compatible null / NaN / zero semantics under Spark's ANSI mode.

pandas turns x/0 into +-inf (0/0 into NaN), sums of all-null groups into 0.0 and
skips NaN in aggregates; ANSI Spark raises on x/0 and returns null for empty sums.
These helpers restore the pandas meaning without leaving whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from candlewick.functions.columns import quoted

INF = float("inf")
NAN = float("nan")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b with IEEE results on zero divisors (x/0 = +-inf, 0/0 = NaN)."""
    a, b = _c(a), _c(b)
    return (F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
             .when(F.isnan(a), F.lit(NAN))
             .when(b == 0, F.when(a > 0, F.lit(INF)).when(a < 0, F.lit(-INF))
                            .otherwise(F.lit(NAN)))
             .otherwise(a.cast("double") / b))


def null_div(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is 0 (for results that a later dropna removes anyway)."""
    return F.try_divide(_c(a).cast("double"), _c(b))


def sum0(c: Column | str) -> Column:
    """pandas ``groupby().sum()``: the sum of an all-null group is 0.0, not null."""
    return F.coalesce(F.sum(_c(c)), F.lit(0.0))


def inf_to_null(c: Column | str) -> Column:
    """pandas ``replace([inf, -inf], nan)``."""
    c = _c(c)
    return F.when(c.isin(INF, -INF), F.lit(None).cast("double")).otherwise(c)


def nan_to_null(c: Column | str) -> Column:
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def numeric_columns(df: DataFrame) -> list[str]:
    """P3 ``select_dtypes(include='number')``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def drop_any_null(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """P10 ``dropna()``: drops rows holding null or NaN (inf is kept, as in pandas)."""
    return df.na.drop(how="any", subset=[quoted(c) for c in subset or df.columns])


def drop_all_null(df: DataFrame, subset: Iterable[str]) -> DataFrame:
    """P11 ``dropna(subset=..., how='all')``."""
    return df.na.drop(how="all", subset=[quoted(c) for c in subset])


def drop_inf_and_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """P14 then P10: inf and -inf count as missing."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    df = df.withColumns({c: inf_to_null(F.col(f"`{c}`")) for c in cols})
    return drop_any_null(df)


def null_counts(df: DataFrame) -> DataFrame:
    """P15 ``isna().sum()`` as one row, one column per input column (NaN counts too)."""
    exprs = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        miss = c.isNull()
        if isinstance(f.dataType, NumericType):
            miss = miss | F.isnan(c)
        exprs.append(F.sum(miss.cast("long")).alias(f.name))
    return df.agg(*exprs)


def inf_counts(df: DataFrame) -> DataFrame:
    """P16 ``np.isinf(X).sum()`` per numeric column, one row."""
    return df.agg(*[F.count_if(F.abs(F.col(f"`{c}`")) == INF).alias(c)
                    for c in numeric_columns(df)])


def info(df: DataFrame) -> DataFrame:
    """P19 ``DataFrame.info()``: column, type and non-null count as rows (one scan)."""
    nn = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', `{c}`" for c in df.columns)
    types = F.create_map(*[x for f in df.schema.fields
                           for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    out = nn.selectExpr(f"stack({len(df.columns)}, {stack}) as (column, non_null)")
    return out.withColumn("dtype", types[F.col("column")])


def binary_label(c: Column | str) -> Column:
    """P17 ``1 if x > 0 else 0``. Spark orders NaN above every number, so NaN is mapped
    to 0 explicitly (in Python ``nan > 0`` is False)."""
    c = _c(c)
    return F.when(F.isnan(c) | c.isNull(), F.lit(0)).when(c > 0, F.lit(1)).otherwise(F.lit(0))
