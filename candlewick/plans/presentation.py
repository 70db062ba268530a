"""Final projection used by registered queries: doubles rounded to 4 places.

The library operators keep full precision; the registered queries round at the very end
so their results compare stably with the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def round_half_away(c, places: int = 4):
    """``round(x * 10^p) / 10^p``: the scaled product is the same IEEE double on every
    engine, so half-way cases round the same way everywhere (half away from zero)."""
    scale = float(10 ** places)
    return F.round(c * F.lit(scale)) / F.lit(scale)


def round_significant(c, digits: int = 7):
    """Round to ``digits`` significant digits through ``%e`` formatting (any magnitude,
    inf and NaN included) -- used for compounded quantities such as an index."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits - 1}e", c).cast("double"))


def rounded(df: DataFrame, places: int = 4, significant: tuple[str, ...] = (),
            digits: int = 7) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = round_significant(c, digits) if f.name in significant else round_half_away(c, places)
        out.append(c.alias(f.name))
    return df.select(*out)
