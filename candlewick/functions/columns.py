"""Column-list helpers (P1-P6): suffix selectors, checked drops, name normalisation."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

FREQ_SUFFIXES = ("_daily", "_monthly", "_quarterly")


def quoted(name: str) -> str:
    """The name in backticks, for functions that parse the names they are given."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """Column reference safe for names holding dots, spaces, commas or parentheses."""
    return F.col(quoted(name))


def by_suffix(df: DataFrame, suffix: str) -> list[str]:
    """Every column whose name ends with ``suffix`` (frequency tags)."""
    return [c for c in df.columns if c.endswith(suffix)]


def drop_checked(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P1 ``DataFrame.drop(columns=...)``; like pandas, an absent name is an error."""
    cols = list(cols)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def normalise_name(name: str) -> str:
    """Trim and replace characters that need quoting; keeps the frequency suffix."""
    s = re.sub(r"[^0-9A-Za-z_()]+", "_", name.strip())
    return re.sub(r"_+", "_", s).strip("_")


def normalise_names(df: DataFrame) -> DataFrame:
    """P5 on ingest: one rename pass so later code needs no backticks."""
    return df.withColumnsRenamed({c: normalise_name(c) for c in df.columns
                                  if normalise_name(c) != c})
