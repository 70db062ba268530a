"""Join helpers (J1-J9): keyed lookups, missing-key reports, joins on hot keys.

No side is forced into a broadcast: Spark broadcasts one whose size, estimated or measured by
adaptive execution, lies below the session's threshold, and keeps a shuffle join beyond it. Only
``join_counted`` broadcasts by itself, fewer than ``HOT_SHARE`` rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def lookup_first(ref: DataFrame, key: str, cols: Sequence[str], order: str) -> DataFrame:
    """P7 ``df.loc[df.key == k, col].iloc[0]`` for every key at once: the row that comes first
    in ``order`` wins as a whole."""
    first = F.min_by(F.struct(*cols), order).alias("first")
    return ref.groupBy(key).agg(first).select(key, "first.*")


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks (``left_anti``)."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


#: A key is hot if it holds more than one in ``HOT_SHARE`` of the rows, and so many that one task should
#: not get them all. There are fewer than ``HOT_SHARE`` such keys.
HOT_SHARE, HOT_ROWS = 1000, 20_000


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``rows`` joined to ``table``, which has one row a key and in ``n`` the number of rows of
    ``rows`` with that key. Hot keys are broadcast, so that their rows stay where they are; the others
    are joined as Spark sees fit."""
    sums = table.agg(F.sum(n), F.max(n)).first()
    total, most = sums[0] or 0, sums[1] or 0
    if most < HOT_ROWS or most * HOT_SHARE <= total:
        return rows.join(table, keys)
    is_hot = (F.col(n) >= HOT_ROWS) & (F.col(n) * HOT_SHARE > F.lit(total))
    hot = F.broadcast(table.where(is_hot))
    rest = rows.join(hot.select(*keys), keys, "left_anti").join(table.where(~is_hot), keys)
    return rows.join(hot, keys).unionByName(rest)
