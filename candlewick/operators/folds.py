"""Time-ordered validation splits and train-only scaling (M1-M3).

Folds are assigned per key (sector) from the row position in date order:
``TimeSeriesSplit(n_splits=k)`` gives test size ``ts = n // (k + 1)``; fold f tests rows
``[n - (k - f) * ts, n - (k - f) * ts + ts)`` and trains on every row before them.

The long form (one row per (fold, role, row)) is what the per-fold statistics and model
fits consume. Feature tables are one row per (sector, day), so the k-fold expansion is
bounded by k times a calendar-sized table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from candlewick.functions.columns import col


def positions(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Adds ``row_idx`` (0-based position in date order) and ``n_rows`` per key."""
    w = Window.partitionBy(*key).orderBy(order)
    full = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumns({"row_idx": (F.row_number().over(w) - 1).cast("long"),
                           "n_rows": F.count(F.lit(1)).over(full)})


def time_series_folds(df: DataFrame, key: Sequence[str], order: str,
                      n_splits: int = 5) -> DataFrame:
    """M1 long form: (key..., fold, role in {'train','test'}, row_idx, columns...). Keys with fewer
    than ``n_splits + 1`` rows have no fold; ``short_keys`` lists them."""
    p = positions(df, key, order)
    ts = F.floor(F.col("n_rows") / F.lit(n_splits + 1))
    first_test = F.col("n_rows") - F.lit(n_splits) * ts        # start of fold 0's test block
    # the test fold holding this row (or -1 before the first test block)
    test_fold = F.when(F.col("row_idx") >= first_test,
                       F.floor((F.col("row_idx") - first_test) / ts)).otherwise(F.lit(-1))
    p = p.withColumn("__tf", F.when(ts > 0, test_fold).otherwise(F.lit(None)).cast("int"))
    # a row is 'train' for every later fold and 'test' for its own
    roles = F.array(
        F.struct(F.col("__tf").alias("fold"), F.lit("test").alias("role")),
        *[F.struct(F.lit(f).alias("fold"), F.lit("train").alias("role"))
          for f in range(n_splits)])
    keep = F.filter(roles, lambda r: (r["fold"] >= 0)
                    & (((r["role"] == "test") & (r["fold"] == F.col("__tf")))
                       | ((r["role"] == "train") & (r["fold"] > F.col("__tf")))))
    return (p.filter(F.col("__tf").isNotNull())
              .withColumn("__r", F.explode(keep))
              .select(*key, F.col("__r.fold").cast("int").alias("fold"),
                      F.col("__r.role").alias("role"), *[c for c in p.columns
                                                          if c not in key and c != "__tf"]))


def short_keys(df: DataFrame, key: Sequence[str], order: str, n_splits: int = 5) -> DataFrame:
    """Keys that have too few rows for folds, as rows of the fold report: role 'too short'."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.min(order).alias("first_date"),
                                 F.max(order).alias("last_date"))
            .where(F.col("rows") <= n_splits)
            .select(*key, F.lit(None).cast("int").alias("fold"), F.lit("too short").alias("role"), "rows",
                    F.lit(0).cast("long").alias("first_row"), (F.col("rows") - 1).alias("last_row"),
                    "first_date", "last_date"))


def ordered_holdout(df: DataFrame, key: Sequence[str], order: str,
                    test_size: float = 0.2) -> DataFrame:
    """M2 ``train_test_split(test_size, shuffle=False)``: the last ceil(test_size*n) rows
    of each key are 'test'."""
    p = positions(df, key, order)
    n_test = F.ceil(F.col("n_rows") * F.lit(test_size))
    return p.withColumn("role", F.when(F.col("row_idx") >= F.col("n_rows") - n_test,
                                       F.lit("test")).otherwise(F.lit("train")))


def fit_scaler(folds: DataFrame, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """M3 ``StandardScaler`` fitted on each fold's train rows: mean and population std
    (ddof 0), a zero std replaced by 1. One row per (key..., fold)."""
    tr = folds.filter(F.col("role") == "train")
    aggs = []
    for i, c in enumerate(features):
        aggs += [F.avg(col(c)).alias(f"mu{i}"), F.stddev_pop(col(c)).alias(f"sd{i}")]
    st = tr.groupBy(*key, "fold").agg(*aggs)
    return st.withColumns({f"sd{i}": F.when(F.col(f"sd{i}") == 0, F.lit(1.0))
                           .otherwise(F.col(f"sd{i}")) for i in range(len(features))})


def apply_scaler(folds: DataFrame, scaler: DataFrame, features: Sequence[str],
                 key: Sequence[str]) -> DataFrame:
    """Scale train and test rows of each fold with that fold's train statistics."""
    j = folds.join(scaler, [*key, "fold"])     # scaler: one row per (key, fold)
    return j.select(*[c for c in folds.columns if c not in features],
                    *[((col(c) - F.col(f"mu{i}")) / F.col(f"sd{i}")).alias(c)
                      for i, c in enumerate(features)])
