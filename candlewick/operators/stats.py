"""Statistics over feature tables (A8-A15): correlation matrix and screen, describe,
value counts, mode, fold summaries.

Every statistic is one aggregation pass with map-side partial aggregation; ``group``
optionally computes it per key (e.g. per sector) in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from candlewick.functions.columns import col
from candlewick.operators.joins import join_counted
from candlewick.session import cut_lineage

NAN = float("nan")


#: Groups whose moments a task holds at a time; more are passed on in parts.
GROUPS_HELD = 64
#: A variance below this share of the mean square about the shift is rounding: a constant column.
CONSTANT = 1e-13
MOMENTS = ("n", "sx", "sy", "sxx", "syy", "sxy")


class _Moments:
    """Pairwise-complete moments of one group about a shift, as blocks of matrix products."""

    def __init__(self, k: int, rows: list[int], cols: list[int]):
        self.rows, self.cols = rows, cols
        self.shift, self.known = np.zeros(k), np.zeros(k, bool)
        self.sums = [np.zeros((len(rows), len(cols))) for _ in MOMENTS]

    def add(self, x: np.ndarray, there: np.ndarray) -> None:
        for c in np.flatnonzero(~self.known & there.any(axis=0)):     # the first value of a column
            self.shift[c], self.known[c] = x[there[:, c].argmax(), c], True
        v = np.where(there, x, self.shift) - self.shift
        m = there.astype(np.float64)
        vi, vj, mi, mj = v[:, self.rows], v[:, self.cols], m[:, self.rows], m[:, self.cols]
        parts = (mi.T @ mj, vi.T @ mj, mi.T @ vj, (vi * vi).T @ mj, mi.T @ (vj * vj), vi.T @ vj)
        for total, part in zip(self.sums, parts):
            total += part


def _group_codes(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(group of every row, first row of every group) by the first n columns."""
    code = np.zeros(batch.num_rows, np.int64)
    for c in range(n):
        own = batch.column(c).dictionary_encode(null_encoding="encode")
        code = code * len(own.dictionary) + own.indices.to_numpy(zero_copy_only=False)
        code = np.unique(code, return_inverse=True)[1]
    return code, np.unique(code, return_index=True)[1]


def corr_pairs(df: DataFrame, cols: Sequence[str], pairs: Sequence[tuple[int, int]],
               group: Sequence[str] = ()) -> DataFrame:
    """Pearson of column pairs over pairwise-complete rows: (group..., i, j, corr).

    Blocked Gram aggregation: each Arrow batch adds the matrix products of its mask, values and
    squared values to its group's blocks, so no expression is built for a pair. A task passes on
    one row a pair and group, moments about a value of its own; the rows of a pair are moved to a
    common shift, which is near the data, and added up. Infinite values are missing ones; NaN for a
    constant column or fewer than two rows; all as pandas.
    """
    k, g = len(cols), len(group)
    rows, columns = sorted({i for i, _ in pairs}), sorted({j for _, j in pairs})
    at = [(rows.index(i), columns.index(j)) for i, j in pairs]
    pair_i, pair_j = (np.array([p[x] for p in pairs], np.int32) for x in (0, 1))
    at_i, at_j = (np.array([p[x] for p in at], np.int64) for x in (0, 1))
    slim = df.select(*[col(c) for c in group], *[col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    names = ["i", "j", *MOMENTS, "shift_i", "shift_j"]
    schema = StructType([*slim.schema.fields[:g], *[StructField(n, IntegerType()) for n in names[:2]],
                         *[StructField(n, DoubleType()) for n in names[2:]]])

    def passed_on(held: dict[tuple, _Moments], kinds: list[pa.DataType]) -> pa.RecordBatch:
        keys = [np.repeat(np.arange(len(held)), len(pairs)), list(held)]
        group_columns = [pa.array([key[c] for key in keys[1]], kinds[c]).take(pa.array(keys[0])) for c in range(g)]
        own = list(held.values())
        of_pairs = lambda f: pa.array(np.concatenate([f(m) for m in own]))
        return pa.RecordBatch.from_arrays(
            [*group_columns, pa.array(np.tile(pair_i, len(own))), pa.array(np.tile(pair_j, len(own))),
             *[of_pairs(lambda m, x=x: m.sums[x][at_i, at_j]) for x in range(len(MOMENTS))],
             of_pairs(lambda m: m.shift[pair_i]), of_pairs(lambda m: m.shift[pair_j])], names=schema.names)

    def run(batches):
        held: dict[tuple, _Moments] = {}
        kinds: list[pa.DataType] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.column(c).type for c in range(g)]
            x = np.column_stack([batch.column(g + c).to_numpy(zero_copy_only=False) for c in range(k)]).astype(np.float64)
            code, first = _group_codes(batch, g)
            there = np.isfinite(x)                         # nulls arrive as NaN
            for n, row in enumerate(first.tolist()):
                key = tuple(batch.column(c)[row].as_py() for c in range(g))
                if key not in held and len(held) >= GROUPS_HELD:
                    yield passed_on(held, kinds)
                    held = {}
                mine = code == n
                held.setdefault(key, _Moments(k, rows, columns)).add(x[mine], there[mine])
        if held:
            yield passed_on(held, kinds)

    parts = slim.mapInArrow(run, schema)
    by = [*group, "i", "j"]
    w = Window.partitionBy(*[col(c) for c in by])
    # moments about c = s + d:  sum(x-c) = sum(x-s) - n d, and so on; d is a distance between values
    seen = F.col("n") > 0                     # pairs without a common row stay, as NaN
    moved = (parts.withColumns({"ci": F.min(F.when(seen, F.col("shift_i"))).over(w),
                                "cj": F.min(F.when(seen, F.col("shift_j"))).over(w)})
             .withColumns({"di": F.col("ci") - F.col("shift_i"), "dj": F.col("cj") - F.col("shift_j")}))
    n, sx, sy, di, dj = (F.col(c) for c in ("n", "sx", "sy", "di", "dj"))
    sums = moved.groupBy(*[col(c) for c in by]).agg(
        F.sum(n).alias("n"), F.sum(sx - n * di).alias("sx"), F.sum(sy - n * dj).alias("sy"),
        F.sum(F.col("sxx") - 2 * di * sx + n * di * di).alias("sxx"),
        F.sum(F.col("syy") - 2 * dj * sy + n * dj * dj).alias("syy"),
        F.sum(F.col("sxy") - dj * sx - di * sy + n * di * dj).alias("sxy"))
    vx, vy = (F.col(f"s{a}{a}") - F.col(f"s{a}") * F.col(f"s{a}") / n for a in "xy")
    cov = F.col("sxy") - sx * sy / n
    flat = (vx <= CONSTANT * F.col("sxx")) | (vy <= CONSTANT * F.col("syy"))
    r = cov / F.sqrt(vx * vy)
    r = F.when(F.col("i") == F.col("j"), 1.0).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))
    corr = F.when(n.isNull() | (n < 2) | flat, F.lit(NAN)).otherwise(r)
    return sums.select(*[col(c) for c in group], "i", "j", corr.alias("corr"))


def _named(pairs: DataFrame, cols: Sequence[str], group: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in cols])
    return pairs.select(*group, F.col("i").cast("int").alias("i"),
                        F.element_at(names, F.col("i") + 1).alias("col_i"),
                        F.col("j").cast("int").alias("j"),
                        F.element_at(names, F.col("j") + 1).alias("col_j"), "corr")


def corr_long(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """A11 ``df.corr()`` as a long table (group..., i, col_i, j, col_j, corr).

    Pearson over pairwise-complete rows (null and NaN are missing); NaN for a constant
    column, including its diagonal entry, as pandas. One upper-triangle-plus-diagonal
    aggregation; the lower triangle is its mirror.
    """
    pairs = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    m = corr_pairs(df, cols, pairs, group)
    upper = F.struct("i", "j", "corr")
    lower = F.struct(F.col("j").alias("i"), F.col("i").alias("j"), "corr")
    both = F.when(F.col("i") == F.col("j"), F.array(upper)).otherwise(F.array(upper, lower))
    long = m.select(*group, F.explode(both).alias("e")).select(*group, "e.*")
    return _named(long, cols, group)


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str,
                     group: Sequence[str] = ()) -> DataFrame:
    """A12 ``corr_matrix[target]``: (group..., feature, corr), one pass over k pairs."""
    allc = list(cols) + ([target] if target not in cols else [])
    t = allc.index(target)
    m = corr_pairs(df, allc, [(i, t) for i in range(len(cols))], group)
    return _named(m, allc, group).select(*group, F.col("col_i").alias("feature"), "corr")


def corr_screen(df: DataFrame, cols: Sequence[str], threshold: float = 0.85,
                group: Sequence[str] = ()) -> DataFrame:
    """A13 ``correlation(dataset, threshold)`` pairs: lower triangle (j < i), strict
    ``abs(r) > threshold``; the flagged column of each pair is ``col_i`` (the later one)."""
    m = corr_pairs(df, cols, [(i, j) for i in range(len(cols)) for j in range(i)], group)
    # NaN (constant column) never passes: in pandas NaN > t is False, in Spark it is True
    return _named(m.filter(~F.isnan("corr") & (F.abs(F.col("corr")) > threshold)), cols, group)


def flagged_columns(pairs: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """A13 ``col_corr`` set: distinct flagged (later) columns."""
    return pairs.select(*group, "col_i").distinct()


#: Rows of a range that one task sorts; the grid that narrows larger ranges, and its rank error as one
#: over so many rows, far finer than the grid.
SORT_ROWS, GRID, ACCURACY = 100_000, 256, 10_000
QUARTILES = (0.25, 0.5, 0.75)


def _narrowed(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """Narrow the ranges of ``targets``: a grid of approximate percentiles inside each range brackets
    its ranks; then the rows below and inside the new range are counted exactly."""
    at = ["g", "i", "k"]
    n_rows = targets.select("g", "i", "k", "first", "second", "below", "inside", "a", "b")
    inside = join_counted(rows, n_rows.groupBy("g", "i").agg(
        F.collect_list(F.struct("k", "a", "b")).alias("ranges"), F.max("inside").alias("n")), ["g", "i"], "n")
    inside = inside.select("g", "i", "x", F.explode("ranges").alias("r")).where("x >= r.a AND x <= r.b")
    grid = F.percentile_approx("x", [j / GRID for j in range(GRID + 1)], ACCURACY)
    grids = inside.groupBy("g", "i", F.col("r.k").alias("k")).agg(grid.alias("grid"))
    part = lambda c: F.floor((F.col(c) - F.col("below")) * GRID / F.col("inside")).cast("int")
    new = cut_lineage(targets.join(grids, at).withColumns({
        "a": F.when(part("first") >= 2, F.element_at("grid", part("first"))).otherwise(F.col("a")),
        "b": F.when(part("second") <= GRID - 3, F.element_at("grid", part("second") + 3)).otherwise(F.col("b"))})
        .drop("grid"))
    old = targets.select(*at, F.col("a").alias("old_a"))
    spans = new.join(old, at).groupBy("g", "i").agg(
        F.collect_list(F.struct("k", "a", "b", "old_a")).alias("ranges"), F.max("inside").alias("n"))
    seen = join_counted(rows, spans, ["g", "i"], "n").select("g", "i", "x", F.explode("ranges").alias("r"))
    counts = seen.where("x >= r.old_a AND x <= r.b").groupBy("g", "i", F.col("r.k").alias("k")).agg(
        F.count_if(F.col("x") < F.col("r.a")).alias("skipped"), F.count_if(F.col("x") >= F.col("r.a")).alias("left"))
    return cut_lineage(new.join(counts, at).withColumns({"below": F.col("below") + F.col("skipped"),
                                                         "inside": F.col("left")}).drop("skipped", "left"))


def describe(df: DataFrame, cols: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """A9 ``describe()`` in long form (group..., column, count, mean, std, min, 25%, 50%,
    75%, max) with exact linearly interpolated percentiles (pandas; NaN is missing), std with ddof 1.

    Percentiles come from distributed rank selection: ranges that hold more than ``SORT_ROWS`` rows are
    narrowed around the wanted ranks, round by round, with bounded sketches and exact counts; only
    the values left in a range, equal ones counted once, are put in order by one task. Groups of any size
    take the same way.
    """
    x = {c: F.when(~F.isnan(col(c).cast("double")), col(c).cast("double")) for c in cols}
    data = cut_lineage(df.select(F.struct(*[col(c) for c in group], F.lit(0).alias("__one")).alias("g"),
                                 *[v.alias(f"x{i}") for i, v in enumerate(x.values())]))
    stats = F.array(*[F.struct(
        F.lit(i).alias("i"), F.lit(c).alias("column"), F.count(f"x{i}").alias("count"), F.avg(f"x{i}").alias("mean"),
        F.stddev_samp(f"x{i}").alias("std"), F.min(f"x{i}").alias("min"), F.max(f"x{i}").alias("max"))
        for i, c in enumerate(cols)])
    table = cut_lineage(data.groupBy("g").agg(stats.alias("s")).select("g", F.explode("s").alias("s")).select("g", "s.*"))
    rows = data.select("g", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x")) for i in range(len(cols))])).alias("v")).select(
        "g", "v.*").where("x IS NOT NULL")
    place = F.col("p") * (F.col("count") - 1)
    targets = (
        table.where("count > 0").select("g", "i", "count", "min", "max", F.posexplode(F.array(*map(F.lit, QUARTILES)))
                                        .alias("k", "p"))
        .select("g", "i", "k", F.floor(place).alias("first"), F.ceil(place).alias("second"),
                (place - F.floor(place)).alias("part"), F.col("min").alias("a"), F.col("max").alias("b"),
                F.lit(0).cast("long").alias("below"), F.col("count").alias("inside")))
    wide, narrowed = (F.col("inside") > SORT_ROWS) & (F.col("a") < F.col("b")), False
    while not targets.where(wide).isEmpty():
        done, before = targets.where(~wide), targets.where(wide)
        new, narrowed = _narrowed(rows, before), True
        # a range that its rows' ties keep from narrowing is put in order as it is
        stuck = new.join(before.select("g", "i", "k", F.col("inside").alias("had")), ["g", "i", "k"])
        if stuck.where(F.col("inside") < F.col("had")).isEmpty():
            targets = done.unionByName(new)
            break
        targets = cut_lineage(done.unionByName(new))
    spans = targets.groupBy("g", "i").agg(
        F.collect_list(F.struct("k", "a", "b", "first", "second", "below")).alias("ranges"), F.max("inside").alias("n"))
    # without a narrowed range no group holds more than SORT_ROWS rows, so no key is hot
    met = join_counted(rows, spans, ["g", "i"], "n") if narrowed else rows.join(spans, ["g", "i"])
    inside = (met.select("g", "i", "x", F.explode("ranges").alias("r"))
              .where("x >= r.a AND x <= r.b").groupBy("g", "i", "r", "x").agg(F.count(F.lit(1)).alias("n")))
    upto = F.sum("n").over(Window.partitionBy("g", "i", "r.k").orderBy("x")) + F.col("r.below")
    found = (inside.withColumn("upto", upto).groupBy("g", "i", F.col("r.k").alias("k")).agg(
        F.min(F.when(F.col("upto") > F.col("r.first"), F.col("x"))).alias("low"),
        F.min(F.when(F.col("upto") > F.col("r.second"), F.col("x"))).alias("high")))
    value = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    quartiles = found.join(targets.select("g", "i", "k", "part"), ["g", "i", "k"]).groupBy("g", "i").agg(*[
        F.min(F.when(F.col("k") == k, value)).alias(n) for k, n in enumerate(("p25", "p50", "p75"))])
    out = table.join(quartiles, ["g", "i"], "left")
    return out.select(*[F.col("g")[c].alias(c) for c in group], "column", "count", "mean", "std", "min", "p25", "p50",
                      "p75", "max")


def value_counts(df: DataFrame, c: str, group: Sequence[str] = ()) -> DataFrame:
    """A8 ``value_counts()``: (group..., value, count), most frequent first."""
    return (df.groupBy(*group, col(c).alias("value")).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(*group, F.desc("count"), "value"))


def row_stats(long: DataFrame, key: str, value: str) -> DataFrame:
    """A15 row-wise mean / std (ddof 1) of a wide table, computed on its long form."""
    return long.groupBy(key).agg(F.avg(value).alias("mean"),
                                 F.stddev_samp(value).alias("std"))
