"""Penalised linear models of every (key, fold), all groups in one job (M5, M6, M9).

* Lasso and elastic net: one aggregation gives each group's centred Gram matrix; cyclic coordinate
  descent with soft-thresholding then works on k * k numbers a group, whatever its rows.
* Logistic regression: Newton's method. Each step is one aggregation of loss, gradient and Hessian
  over the rows of all groups that are not done; the new coefficients, one row a group, are written
  to a shared table that the next step reads. A step that does not lower the loss is halved.

Only train rows are fitted; ``predict`` returns every row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from candlewick.functions.columns import col
from candlewick.session import cut_lineage

SWEEPS, TOLERANCE = 10_000, 1e-13
NEWTON_STEPS, GRADIENT = 60, 1e-10


def grams(scaled: DataFrame, features: Sequence[str], key: Sequence[str], y: str) -> DataFrame:
    """One row per (key, fold): ``my``, ``mx`` (means), ``xx`` (covariances, row by row) and ``xy``."""
    x = [col(c) for c in features]
    tr = scaled.filter(F.col("role") == "train")
    once = {(i, j): F.covar_pop(x[i], x[j]) for i in range(len(x)) for j in range(i, len(x))}
    return tr.groupBy(*key, "fold").agg(
        F.avg(col(y)).alias("my"), F.array(*map(F.avg, x)).alias("mx"),
        F.array(*[once[min(i, j), max(i, j)] for i in range(len(x)) for j in range(len(x))]).alias("xx"),
        F.array(*[F.covar_pop(c, col(y)) for c in x]).alias("xy"))


def coordinate_descent(xx: np.ndarray, xy: np.ndarray, l1: float, l2: float) -> np.ndarray:
    """Minimiser of w'xx w / 2 - xy'w + l1 |w|_1 + l2 |w|_2^2 / 2, one coordinate at a time."""
    w = np.zeros(len(xy))
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(w)):
            scale = xx[j, j] + l2
            rho = xy[j] - xx[j] @ w + xx[j, j] * w[j]
            new = np.sign(rho) * max(abs(rho) - l1, 0.0) / scale if scale > 0 else 0.0
            moved, w[j] = max(moved, abs(new - w[j])), new
        if moved <= TOLERANCE:
            break
    return w


def elastic_net(scaled: DataFrame, features: Sequence[str], key: Sequence[str], y: str,
                alpha: float = 1.0, l1_ratio: float = 0.5) -> DataFrame:
    """M5 (``l1_ratio=1``) and M6: coefficients ``w`` and ``intercept`` per (key, fold), those of
    |y - Xw - b|^2 / 2n + alpha * l1_ratio |w|_1 + alpha * (1 - l1_ratio) |w|^2 / 2."""
    g, k = [*key, "fold"], len(features)
    gram = grams(scaled, features, key, y)
    schema = StructType([*[gram.schema[c] for c in g], StructField("intercept", DoubleType()),
                         StructField("w", ArrayType(DoubleType()))])

    def solve(frames):
        for pdf in frames:                                    # one row per (key, fold)
            ws = [coordinate_descent(np.array(xx).reshape(k, k), np.array(xy), alpha * l1_ratio,
                                     alpha * (1 - l1_ratio)) for xx, xy in zip(pdf["xx"], pdf["xy"])]
            out = pdf[g].copy()
            out["intercept"] = [my - np.dot(mx, w) for my, mx, w in zip(pdf["my"], pdf["mx"], ws)]
            out["w"] = [w.tolist() for w in ws]
            yield out

    return gram.mapInPandas(solve, schema)


def _linear(features: Sequence[str], w: str = "w") -> Column:
    out = F.lit(0.0)
    for i, c in enumerate(features):
        out = out + F.col(w)[i] * col(c)
    return out


def predict(scaled: DataFrame, coefficients: DataFrame, features: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Every row with its group's ``prediction``."""
    rows = scaled.join(coefficients, [*key, "fold"])
    return rows.select(*[F.col(f"`{c}`") for c in scaled.columns],
                       (F.col("intercept") + _linear(features)).alias("prediction"))


def logistic(scaled: DataFrame, features: Sequence[str], key: Sequence[str], y: str = "label",
             c: float = 1.0) -> DataFrame:
    """M9: ``w`` and ``intercept`` per (key, fold) of sum(log(1 + exp(-z))) + |w|^2 / 2c over the train
    rows; the intercept is not penalised."""
    g, k = [*key, "fold"], len(features)
    train = scaled.filter(F.col("role") == "train").select(
        *g, F.col(y).cast("double").alias("__y"), F.array(F.lit(1.0), *[col(f) for f in features]).alias("__x"))
    zeros = F.array_repeat(F.lit(0.0), k + 1)
    state = train.select(*g).distinct().select(
        *g, zeros.alias("w"), zeros.alias("base"), zeros.alias("direction"), F.lit(1.0).alias("step"),
        F.lit(None).cast("double").alias("least"), F.lit(False).alias("done"))
    schema = state.schema
    penalty = np.diag([0.0] + [1.0 / c] * k)

    def stepped(r) -> list:
        w, base, direction = (np.array(r[n]) for n in ("w", "base", "direction"))
        loss = r["loss"] + w @ penalty @ w / 2
        if not pd.isna(r["least"]) and not loss <= r["least"]:
            step = r["step"] / 2                                       # no gain: halve
            if step < 1e-9:
                return [base, base, direction, step, r["least"], True]
            return [base + step * direction, base, direction, step, r["least"], False]
        gradient = np.array(r["gradient"]) + penalty @ w
        if np.abs(gradient).max() <= GRADIENT * r["n"]:
            return [w, w, direction, 1.0, loss, True]
        direction = -np.linalg.solve(np.array(r["hessian"]).reshape(k + 1, k + 1) + penalty
                                     + 1e-12 * np.eye(k + 1), gradient)
        return [w + direction, w, direction, 1.0, loss, False]

    def solve(frames):
        for pdf in frames:                                    # one row per (key, fold)
            new = [stepped(r) for _, r in pdf.iterrows()]
            out = pdf[g].copy()
            for i, n in enumerate(("w", "base", "direction")):
                out[n] = [x[i].tolist() for x in new]
            for i, n in enumerate(("step", "least", "done"), 3):
                out[n] = [x[i] for x in new]
            yield out

    x = lambda i: F.col("__x")[i]
    z = F.col("w")[0]
    for i in range(1, k + 1):
        z = z + F.col("w")[i] * x(i)
    m = F.when(F.col("__y") > 0, F.col("__z")).otherwise(-F.col("__z"))
    loss = F.when(m > 0, F.log1p(F.exp(-m))).otherwise(F.log1p(F.exp(m)) - m)
    p = 1.0 / (1.0 + F.exp(-F.greatest(F.least(F.col("__z"), F.lit(700.0)), F.lit(-700.0))))
    bend = F.col("__p") * (1.0 - F.col("__p"))
    once = {(i, j): F.sum(bend * x(i) * x(j)) for i in range(k + 1) for j in range(i, k + 1)}
    state = cut_lineage(state)
    for _ in range(NEWTON_STEPS):
        todo = state.where(~F.col("done"))
        if todo.isEmpty():
            break
        sums = (train.join(todo.select(*g, "w"), g).withColumn("__z", z).withColumn("__p", p).groupBy(*g).agg(
            F.count(F.lit(1)).alias("n"), F.sum(loss).alias("loss"),
            F.array(*[F.sum((F.col("__p") - F.col("__y")) * x(i)) for i in range(k + 1)]).alias("gradient"),
            F.array(*[once[min(i, j), max(i, j)] for i in range(k + 1) for j in range(k + 1)]).alias("hessian")))
        state = cut_lineage(todo.join(sums, g).mapInPandas(solve, schema).unionByName(state.where("done")))
    return state.select(*g, F.col("base")[0].alias("intercept"), F.slice("base", 2, k).alias("w"))
