import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.operators import folds, linear, metrics

X = ["a", "b.c", "d"]


def _frame(spark, seed, classes=False):
    """Two keys, two folds, collinear features; test rows that must not matter to a fit."""
    rng = np.random.default_rng(seed)
    rows = []
    for k in ("p", "q"):
        for fold in range(2):
            n = 60 + 40 * fold
            x = rng.normal(size=(n, 3))
            x[:, 2] = x[:, 0] + 0.1 * x[:, 2]
            y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(size=n) + 5
            if classes:
                y = (y > 5).astype(float)
            rows += [(k, fold, "train" if i < n - 10 else "test", i, *map(float, x[i]), float(y[i])) for i in range(n)]
    schema = "k string, fold int, role string, row_idx int, a double, `b.c` double, d double, y double"
    return spark.createDataFrame(rows, schema), pd.DataFrame(rows, columns=["k", "fold", "role", "row_idx", *X, "y"])


@pytest.mark.parametrize("alpha,ratio", [(1.0, 1.0), (1.0, 0.5), (0.1, 0.9), (0.05, 1.0), (100.0, 1.0)])
def test_coordinate_descent_meets_the_optimality_conditions(spark, alpha, ratio):
    df, pdf = _frame(spark, 1)
    got = {(r.k, r.fold): r for r in linear.elastic_net(df, X, ["k"], "y", alpha, ratio).collect()}
    assert len(got) == 4
    for key, part in pdf[pdf.role == "train"].groupby(["k", "fold"]):
        x, y, w = part[X].to_numpy(), part["y"].to_numpy(), np.array(got[key].w)
        miss = y - x @ w - got[key].intercept
        assert abs(miss.mean()) < 1e-9
        slope = x.T @ miss / len(y) - alpha * (1 - ratio) * w
        assert np.all(np.abs(slope[w == 0]) <= alpha * ratio + 1e-6)
        assert np.all(np.abs(slope - alpha * ratio * np.sign(w))[w != 0] < 1e-6)
    if alpha == 100.0:
        assert all(set(r.w) == {0.0} for r in got.values())


def test_a_constant_feature_gets_no_weight(spark):
    df, _ = _frame(spark, 2)
    got = linear.elastic_net(df.withColumn("a", F.lit(0.0)), X, ["k"], "y", 0.1, 1.0).collect()
    assert all(r.w[0] == 0.0 and r.w[1] != 0 for r in got)


def test_logistic_meets_the_optimality_conditions(spark):
    df, pdf = _frame(spark, 3, classes=True)
    got = {(r.k, r.fold): r for r in linear.logistic(df, X, ["k"], "y").collect()}
    assert len(got) == 4
    for key, part in pdf[pdf.role == "train"].groupby(["k", "fold"]):
        x, y, w = part[X].to_numpy(), part["y"].to_numpy(), np.array(got[key].w)
        p = 1 / (1 + np.exp(-(x @ w + got[key].intercept)))
        assert np.abs(x.T @ (p - y) + w).max() < 1e-6 and abs((p - y).sum()) < 1e-6
    pred = linear.predict(df, linear.logistic(df, X, ["k"], "y"), X, ["k"])
    assert pred.count() == len(pdf)


def test_logistic_on_separable_and_one_class_rows(spark):
    rows = [("s", 0, "train", float(v), 50.0 * v, float(v > 0)) for v in range(-20, 20)]
    rows += [("one", 0, "train", float(v), 1.0, 1.0) for v in range(10)]
    df = spark.createDataFrame(rows, "k string, fold int, role string, a double, b double, y double")
    out = linear.predict(df, linear.logistic(df, ["a", "b"], ["k"], "y"), ["a", "b"], ["k"])
    bad = out.where((F.col("prediction") > 0) != (F.col("y") > 0)).count()
    assert bad == 0 and out.where(F.isnan("prediction")).count() == 0


def test_confusion_has_a_row_for_an_absent_class(spark):
    df = spark.createDataFrame([("g", 1, 1), ("g", 1, 0), ("h", 0, 0)], "k string, label int, prediction int")
    got = sorted(map(tuple, metrics.confusion(df, ["k"]).collect()))
    assert got == [("g", 0, 0, 0), ("g", 1, 1, 1), ("h", 0, 1, 0), ("h", 1, 0, 0)]


def test_short_keys_are_reported(spark):
    rows = [("long", i) for i in range(12)] + [("short", i) for i in range(5)] + [("six", i) for i in range(6)]
    df = spark.createDataFrame(rows, "k string, d int")
    assert [tuple(r) for r in folds.short_keys(df, ["k"], "d").collect()] == [("short", None, "too short", 5, 0, 4, 0, 4)]
    assert {r.k for r in folds.time_series_folds(df, ["k"], "d").select("k").distinct().collect()} == {"long", "six"}
