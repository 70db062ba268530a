import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from candlewick.operators import boosting as B

from conftest import SF001


def data(n=600, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 5))
    return x, (x[:, 2] + 0.3 * rng.normal(size=n) > 0.2).astype(float), np.arange(n) < n // 2


def test_boosted_trees_learn_and_rank_the_feature():
    x, y, train = data()
    pred, weight = B.boosted_trees(x, y, train, "classification", B.TUNED | {"least_weight": 5.0})
    assert (pred == y)[~train].mean() > 0.85
    assert weight.argmax() == 2 and abs(weight.sum() - 1) < 1e-9
    value = 3 * x[:, 1] + 1
    pred, _ = B.boosted_trees(x, value, train, "regression", B.TUNED | {"rate": 0.1})
    assert np.mean((pred - value)[~train] ** 2) < 0.3 * value.var()
    # no split is allowed: the train mean is all there is
    pred, weight = B.boosted_trees(x, value, train, "regression", B.TUNED | {"least_weight": 1e9})
    assert np.ptp(pred) < 1e-9 and weight.sum() == 0


def test_first_split_is_the_best_one():
    x, y, train = data(80, 3)
    p = B.TUNED | {"depth": 1, "rounds": 1, "rows": 1.1, "columns": 1.0, "rate": 1.0, "l1": 0.0, "l2": 1.0, "least_weight": 1.0}
    pred, _ = B.boosted_trees(x, y, train, "regression", p)
    bins, g = B.binned(x[train], x), y[train].mean() - y
    best = None
    for c in range(5):
        for cut in range(B.BINS):
            low = bins[:, c] <= cut
            a, b = low & train, ~low & train
            if a.sum() and b.sum():
                gain = g[a].sum() ** 2 / (a.sum() + 1) + g[b].sum() ** 2 / (b.sum() + 1)
                if best is None or gain > best[0] + 1e-12:
                    best = gain, y[train].mean() - np.where(low, g[a].sum() / (a.sum() + 1), g[b].sum() / (b.sum() + 1))
    np.testing.assert_allclose(pred, best[1])


def test_adaboost_beats_its_first_stump():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] + x[:, 1] + x[:, 2]) > 0).astype(float)
    train = np.arange(800) < 500
    assert (B.adaboost(x, y, train)[0] == y)[~train].mean() > (B.adaboost(x, y, train, 1)[0] == y)[~train].mean() + 0.1
    assert (B.adaboost(x, np.ones(800), train)[0] == 1).all()


@pytest.mark.parametrize("name", ["boosted_scores", "adaboost_scores", "boosted_importance", "boosted_regression", "holdout_scores"])
def test_queries(spark, name):
    df = E.queries()[name](spark, SF001)
    rows = df.toPandas()
    assert len(rows)
    if name == "boosted_importance":
        sums = rows.groupby("sector")["fold_0"].sum()
        assert ((sums - 1).abs() < 0.01).where(sums > 0, True).all()
    elif name == "boosted_regression":
        assert (rows["rmse"] >= 0).all() and set(rows["role"]) == {"train", "test"}
    elif name == "holdout_scores":
        assert set(rows["model"]) == {"logistic", "tree", "forest", "naive_bayes_ml", "adaboost", "boosted"}
        assert rows["accuracy"].between(0, 1).all()
    else:
        assert rows["test_accuracy"].between(0, 1).all() and rows["train_accuracy"].between(0, 1).all()


@pytest.mark.parametrize("name", ["boosted_scores", "boosted_regression", "holdout_scores"])
def test_tuned_and_default_settings(spark, name):
    rows = E.queries()[name](spark, SF001).toPandas()
    if name == "holdout_scores":
        rows = rows[(rows["model"] == "boosted") & (rows["role"] == "train")]
        score = "accuracy"
    elif name == "boosted_regression":
        rows, score = rows[rows["role"] == "train"], "r2"
    else:
        score = "train_accuracy"
    mean = rows.groupby("settings")[score].mean()
    assert set(mean.index) == {"tuned", "default"} and rows["settings"].value_counts().nunique() == 1
    assert mean["default"] > mean["tuned"]      # deep trees at rate 0.3 fit the train rows closer


def test_reports_of_all_classifiers(spark):
    rows = E.queries()["holdout_report"](spark, SF001).toPandas()
    key = ["model", "settings", "sector"]
    assert set(rows["model"]) == {"logistic", "tree", "forest", "naive_bayes_ml", "adaboost", "boosted"}
    assert set(rows["class"]) == {"0", "1", "macro avg", "weighted avg"}
    per_class = rows[rows["class"].isin(["0", "1"])]
    assert (per_class["pred_0"] + per_class["pred_1"] == per_class["support"]).all()
    # accuracy is the diagonal of the confusion matrix, and the weighted recall
    hits = per_class["pred_0"].where(per_class["class"] == "0", per_class["pred_1"])
    got = hits.groupby([per_class[c] for c in key]).sum() / per_class.groupby(key)["support"].sum()
    weighted = rows[rows["class"] == "weighted avg"].set_index(key)["recall"]
    np.testing.assert_allclose(weighted.sort_index(), got.sort_index(), atol=1e-4)


def test_counted_rows_give_the_metrics_of_single_rows(spark):
    from candlewick.operators import metrics
    rng = np.random.default_rng(3)
    cells = [(g, int(y), int(p)) for g, y, p in zip("aab" * 40, rng.integers(0, 2, 120), rng.integers(0, 2, 120))]
    single = spark.createDataFrame([*cells, ("c", 1, 1)], "g string, label int, prediction int")
    counted = single.groupBy("g", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    for f, order in ((metrics.confusion, ["g", "true_class"]), (metrics.classification_report, ["g", "class"])):
        a = f(single, ["g"]).toPandas().sort_values(order, ignore_index=True)
        b = f(counted, ["g"], n="n").toPandas().sort_values(order, ignore_index=True)
        assert a.equals(b.astype(a.dtypes)), (a, b)
