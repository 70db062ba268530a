"""Model fitting per (key, fold).

Two kinds of estimators:

* Native, fully grouped fits that train every (sector, fold) model in one job:
  Gaussian naive Bayes (class means / variances are grouped aggregates) and ridge
  regression (per-group Gram matrices X'X, X'y aggregated with partial aggregation, then a
  k x k solve per group -- the only non-SQL step works on k*k numbers, not on rows).
* Spark ML estimators (lasso, elastic net, trees, logistic regression, random forest) fitted
  once per (key, fold) by a driver loop; each fit is a distributed job over that fold's rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from candlewick.functions.columns import col


# --------------------------------------------------------------------------- native fits
def gaussian_nb(scaled: DataFrame, features: Sequence[str], key: Sequence[str],
                y: str = "label", var_smoothing: float = 1e-9) -> DataFrame:
    """M12 ``GaussianNB()`` per (key, fold): predictions for the fold's test rows.

    Per class: prior n_c / n, mean and population variance of each feature on the train
    rows, plus epsilon = var_smoothing * max feature variance of the whole train set.
    Prediction = argmax of log prior - 0.5 * sum(log(2 pi var) + (x - mean)^2 / var);
    ties go to the smaller class.
    """
    g = [*key, "fold"]
    tr = scaled.filter(F.col("role") == "train")
    variances = [F.var_pop(col(c)) for c in features]
    maxvar = F.greatest(*variances) if len(variances) > 1 else variances[0]
    eps = tr.groupBy(*g).agg(maxvar.alias("__maxvar"), F.count(F.lit(1)).alias("__n"))
    cls = tr.groupBy(*g, F.col(y).alias("__class")).agg(
        F.count(F.lit(1)).alias("__nc"),
        *[F.avg(col(c)).alias(f"__m{i}") for i, c in enumerate(features)],
        *[F.var_pop(col(c)).alias(f"__v{i}") for i, c in enumerate(features)])
    cls = cls.join(eps, g).withColumn("__eps", F.lit(var_smoothing) * F.col("__maxvar"))
    ll = F.log(F.col("__nc") / F.col("__n"))
    for i, c in enumerate(features):
        v = F.col(f"__v{i}") + F.col("__eps")
        ll = ll - F.lit(0.5) * (F.log(F.lit(2 * math.pi) * v)
                                + F.pow(col(c) - F.col(f"__m{i}"), 2) / v)
    te = scaled.filter(F.col("role") == "test")
    scored = te.join(cls, g).withColumn("__ll", ll)
    w = Window.partitionBy(*g, "row_idx").orderBy(F.desc("__ll"), F.col("__class"))
    best = scored.withColumn("__r", F.row_number().over(w)).filter("__r = 1")
    return best.select(*[c for c in te.columns], F.col("__class").cast("int").alias("prediction"))


def ridge(scaled: DataFrame, features: Sequence[str], key: Sequence[str], y: str,
          alpha: float = 1.0) -> DataFrame:
    """M4 ``Ridge(alpha)`` with intercept per (key, fold); test-row predictions.

    Centred normal equations (Xc'Xc + alpha I) w = Xc'yc, intercept = mean(y) - mean(X) w,
    built from grouped sums; only the k x k solve runs in Python, once per group.
    """
    g = [*key, "fold"]
    k = len(features)
    tr = scaled.filter(F.col("role") == "train")
    sums = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("sy")]
    sums += [F.sum(col(c)).alias(f"s{i}") for i, c in enumerate(features)]
    sums += [F.sum(col(c) * F.col(y)).alias(f"sxy{i}") for i, c in enumerate(features)]
    sums += [F.sum(col(a) * col(b)).alias(f"sxx{i}_{j}") for i, a in enumerate(features)
             for j, b in enumerate(features) if j >= i]
    gram = tr.groupBy(*g).agg(*sums)
    out_schema = StructType([*[gram.schema[c] for c in g], StructField("intercept", DoubleType())]
                            + [StructField(f"w{i}", DoubleType()) for i in range(k)])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for _, r in pdf.iterrows():                       # one row per (key, fold)
            n = float(r["n"])
            mx = np.array([r[f"s{i}"] for i in range(k)]) / n
            my = r["sy"] / n
            xx = np.empty((k, k))
            for i in range(k):
                for j in range(i, k):
                    xx[i, j] = xx[j, i] = r[f"sxx{i}_{j}"]
            xy = np.array([r[f"sxy{i}"] for i in range(k)])
            a = xx - n * np.outer(mx, mx) + alpha * np.eye(k)
            b = xy - n * mx * my
            wv = np.linalg.solve(a, b)
            rows.append([r[c] for c in g] + [my - mx @ wv] + list(wv))
        return pd.DataFrame(rows, columns=[f.name for f in out_schema.fields])

    coef = gram.groupBy(*g).applyInPandas(solve, out_schema)
    te = scaled.filter(F.col("role") == "test").join(coef, g)
    pred = F.col("intercept")
    for i, c in enumerate(features):
        pred = pred + F.col(f"w{i}") * col(c)
    return te.select(*scaled.columns, pred.alias("prediction"))


# ------------------------------------------------------------------------- Spark ML fits
def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    if "features" in df.columns:
        return df
    return VectorAssembler(inputCols=list(features), outputCol="features",
                           handleInvalid="error").transform(df)


def regressor(name: str, n_train: int | None = None, y_std: float | None = None):
    """Spark ML counterparts of the reference's regressors (defaults mapped).

    ridge:      regParam = alpha / n * sd(y), elasticNet 0, no standardisation
    lasso:      regParam = alpha, elasticNet 1
    elasticnet: l1 = 0.5, l2 = 0.5 * sd(y) -> regParam = l1 + l2, ratio = l1 / (l1 + l2)
    tree:       DecisionTreeRegressor (maxDepth 30 is Spark's ceiling)
    """
    from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
    sd = y_std or 1.0
    if name == "ridge":
        return LinearRegression(regParam=1.0 / max(n_train or 1, 1) * sd, elasticNetParam=0.0,
                                standardization=False, solver="l-bfgs", labelCol="label",
                                tol=1e-10, maxIter=1000)
    if name == "lasso":
        return LinearRegression(regParam=1.0, elasticNetParam=1.0, standardization=False,
                                labelCol="label", tol=1e-10, maxIter=1000)
    if name == "elasticnet":
        l1, l2 = 0.5, 0.5 * sd
        return LinearRegression(regParam=l1 + l2, elasticNetParam=l1 / (l1 + l2),
                                standardization=False, labelCol="label", tol=1e-10, maxIter=1000)
    if name == "tree":
        return DecisionTreeRegressor(maxDepth=30, labelCol="label", seed=42)
    raise ValueError(name)


def classifier(name: str, n_train: int | None = None):
    """Spark ML counterparts of the reference's classifiers (defaults mapped)."""
    from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression, NaiveBayes,
                                           RandomForestClassifier)
    if name == "logistic":
        return LogisticRegression(regParam=1.0 / max(n_train or 1, 1), elasticNetParam=0.0,
                                  standardization=False, labelCol="label", tol=1e-10, maxIter=1000)
    if name == "tree":
        return DecisionTreeClassifier(maxDepth=30, labelCol="label", seed=42)
    if name == "forest":
        return RandomForestClassifier(numTrees=100, maxDepth=30, labelCol="label", seed=42)
    if name == "naive_bayes_ml":
        return NaiveBayes(modelType="gaussian", labelCol="label")
    raise ValueError(name)


def _group_filter(g: Sequence[str], gv: tuple) -> F.Column:
    cond = F.lit(True)
    for c, v in zip(g, gv):
        cond = cond & (F.col(c) == F.lit(v))
    return cond


def _sweep(scaled: DataFrame, features: Sequence[str], key: Sequence[str], names: Sequence[str],
           make: Callable, score: Callable[[DataFrame], DataFrame], fields: Sequence[StructField],
           max_parallel: int) -> tuple[DataFrame, DataFrame]:
    """Fit every (model, key, fold) on the fold's train rows and ``score`` train and test rows
    right away; (scores, importances).

    Each fit is a distributed Spark ML job over one fold's rows; the small, independent
    fits are submitted concurrently from a thread pool. Only score rows (a handful per
    fit) and importances (one per feature) come back to the driver, so no plan of
    unioned predictions is ever built. The fold table is written once into the shared
    folder and every fit reads its rows from there.
    """
    from concurrent.futures import ThreadPoolExecutor

    from candlewick.session import cut_lineage
    g = [*key, "fold"]
    data = cut_lineage(_assembled(scaled, features).select(*g, "role", "features", "label"))
    spark = scaled.sparkSession
    sizes = {tuple(r[c] for c in g): (int(r["n"]), float(r["sd"] or 1.0)) for r in
             data.filter(F.col("role") == "train").groupBy(*g)
                 .agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("label").alias("sd")).collect()}

    def fit_one(job):
        name, gv = job
        part = data.filter(_group_filter(g, gv))
        model = make(name, *sizes[gv]).fit(part.filter(F.col("role") == "train"))
        rows = score(model.transform(part)).select(*[f.name for f in fields]).collect()
        fi = getattr(model, "featureImportances", None)
        imp = [] if fi is None else [(name, *gv, f, float(v)) for f, v in zip(features, fi.toArray())]
        return [(name, *gv, *r) for r in rows], imp

    jobs = [(name, gv) for name in names for gv in sorted(sizes)]
    with ThreadPoolExecutor(max_workers=max_parallel) as pool:
        results = list(pool.map(fit_one, jobs))
    key_fields = [StructField("model", StringType()), *[scaled.schema[c] for c in g]]
    imp_schema = StructType([*key_fields, StructField("feature", StringType()),
                             StructField("importance", DoubleType())])
    scores = spark.createDataFrame([r for out, _ in results for r in out], StructType([*key_fields, *fields]))
    imps = spark.createDataFrame([r for _, imp in results for r in imp], imp_schema)
    return scores, imps


def sweep_counts(scaled: DataFrame, features: Sequence[str], key: Sequence[str],
                 names: Sequence[str], max_parallel: int = 8) -> tuple[DataFrame, DataFrame]:
    """M15 + M24 + M26 for classifiers: (counts, importances). counts has (model, key..., fold,
    role, label, prediction, n), from which accuracy, report and confusion follow; importances
    has (model, key..., fold, feature, importance)."""
    def score(pred: DataFrame) -> DataFrame:
        return pred.groupBy("role", F.col("label").cast("int").alias("label"),
                            F.col("prediction").cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))

    fields = [StructField("role", StringType()), StructField("label", IntegerType()),
              StructField("prediction", IntegerType()), StructField("n", LongType())]
    return _sweep(scaled, features, key, names, lambda name, n, sd: classifier(name, n), score, fields, max_parallel)


def sweep_scores(scaled: DataFrame, features: Sequence[str], key: Sequence[str],
                 names: Sequence[str], task: str = "classification",
                 max_parallel: int = 8) -> tuple[DataFrame, DataFrame]:
    """M15 + M16-M18 + M24 + M26: (scores, importances); scores has (model, key..., fold, role, n,
    metric columns), importances has (model, key..., fold, feature, importance)."""
    if task == "classification":
        counts, imps = sweep_counts(scaled, features, key, names, max_parallel)
        hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
        return counts.groupBy("model", *key, "fold", "role").agg(
            F.sum("n").alias("n"), (hits / F.sum("n")).alias("accuracy")), imps
    y, p = F.col("label"), F.col("prediction")

    def score(pred: DataFrame) -> DataFrame:
        pred = pred.withColumn("__dev", F.pow(y - F.avg(y).over(Window.partitionBy("role")), 2))
        sums = pred.groupBy("role").agg(
            F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(F.pow(y - p, 2))).alias("rmse"),
            F.sum(F.pow(y - p, 2)).alias("__res"), F.sum("__dev").alias("__tot"))
        flat = F.when(F.col("__res") == 0, 1.0).otherwise(0.0)
        return sums.withColumn("r2", F.when(F.col("__tot") == 0, flat)
                               .otherwise(1 - F.try_divide(F.col("__res"), F.col("__tot"))))

    fields = [StructField("role", StringType()), StructField("n", LongType()),
              StructField("rmse", DoubleType()), StructField("r2", DoubleType())]
    return _sweep(scaled, features, key, names, regressor, score, fields, max_parallel)
