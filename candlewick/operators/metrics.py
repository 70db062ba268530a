"""Evaluation metrics per fold (M16-M23, M25), all as grouped aggregations.

Inputs are prediction tables with (key..., fold, label, prediction); every metric is a
``groupBy(key..., fold)`` with partial aggregation, so any number of folds, sectors and
models is scored in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def rmse(pred: DataFrame, group: Sequence[str], y: str = "label",
         p: str = "prediction") -> DataFrame:
    """M16 ``sqrt(mean_squared_error)``."""
    return pred.groupBy(*group).agg(
        F.sqrt(F.avg(F.pow(F.col(y) - F.col(p), 2))).alias("rmse"))


def r2(pred: DataFrame, group: Sequence[str], y: str = "label",
       p: str = "prediction") -> DataFrame:
    """M17 ``r2_score``: 1 - SS_res / SS_tot with the test-set mean (NaN-free: a constant
    test target with perfect predictions gives 1.0, otherwise 0.0, as scikit-learn)."""
    w = Window.partitionBy(*group)
    dev = F.pow(F.col(y) - F.avg(y).over(w), 2)
    t = pred.withColumns({"__res": F.pow(F.col(y) - F.col(p), 2), "__dev": dev})
    agg = t.groupBy(*group).agg(F.sum("__res").alias("ss_res"), F.sum("__dev").alias("ss_tot"))
    return agg.select(*group, F.when(F.col("ss_tot") == 0,
                                     F.when(F.col("ss_res") == 0, 1.0).otherwise(0.0))
                      .otherwise(1 - F.col("ss_res") / F.col("ss_tot")).alias("r2"))


def accuracy(pred: DataFrame, group: Sequence[str], y: str = "label",
             p: str = "prediction") -> DataFrame:
    """M18 ``accuracy_score``."""
    return pred.groupBy(*group).agg(
        F.avg((F.col(y) == F.col(p)).cast("double")).alias("accuracy"))


def _rows(condition: Column, n: str | None) -> Column:
    """Rows that meet a condition; ``n`` names a column of counts if a row stands for several."""
    return F.count_if(condition) if n is None else F.sum(F.when(condition, F.col(n)).otherwise(0))


def confusion(pred: DataFrame, group: Sequence[str], classes: Sequence[int] = (0, 1),
              y: str = "label", p: str = "prediction", n: str | None = None) -> DataFrame:
    """M20 ``confusion_matrix``: one row per (group..., class of ``classes``), a count column per
    predicted class (``pred_<c>``); a class without rows has zeros."""
    cells = [F.struct(F.lit(t).alias("true_class"), *[
        _rows((F.col(y) == t) & (F.col(p) == c), n).alias(f"pred_{c}") for c in classes]) for t in classes]
    agg = pred.groupBy(*group).agg(F.array(*cells).alias("__c"))
    return agg.select(*group, F.explode("__c").alias("c")).select(*group, "c.*")


def classification_report(pred: DataFrame, group: Sequence[str],
                          classes: Sequence[int] = (0, 1), y: str = "label",
                          p: str = "prediction", n: str | None = None) -> DataFrame:
    """M19 ``classification_report``: per class precision, recall, F1, support, plus
    'macro avg' and 'weighted avg' rows; a 0/0 ratio is 0 (zero_division default)."""
    per = []
    for c in classes:
        tp = _rows((F.col(y) == c) & (F.col(p) == c), n)
        pp = _rows(F.col(p) == c, n)
        sup = _rows(F.col(y) == c, n)
        per.append(F.struct(F.lit(str(c)).alias("class"), tp.alias("tp"), pp.alias("pp"),
                            sup.alias("support")))
    agg = pred.groupBy(*group).agg(F.array(*per).alias("__c"))
    rows = agg.select(*group, F.explode("__c").alias("c")).select(*group, "c.*")
    prec = F.when(F.col("pp") == 0, 0.0).otherwise(F.col("tp") / F.col("pp"))
    rec = F.when(F.col("support") == 0, 0.0).otherwise(F.col("tp") / F.col("support"))
    rows = rows.withColumns({"precision": prec, "recall": rec})
    rows = rows.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, 0.0)
                           .otherwise(2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))))
    rows = rows.select(*group, "class", "precision", "recall", "f1",
                       F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    avgs = rows.groupBy(*group).agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        (F.sum(F.col("precision") * F.col("support")) / tot).alias("w_p"),
        (F.sum(F.col("recall") * F.col("support")) / tot).alias("w_r"),
        (F.sum(F.col("f1") * F.col("support")) / tot).alias("w_f"), tot.alias("n"))
    macro = avgs.select(*group, F.lit("macro avg").alias("class"), F.col("m_p").alias("precision"),
                        F.col("m_r").alias("recall"), F.col("m_f").alias("f1"),
                        F.col("n").cast("long").alias("support"))
    weighted = avgs.select(*group, F.lit("weighted avg").alias("class"),
                           F.col("w_p").alias("precision"), F.col("w_r").alias("recall"),
                           F.col("w_f").alias("f1"), F.col("n").cast("long").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)


def mean_baseline(folds: DataFrame, key: Sequence[str], y: str) -> DataFrame:
    """Predict the fold's train mean for every test row; RMSE per (key, fold)."""
    mu = (folds.filter(F.col("role") == "train").groupBy(*key, "fold")
               .agg(F.avg(y).alias("train_mean")))
    test = folds.filter(F.col("role") == "test").join(mu, [*key, "fold"])
    return test.groupBy(*key, "fold").agg(
        F.sqrt(F.avg(F.pow(F.col(y) - F.col("train_mean"), 2))).alias("baseline_rmse"))


def majority_baseline(folds: DataFrame, key: Sequence[str], y: str = "label") -> DataFrame:
    """The fold's train mode (smallest class on ties) as the prediction for every
    test row; accuracy per (key, fold)."""
    vc = (folds.filter(F.col("role") == "train").groupBy(*key, "fold", y)
               .agg(F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy(*key, "fold").orderBy(F.desc("__n"), F.col(y))
    mode = (vc.withColumn("__r", F.row_number().over(w)).filter("__r = 1")
              .select(*key, "fold", F.col(y).alias("majority_class")))
    test = folds.filter(F.col("role") == "test").join(mode, [*key, "fold"])
    return test.groupBy(*key, "fold", "majority_class").agg(
        F.avg((F.col(y) == F.col("majority_class")).cast("double")).alias("baseline_accuracy"))


def beats_baseline(scores: DataFrame, score: str, baseline: str) -> DataFrame:
    """Strict ``score > baseline`` flag."""
    return scores.withColumn("beats_baseline", F.col(score) > F.col(baseline))


def fold_ranges(folds: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Rows and first / last position and date per (key, fold, role)."""
    return folds.groupBy(*key, "fold", "role").agg(
        F.count(F.lit(1)).alias("rows"), F.min("row_idx").alias("first_row"),
        F.max("row_idx").alias("last_row"), F.min(order).alias("first_date"),
        F.max(order).alias("last_date"))
