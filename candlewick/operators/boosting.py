"""Boosted models per (key, fold): M8 / M14 regularised boosted trees and M13 AdaBoost stumps.

All (key, fold) groups are fitted side by side with ``applyInPandas``; a group is one
calendar-bounded series (some thousand rows), so 300 rounds are array work of a second and no
round costs a Spark job. Features are binned once by train quantiles; a tree's split search is
one histogram of gradients per node.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

BINS = 64
# The tuned and the default settings of boosted trees.
TUNED = {"depth": 2, "rounds": 300, "rate": 0.01, "rows": 0.6, "columns": 0.6,
         "l1": 2.0, "l2": 10.0, "least_weight": 20.0}
DEFAULT = {"depth": 6, "rounds": 100, "rate": 0.3, "rows": 1.0, "columns": 1.0,
           "l1": 0.0, "l2": 1.0, "least_weight": 1.0}


def binned(train: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bin numbers by quantiles of the train rows (values between cuts share a bin)."""
    out = np.empty(x.shape, np.int64)
    for k in range(x.shape[1]):
        cuts = np.unique(np.quantile(train[:, k], np.linspace(0, 1, BINS + 1)[1:-1]))
        out[:, k] = np.searchsorted(cuts, x[:, k], side="left")
    return out


def histogram(bins: np.ndarray, columns: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Sums of each value per (column, bin)."""
    at = bins[:, columns] + np.arange(len(columns)) * BINS
    return [np.bincount(at.ravel(), np.repeat(v, len(columns)), len(columns) * BINS)
            .reshape(len(columns), BINS) for v in values]


def _soft(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


class Tree:
    """One regression tree on gradients: node -> (column, bin) for splits, or a leaf value."""

    def __init__(self, bins, g, h, rows, columns, p, gains, times):
        self.nodes: dict[int, tuple | float] = {}
        todo = [(1, rows, 0)]
        while todo:
            node, at, depth = todo.pop()
            total_g, total_h = g[at].sum(), h[at].sum()
            score = lambda a, b: _soft(a, p["l1"]) ** 2 / (b + p["l2"])
            best = None
            if depth < p["depth"]:
                left_g, left_h = (np.cumsum(x, axis=1) for x in histogram(bins[at], columns, g[at], h[at]))
                gain = score(left_g, left_h) + score(total_g - left_g, total_h - left_h) - score(total_g, total_h)
                fits = (left_h >= p["least_weight"]) & (total_h - left_h >= p["least_weight"])
                gain = np.where(fits, gain, 0.0)
                best = np.unravel_index(gain.argmax(), gain.shape)
            if best is None or gain[best] <= 1e-12:
                self.nodes[node] = float(-_soft(total_g, p["l1"]) / (total_h + p["l2"]) * p["rate"])
                continue
            column = columns[best[0]]
            gains[column] += gain[best]
            times[column] += 1
            self.nodes[node] = (column, best[1])
            low = bins[at, column] <= best[1]
            todo += [(2 * node, at[low], depth + 1), (2 * node + 1, at[~low], depth + 1)]

    def predict(self, bins: np.ndarray) -> np.ndarray:
        out, todo = np.zeros(len(bins)), [(1, np.arange(len(bins)))]
        while todo:
            node, at = todo.pop()
            if isinstance(self.nodes[node], float):
                out[at] = self.nodes[node]
            else:
                column, cut = self.nodes[node]
                low = bins[at, column] <= cut
                todo += [(2 * node, at[low]), (2 * node + 1, at[~low])]
        return out


def boosted_trees(x: np.ndarray, y: np.ndarray, train: np.ndarray, task: str,
                  p: dict = TUNED) -> tuple[np.ndarray, np.ndarray]:
    """Predictions for all rows (labels or values) and importances (mean gain, normalised)."""
    bins = binned(x[train], x)
    rng = np.random.default_rng(42)
    rate = np.clip(y[train].mean(), 1e-6, 1 - 1e-6)
    margin = np.full(len(y), np.log(rate / (1 - rate)) if task == "classification" else y[train].mean())
    at = np.flatnonzero(train)
    gains, times = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for _ in range(p["rounds"]):
        if task == "classification":
            chance = 1 / (1 + np.exp(-margin))
            g, h = chance - y, chance * (1 - chance)
        else:
            g, h = margin - y, np.ones(len(y))
        rows = at[rng.random(len(at)) < p["rows"]]
        columns = np.sort(rng.choice(x.shape[1], max(1, int(p["columns"] * x.shape[1])), replace=False))
        margin = margin + Tree(bins, g, h, rows, columns, p, gains, times).predict(bins)
    mean = gains / np.maximum(times, 1)
    prediction = (margin > 0).astype(float) if task == "classification" else margin
    return prediction, mean / mean.sum() if mean.sum() else mean


def adaboost(x: np.ndarray, y: np.ndarray, train: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """SAMME over depth-1 trees (weighted Gini); votes of all rounds. A first stump that is no
    better than chance votes alone, as nothing can be boosted then."""
    bins = binned(x[train], x)
    b, label = bins[train], y[train]
    w, votes = np.full(len(label), 1 / len(label)), np.zeros(len(y))
    columns, gains = np.arange(x.shape[1]), np.zeros(x.shape[1])
    for k in range(rounds):
        one, all_ = (np.cumsum(v, axis=1) for v in histogram(b, columns, w * label, w))
        rest_one, rest = one[:, -1:] - one, all_[:, -1:] - all_
        impurity = sum(2 * o * (a - o) / np.maximum(a, 1e-12) for o, a in ((one, all_), (rest_one, rest)))
        c, cut = np.unravel_index(impurity.argmin(), impurity.shape)
        sides = [float(2 * o[c, cut] > a[c, cut]) for o, a in ((one, all_), (rest_one, rest))]
        stump = np.where(bins[:, c] <= cut, *sides)
        wrong = stump[train] != label
        error = float(w[wrong].sum())
        gains[c] += 1
        alpha = 1.0 if error <= 0 or error >= 0.5 else np.log((1 - error) / error)
        if error >= 0.5 and k:
            break
        votes += alpha * (2 * stump - 1)
        if error <= 0 or error >= 0.5:
            break
        w = w * np.where(wrong, np.exp(alpha), 1.0)
        w /= w.sum()
    return (votes > 0).astype(float), gains / gains.sum()


FITS: dict[str, tuple[str, Callable]] = {
    "boosted": ("classification", lambda x, y, t: boosted_trees(x, y, t, "classification")),
    "boosted_regression": ("regression", lambda x, y, t: boosted_trees(x, y, t, "regression")),
    "boosted_default": ("classification", lambda x, y, t: boosted_trees(x, y, t, "classification", DEFAULT)),
    "boosted_regression_default": ("regression", lambda x, y, t: boosted_trees(x, y, t, "regression", DEFAULT)),
    "adaboost": ("classification", adaboost),
}


def fit_groups(scaled: DataFrame, features: Sequence[str], key: Sequence[str], name: str,
               y: str = "label") -> tuple[DataFrame, DataFrame]:
    """(predictions, importances): key, fold, role, row_idx, label, prediction for every row;
    key, fold, feature, importance. A group without train rows of both classes predicts the
    class it has."""
    g = [*key, "fold"]
    fit = FITS[name][1]
    slim = scaled.select(*g, "role", "row_idx", F.col(y).cast("double").alias("label"),
                         *[F.col(f"`{c}`").cast("double").alias(f"x{k}") for k, c in enumerate(features)])
    fields = [slim.schema[c] for c in g]
    xs = [f"x{k}" for k in range(len(features))]

    def run(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        pdf = pdf.sort_values(["role", "row_idx"], kind="stable")
        train = (pdf["role"] == "train").to_numpy()
        y_, x = pdf["label"].to_numpy(), pdf[xs].to_numpy()
        if not train.any():
            return pdf.iloc[:0].assign(prediction=0.0), np.zeros(len(features))
        prediction, importance = fit(x, y_, train)
        return pdf.assign(prediction=prediction), importance

    def predict(pdf: pd.DataFrame) -> pd.DataFrame:
        return run(pdf)[0][[*g, "role", "row_idx", "label", "prediction"]]

    def weigh(pdf: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"feature": list(features), "importance": run(pdf)[1]})
        for c in reversed(g):
            out.insert(0, c, pdf[c].iloc[0])
        return out

    kinds = [slim.schema["role"], slim.schema["row_idx"], StructField("label", DoubleType()),
             StructField("prediction", DoubleType())]
    groups = slim.groupBy(*g)
    return (groups.applyInPandas(predict, StructType([*fields, *kinds])),
            groups.applyInPandas(weigh, StructType([*fields, StructField("feature", StringType()),
                                                    StructField("importance", DoubleType())])))
