"""

Every query reads the driver's parquet tables (through the stand-in builders in
``candlewick.sources.standins``) and runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from candlewick import sql_oracles as O
from candlewick.operators.joins import lookup_first, missing_keys
from candlewick.functions.nulls import binary_label
from candlewick.session import cut_lineage, scratch_path
from candlewick.sources import files
from candlewick.operators import boosting, folds, linear, metrics, models, stats
from candlewick.plans import macro, monthly, sector, ticker, training
from candlewick.plans.presentation import rounded
from candlewick.sources import standins as S

try:                        # the document operators and their pipeline may be absent
    from candlewick.llm import queries as llm
except ImportError:
    llm = None
try:
    import corpus_pipeline
except ImportError:
    corpus_pipeline = None

SMOKE_DIR = "/root/testdata/sf0.001"
# compounded (index-level) columns are compared at 7 significant digits
INDEX_COLUMNS = ("sector_index", "sector_index_MA_5", "sector_MACD", "sector_MACD_hist",
                 "sector_MACD_signal")


def q_ticker_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-symbol returns, lags, MAs, volatility, RSI, MACD, volume MA; gate > 400."""
    return rounded(ticker.ticker_features(S.bars(spark, sf_dir)))


def _sector_inputs(spark: SparkSession, sf_dir: str):
    members = S.sector_members(spark, sf_dir)
    shares = S.shares(spark, sf_dir)
    return S.bars(spark, sf_dir), members, shares


def _sector_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sector.sector_daily(*_sector_inputs(spark, sf_dir))


def q_sector_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily-cap-weighted sector return, coverage, base-100 index, volume."""
    return rounded(_sector_daily(spark, sf_dir), significant=INDEX_COLUMNS)


def q_sector_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed cap weights (today's market cap) -> sector return and index."""
    bars, members, _ = _sector_inputs(spark, sf_dir)
    caps = S.stock_info(spark, sf_dir, bars)
    return rounded(sector.sector_static_weighted(bars, members, caps),
                   significant=INDEX_COLUMNS)


def q_sector_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8 with default parameters over every sector."""
    return rounded(sector.sector_features(_sector_daily(spark, sf_dir)),
                   significant=INDEX_COLUMNS)


# Lag request of the reference's macro lag test, on the stand-in macro series.
MACRO_LAG_REQUEST = {"foreign_reserve_liquid(USD)_daily": [1, 5, 10],
                     "order_value_monthly": [1, 2],
                     "order_value_quarterly": [1]}


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return macro.align_macro(*S.aligned_macro_inputs(spark, sf_dir))


def q_macro_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly -> next month, quarter-end -> next quarter, daily reserves, dropna."""
    return rounded(_aligned(spark, sf_dir))


def q_macro_lags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily / monthly / quarterly lags dispatched on the column suffix."""
    return rounded(macro.lag_features(_aligned(spark, sf_dir), MACRO_LAG_REQUEST))


TRAIN_FEATURES = O.TRAIN_FEATURES
COLLINEAR = O.COLLINEAR
SCREEN_THRESHOLD = 0.85


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C10; every query on top of it reads it once, so nothing is written in between."""
    return training.training_frame(_sector_daily(spark, sf_dir), _aligned(spark, sf_dir))


def q_training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sector joined to the aligned macro table, leaky columns lagged."""
    tf = _training(spark, sf_dir)
    return rounded(tf.select("date", "sector", "sector_index", *TRAIN_FEATURES),
                   significant=INDEX_COLUMNS)


def q_daily_training_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C11: every sector with the daily reserve series only, both lagged one day."""
    out = training.daily_training_frame(_sector_daily(spark, sf_dir),
                                        S.daily_reserve(spark, sf_dir))
    return rounded(out, significant=INDEX_COLUMNS)


def q_corr_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pearson matrix per sector (long form)."""
    return rounded(stats.corr_long(_training(spark, sf_dir), TRAIN_FEATURES, ["sector"]))


def q_corr_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of each feature with the sector return, per sector."""
    return rounded(stats.corr_with_target(_training(spark, sf_dir), TRAIN_FEATURES,
                                          "weighted_sector_returns", ["sector"]))


def q_corr_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with |r| > 0.85 in the lower triangle, per sector."""
    return rounded(stats.corr_screen(_training(spark, sf_dir), TRAIN_FEATURES,
                                     SCREEN_THRESHOLD, ["sector"]))


def q_stationary_screen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pct_change of the collinear level series, then the screen again."""
    st = training.stationary_transform(_training(spark, sf_dir), COLLINEAR)
    return rounded(stats.corr_screen(st, TRAIN_FEATURES, SCREEN_THRESHOLD, ["sector"]))


def q_corr_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that the screen flags, per sector."""
    pairs = stats.corr_screen(_training(spark, sf_dir), TRAIN_FEATURES, SCREEN_THRESHOLD, ["sector"])
    return stats.flagged_columns(pairs, ["sector"])


def q_stationary_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 on every feature (all but the target changed), then the screen."""
    st = training.stationary_transform(_training(spark, sf_dir), MODEL_FEATURES)
    return rounded(stats.corr_screen(st, TRAIN_FEATURES, SCREEN_THRESHOLD, ["sector"]))


def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count, mean, std, min, quartiles (exact), max per sector and feature."""
    return rounded(stats.describe(_training(spark, sf_dir), TRAIN_FEATURES, ["sector"]))


FACTS = ["l_quantity", "l_extendedprice", "l_discount"]


def q_describe_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 on a fact table: exact quartiles of raw lineitem columns by return flag."""
    return rounded(stats.describe(S.table(spark, sf_dir, "lineitem"), FACTS, ["l_returnflag"]))


def q_label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P17 + A8: up/down label (return > 0) counts per sector."""
    tf = _training(spark, sf_dir).withColumn("label", binary_label("weighted_sector_returns"))
    return stats.value_counts(tf, "label", ["sector"])


MODEL_FEATURES = O.MODEL_FEATURES
KEY = ["sector"]


def _model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C12 output with the P17 up/down label: the frame every model query uses."""
    st = training.stationary_transform(_training(spark, sf_dir), COLLINEAR)
    return st.withColumn("label", binary_label("weighted_sector_returns"))


def _fold_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.time_series_folds(_model_frame(spark, sf_dir), KEY, "date", n_splits=5)


def _folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 long fold table as a shared table: scalers, baselines and models read it twice or
    more."""
    return cut_lineage(_fold_rows(spark, sf_dir))


def _scaled_from(f: DataFrame) -> DataFrame:
    return folds.apply_scaler(f, folds.fit_scaler(f, MODEL_FEATURES, KEY), MODEL_FEATURES, KEY)


def _scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scaled_from(_folds(spark, sf_dir))


def q_fold_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1 + M25: five expanding time-ordered folds per sector; sizes and ranges. Sectors that are
    too short for folds have one row that says so."""
    frame = _model_frame(spark, sf_dir)
    found = metrics.fold_ranges(folds.time_series_folds(frame, KEY, "date", n_splits=5), KEY, "date")
    return found.unionByName(folds.short_keys(frame, KEY, "date", n_splits=5))


def q_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: ordered 80/20 holdout per sector."""
    h = folds.ordered_holdout(_model_frame(spark, sf_dir), KEY, "date", 0.2)
    return h.groupBy("sector", "role").agg(F.count(F.lit(1)).alias("rows"),
                                           F.min("row_idx").alias("first_row"),
                                           F.max("row_idx").alias("last_row"))


def q_baseline_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train-mean baseline RMSE per (sector, fold)."""
    return rounded(metrics.mean_baseline(_folds(spark, sf_dir), KEY, "weighted_sector_returns"))


def q_baseline_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train-majority baseline accuracy per (sector, fold)."""
    return rounded(metrics.majority_baseline(_folds(spark, sf_dir), KEY, "label"))


def _nb_predictions(spark: SparkSession, sf_dir: str, f: DataFrame | None = None) -> DataFrame:
    f = f if f is not None else _folds(spark, sf_dir)
    return models.gaussian_nb(_scaled_from(f), MODEL_FEATURES, KEY)


def _nb_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _folds(spark, sf_dir)
    acc = metrics.accuracy(_nb_predictions(spark, sf_dir, f), [*KEY, "fold"])
    base = metrics.majority_baseline(f, KEY, "label")
    return metrics.beats_baseline(acc.join(base, [*KEY, "fold"]), "accuracy",
                                  "baseline_accuracy")


def q_nb_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M12 + M18 + M22 + M23: scaled Gaussian NB accuracy vs. majority baseline."""
    s = _nb_vs_baseline(spark, sf_dir)
    return rounded(s.select(*KEY, "fold", "accuracy", "baseline_accuracy", "beats_baseline"))


def q_nb_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean accuracy, mean baseline, mean edge and folds won, per sector."""
    s = _nb_vs_baseline(spark, sf_dir)
    return rounded(s.groupBy(*KEY).agg(
        F.avg("accuracy").alias("mean_accuracy"),
        F.avg("baseline_accuracy").alias("mean_baseline_accuracy"),
        (F.avg("accuracy") - F.avg("baseline_accuracy")).alias("mean_edge"),
        F.count_if(F.col("beats_baseline")).alias("folds_beating_baseline"),
        F.count(F.lit(1)).alias("folds")))


def q_nb_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classification report of the NB predictions per (sector, fold)."""
    return rounded(metrics.classification_report(_nb_predictions(spark, sf_dir),
                                                 [*KEY, "fold"]))


def q_nb_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confusion matrix of the NB predictions per (sector, fold)."""
    return metrics.confusion(_nb_predictions(spark, sf_dir), [*KEY, "fold"])


def q_ridge_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 + M16 + M17 + M21: ridge (alpha 1) RMSE and R2 per fold against the baseline."""
    f = _folds(spark, sf_dir)
    sc = _scaled_from(f).withColumnRenamed("label", "up")
    pred = models.ridge(sc, MODEL_FEATURES, KEY, "weighted_sector_returns", alpha=1.0)
    g = [*KEY, "fold"]
    r = metrics.rmse(pred, g, y="weighted_sector_returns").join(
        metrics.r2(pred, g, y="weighted_sector_returns"), g).join(
        metrics.mean_baseline(f, KEY, "weighted_sector_returns"), g)
    return rounded(r)


def _penalised(spark: SparkSession, sf_dir: str, l1_ratio: float) -> DataFrame:
    sc = _scaled(spark, sf_dir).withColumnRenamed("label", "up")
    target = "weighted_sector_returns"
    coef = linear.elastic_net(sc, MODEL_FEATURES, KEY, target, 1.0, l1_ratio)
    size = F.aggregate("w", F.lit(0.0), lambda s, v: s + F.abs(v))
    pred = linear.predict(sc, coef, MODEL_FEATURES, KEY)
    g = [*KEY, "fold", "role"]
    n = pred.groupBy(*g).agg(F.count(F.lit(1)).alias("n"))
    out = n.join(metrics.rmse(pred, g, y=target), g).join(metrics.r2(pred, g, y=target), g)
    return rounded(out.join(coef.select(*KEY, "fold", size.alias("coef_l1")), [*KEY, "fold"]))


def q_lasso_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M15-M17: lasso (alpha 1) of every sector and fold; RMSE and R2 of train and test rows."""
    return _penalised(spark, sf_dir, 1.0)


def q_elasticnet_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M15-M17: elastic net (alpha 1, l1_ratio 0.5) of every sector and fold."""
    return _penalised(spark, sf_dir, 0.5)


def _logistic_predictions(f: DataFrame) -> DataFrame:
    sc = cut_lineage(_scaled_from(f))                    # read again by every Newton step
    z = linear.predict(sc, linear.logistic(sc, MODEL_FEATURES, KEY), MODEL_FEATURES, KEY)
    return z.withColumn("prediction", (F.col("prediction") > 0).cast("int"))


def q_logistic_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M15 + M18 + M22 + M23: logistic regression of every sector and fold."""
    f = _folds(spark, sf_dir)
    return _against_majority(_logistic_predictions(f), f)


def q_logistic_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M19: classification report of logistic regression on the test rows."""
    pred = _logistic_predictions(_folds(spark, sf_dir)).where("role = 'test'")
    return rounded(metrics.classification_report(pred, [*KEY, "fold"]))


def q_logistic_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M20: confusion matrix of logistic regression on the test rows."""
    pred = _logistic_predictions(_folds(spark, sf_dir)).where("role = 'test'")
    return metrics.confusion(pred, [*KEY, "fold"])


def q_monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lagged monthly macro + each sector's last trading row of the month."""
    out = monthly.monthly_rollup(_sector_daily(spark, sf_dir), S.macro(spark, sf_dir))
    return rounded(out, significant=INDEX_COLUMNS + ("new_monthly_returns",))


# Spark ML estimators registered as sweeps (each fit: a few distributed jobs).
CLASSIFIERS = ("tree", "forest", "naive_bayes_ml")
REGRESSORS = ("ridge", "tree")


def _sweep(spark: SparkSession, sf_dir: str, names, task: str):
    sc = _scaled(spark, sf_dir)
    if task == "regression":
        sc = sc.withColumn("label", F.col("weighted_sector_returns"))
    else:
        sc = sc.withColumn("label", F.col("label").cast("double"))
    return models.sweep_scores(sc, MODEL_FEATURES, KEY, names, task)


def q_classifier_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifiers x sectors x folds; train and test accuracy."""
    scores, _ = _sweep(spark, sf_dir, CLASSIFIERS, "classification")
    return rounded(scores)


def q_regressor_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regressors x sectors x folds; train and test RMSE and R2."""
    scores, _ = _sweep(spark, sf_dir, REGRESSORS, "regression")
    return rounded(scores)


def _importance_table(imp: DataFrame) -> DataFrame:
    # T5: one column per fold (the fold list is fixed, so the pivot needs no extra pass)
    wide = (imp.groupBy(*KEY, "feature").pivot("fold", list(range(5)))
               .agg(F.first("importance")))
    wide = wide.withColumnsRenamed({str(k): f"fold_{k}" for k in range(5)})
    st = imp.groupBy(*KEY, "feature").agg(F.avg("importance").alias("mean_importance"),
                                          F.stddev_samp("importance").alias("std_importance"))
    return rounded(wide.join(st, [*KEY, "feature"])
                   .orderBy(*KEY, F.desc("mean_importance"), "feature"))


def q_feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 + M24 + A15 + T2 + T5: random-forest importances per fold (wide, one column per
    fold) with their mean and std per feature, most important first."""
    return _importance_table(_sweep(spark, sf_dir, ("forest",), "classification")[1])


def _against_majority(pred: DataFrame, f: DataFrame) -> DataFrame:
    """Train and test accuracy per (sector, fold) against the majority baseline."""
    hit = (F.col("label") == F.col("prediction")).cast("double")
    acc = pred.groupBy(*KEY, "fold").agg(
        F.avg(F.when(F.col("role") == "train", hit)).alias("train_accuracy"),
        F.avg(F.when(F.col("role") == "test", hit)).alias("test_accuracy"))
    out = acc.join(metrics.majority_baseline(f, KEY, "label"), [*KEY, "fold"])
    return rounded(metrics.beats_baseline(out, "test_accuracy", "baseline_accuracy")
                   .select(*KEY, "fold", "train_accuracy", "test_accuracy", "baseline_accuracy", "beats_baseline"))


def _classifier_scores(f: DataFrame, name: str) -> DataFrame:
    return _against_majority(boosting.fit_groups(_scaled_from(f), MODEL_FEATURES, KEY, name)[0], f)


# Boosted trees are fitted with both settings; the suffix of the fit's name for each.
SETTINGS = {"tuned": "", "default": "_default"}


def q_boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M14 + M15 + M18 + M22 + M23: tuned and default boosted-tree classifiers on every sector
    and fold."""
    f = _folds(spark, sf_dir)
    tuned, default = (_classifier_scores(f, f"boosted{x}").withColumn("settings", F.lit(s))
                      for s, x in SETTINGS.items())
    return tuned.unionByName(default)


def q_boosted_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M24 + A15: boosted-tree importances (mean gain) per fold, with mean and std."""
    return _importance_table(boosting.fit_groups(_scaled(spark, sf_dir), MODEL_FEATURES, KEY, "boosted")[1])


def q_boosted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M19 of the boosted-tree classifier per (sector, fold)."""
    pred, _ = boosting.fit_groups(_scaled(spark, sf_dir), MODEL_FEATURES, KEY, "boosted")
    return rounded(metrics.classification_report(pred.where("role = 'test'"), [*KEY, "fold"]))


def q_boosted_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M20 of the boosted-tree classifier per (sector, fold)."""
    pred, _ = boosting.fit_groups(_scaled(spark, sf_dir), MODEL_FEATURES, KEY, "boosted")
    return metrics.confusion(pred.where("role = 'test'"), [*KEY, "fold"])


def q_adaboost_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 + M15 + M18 + M22 + M23: 50 AdaBoost stumps on every sector and fold."""
    return _classifier_scores(_folds(spark, sf_dir), "adaboost")


def q_boosted_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8 + M15-M17: tuned and default boosted-tree regressors, RMSE and R2 of train and test
    rows."""
    sc = _scaled(spark, sf_dir)
    g = [*KEY, "fold", "role"]

    def scores(settings: str) -> DataFrame:
        pred, _ = boosting.fit_groups(sc, MODEL_FEATURES, KEY, f"boosted_regression{SETTINGS[settings]}",
                                      y="weighted_sector_returns")
        out = metrics.rmse(pred, g, y="label").join(metrics.r2(pred, g, y="label"), g)
        return rounded(out).withColumn("settings", F.lit(settings))

    return scores("tuned").unionByName(scores("default"))


def _classifier_counts(spark: SparkSession, f: DataFrame) -> DataFrame:
    """All six classifiers fitted on the train rows of ``f``: rows by model, settings, key, fold,
    role, label and prediction. ``settings`` tells the two boosted-tree models apart."""
    sc = _scaled_from(f)
    counts, _ = models.sweep_counts(sc.withColumn("label", F.col("label").cast("double")), MODEL_FEATURES,
                                    KEY, CLASSIFIERS)
    counts = counts.withColumn("settings", F.lit("default"))
    fits = [("logistic", "default", _logistic_predictions(f))]
    fits += [(name, settings, boosting.fit_groups(sc, MODEL_FEATURES, KEY, fit)[0]) for name, settings, fit in (
        ("adaboost", "default", "adaboost"), *[("boosted", s, f"boosted{x}") for s, x in SETTINGS.items()])]
    for name, settings, pred in fits:
        row = [F.lit(name).alias("model"), F.lit(settings).alias("settings"), *KEY, "fold", "role",
               F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")]
        counts = counts.unionByName(pred.select(*row).groupBy(
            "model", "settings", *KEY, "fold", "role", "label", "prediction").agg(F.count(F.lit(1)).alias("n")))
    return counts


def _report_and_confusion(counts: DataFrame) -> DataFrame:
    """Report rows of the test rows, with the row of the confusion matrix beside each class."""
    g = ["model", "settings", *KEY, "fold"]
    test = cut_lineage(counts.where("role = 'test'"))      # the fits feed the report and the matrix
    matrix = metrics.confusion(test, g, n="n").withColumn("class", F.col("true_class").cast("string"))
    return rounded(metrics.classification_report(test, g, n="n")
                   .join(matrix.drop("true_class"), [*g, "class"], "left"))


def _holdout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = folds.ordered_holdout(_model_frame(spark, sf_dir), KEY, "date", 0.2)
    return cut_lineage(h.withColumn("fold", F.lit(0)))


def q_holdout_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M26: all six classifiers fitted on the first 80 % of every sector; accuracy of the
    train and of the held-out rows."""
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    counts = _classifier_counts(spark, _holdout_rows(spark, sf_dir))
    return rounded(counts.groupBy("model", "settings", *KEY, "role").agg(
        F.sum("n").alias("n"), (hits / F.sum("n")).alias("accuracy")))


def q_holdout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M19 + M20 + M26: report and confusion of all six classifiers on the held-out rows."""
    return _report_and_confusion(_classifier_counts(spark, _holdout_rows(spark, sf_dir))).drop("fold")


def q_classifier_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9-M14 + M19 + M20 + M26: report and confusion of all six classifiers on the test rows of
    every sector and fold."""
    return _report_and_confusion(_classifier_counts(spark, _folds(spark, sf_dir)))


def q_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16 + S6: parse the JSON ``props`` payload of every event; unparsable rows are
    counted as rejects, per event type."""
    from pyspark.sql.types import LongType, StructField, StructType
    ev = S.table(spark, sf_dir, "events").select("event_type", "props")
    p = ev.withColumn("k", F.from_json("props", StructType([StructField("k", LongType())]))["k"])
    return p.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"),
                                       F.count("k").alias("parsed"),
                                       (F.count(F.lit(1)) - F.count("k")).alias("rejected"),
                                       F.sum("k").alias("k_sum"))


def q_event_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on the short event series: history length per user and the > 400 gate."""
    s = S.event_series(spark, sf_dir)
    return s.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_bars")).withColumn(
        "passes_gate", F.col("n_bars") > 400)


def q_bar_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15 + P16 + P19: non-null, missing (null or NaN) and infinite counts per column,
    all from one aggregation pass over the bars."""
    b = S.bars(spark, sf_dir).select("open_price", "close_price", "volume")
    aggs = []
    for i, c in enumerate(b.columns):
        x = F.col(c)
        aggs += [F.count(x).alias(f"nn{i}"),
                 F.count_if(x.isNull() | F.isnan(x)).alias(f"mi{i}"),
                 F.count_if(F.abs(x) == float("inf")).alias(f"in{i}")]
    one = b.agg(*aggs)
    rows = ", ".join(f"'{c}', nn{i}, mi{i}, in{i}" for i, c in enumerate(b.columns))
    return one.selectExpr(f"stack({len(b.columns)}, {rows}) as (column, non_null, missing, infinite)")


def q_month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + J5: month-end calendar over the order dates with each month's order count."""
    o = S.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    spine = files.month_end_spine_between(o.agg(F.min("d").alias("lo"), F.max("d").alias("hi")))
    cnt = o.groupBy(F.last_day("d").alias("date")).agg(F.count(F.lit(1)).alias("orders"))
    return (spine.join(cnt, "date", "left")
                 .select("date", "date_text", F.coalesce("orders", F.lit(0)).alias("orders")))


def q_symbol_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free batches of 10 symbols (the reference's slices skip positions)."""
    b = files.symbol_batches(S.bars(spark, sf_dir).select("symbol"), 10)
    return b.groupBy("batch").agg(F.count(F.lit(1)).alias("symbols"),
                                  F.min("symbol").alias("first_symbol"),
                                  F.max("symbol").alias("last_symbol"))


def q_series_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """head(3) and tail(3) of every symbol's bars."""
    b = S.bars(spark, sf_dir).select("symbol", "trade_date", "close_price")
    w = Window.partitionBy("symbol")
    n = b.withColumns({"head": F.row_number().over(w.orderBy("trade_date")) <= 3,
                       "tail": F.row_number().over(w.orderBy(F.desc("trade_date"))) <= 3})
    return rounded(n.where("head or tail").withColumnsRenamed({"head": "in_head", "tail": "in_tail"}))


LISTED = ["T00001", "T00002", "T00003", "T00005", "T00008"]


def q_sector_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 + P8 + P18: each member's first close, the shares of a symbol list, and members
    without bars, per sector."""
    bars = S.bars(spark, sf_dir).select("symbol", "trade_date", "close_price")
    members = S.sector_members(spark, sf_dir)
    first = lookup_first(bars, "symbol", ["close_price"], "trade_date")
    missing = missing_keys(members, bars, "symbol").withColumn("missing", F.lit(1))
    listed = S.shares(spark, sf_dir).where(F.col("symbol").isin(LISTED))
    j = (members.join(first, "symbol", "left").join(missing, "symbol", "left")
         .join(listed, "symbol", "left"))
    return rounded(j.groupBy("sector").agg(
        F.count(F.lit(1)).alias("members"), F.count("missing").alias("missing_bars"),
        F.sum("close_price").alias("first_close_sum"),
        F.sum("shares_outstanding").alias("listed_shares")))


def q_payload_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 + S6: a JSON payload for each symbol, its array exploded again; payloads without the
    array (symbols that end in 7) are routed to the rejects."""
    record = F.struct(F.col("trade_date").cast("string").alias("trade_date"), "close_price", "volume")
    text = F.when(F.col("symbol").endswith("7"), F.lit('{"message": "no data"}')).otherwise(
        F.to_json(F.struct(F.collect_list(record).alias("prices"))))
    payloads = S.bars(spark, sf_dir).groupBy("symbol").agg(text.alias("value"))
    kind = StructType([f for f in files.PRICE_FIELDS if f.name in ("trade_date", "close_price", "volume")])
    rows, rejects = files.explode_payload(payloads, "prices", kind, keep=["symbol"])
    good = rows.groupBy("symbol").agg(F.lit(False).alias("rejected"), F.count("trade_date").alias("n_rows"),
                                      F.sum("volume").alias("volume"))
    bad = rejects.select("symbol", F.lit(True).alias("rejected"), F.lit(0).cast("long").alias("n_rows"),
                         F.lit(0.0).alias("volume"))
    return rounded(good.unionByName(bad))


def _listed_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars whose first two symbols have names that a reader could take for numbers."""
    odd = F.when(F.col("symbol") == "T00001", "INFINITY").when(F.col("symbol") == "T00002", "007").otherwise(F.col("symbol"))
    return S.bars(spark, sf_dir).withColumn("symbol", odd)


def q_partitioned_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars published with one folder per symbol, read back through partition pruning."""
    bars = _listed_bars(spark, sf_dir)
    path = scratch_path(spark, "bars-by-symbol")
    files.publish(bars, path, lambda df, p: files.write_partitioned(df, p, "symbol"))
    back = files.read_partitioned(spark, path, bars.schema)
    return rounded(back.where(F.col("symbol").isin("007", "INFINITY", *LISTED)))


def q_csv_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2 + S4 + S8: bars written as CSV files, a folder per symbol, and scanned back with the
    symbol from the path; lines with a volume that is no number (those of the 13th) are rejects."""
    bars = _listed_bars(spark, sf_dir).select(
        "symbol", F.col("trade_date").cast("string").alias("trade_date"), "close_price",
        F.when(F.dayofmonth("trade_date") == 13, "n/a").otherwise(F.col("volume").cast("string")).alias("volume"))
    path = scratch_path(spark, "bars-csv")
    files.publish(bars, path, lambda df, p: files.write_partitioned(df, p, "symbol", "csv"))
    wanted = {"trade_date", "close_price", "volume"}
    kind = StructType([f for f in files.PRICE_FIELDS if f.name in wanted])
    rows, rejects = files.scan_price_folder(spark, path, "*.csv", kind, key_from="folder")
    good = rows.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rows"), F.count("volume").alias("n_volume"),
                                      F.sum("volume").alias("volume"), F.min("trade_date").alias("first_date"),
                                      F.sum("close_price").alias("close_sum"))
    bad = rejects.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_rejected"))
    out = good.join(bad, "symbol", "left").withColumn("n_rejected", F.coalesce("n_rejected", F.lit(0)))
    return rounded(out)


def q_sector_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: members written as a tree (sector folder, ticker folder) and read back from its listing;
    the file of a table beside it, at another depth, is counted as a reject."""
    members = S.sector_members(spark, sf_dir)
    path = scratch_path(spark, "sector-tree")
    tree = members.select("sector", F.concat("symbol", F.lit("_bars")).alias("ticker"), F.lit(1).alias("one"))
    files.publish(tree, path, lambda df, p: files.write_partitioned(df, p, ["sector", "ticker"]))
    members.select("sector").distinct().coalesce(1).write.mode("overwrite").parquet(f"{path}/stray")
    found, rejects = files.scan_sector_tree(spark, path, leaf="folder")
    per = found.groupBy("sector").agg(F.count(F.lit(1)).alias("members"), F.min("symbol").alias("first_symbol"),
                                      F.max("symbol").alias("last_symbol"))
    other = rejects.agg(F.lit("(files at another depth)").alias("sector"), F.count(F.lit(1)).alias("members"),
                        F.lit(None).cast("string").alias("first_symbol"), F.lit(None).cast("string").alias("last_symbol"))
    return per.unionByName(other)


WINDOW_START, WINDOW_END = "1996-03-01", "1996-05-31"


def q_bars_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of a date range, from a table clustered on the date, so that the range skips files."""
    path = scratch_path(spark, "bars-by-date")
    bars = S.bars(spark, sf_dir)
    files.publish(bars, path, lambda df, p: files.write_by_range(df, p, "trade_date", 16))
    back = spark.read.schema(bars.schema).parquet(path)
    return rounded(back.where(F.col("trade_date").between(F.lit(WINDOW_START).cast("date"), F.lit(WINDOW_END).cast("date"))))


def q_sector_market_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + P7 + P18 + J9: sector market cap from per-symbol lookups, with coverage."""
    bars = S.bars(spark, sf_dir)
    members = S.sector_members(spark, sf_dir)
    info = S.stock_info(spark, sf_dir, bars).select("symbol", "market_cap")
    j = members.join(info, "symbol", "left")
    return rounded(j.groupBy("sector").agg(
        F.count(F.lit(1)).alias("members"), F.count("market_cap").alias("priced"),
        F.count_if(F.col("market_cap").isNull()).alias("missing_info"),
        F.sum("market_cap").alias("sector_market_cap")))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query (C1 ticker features, reference parameters) on sf0.001."""
    return q_ticker_features(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ticker_features": q_ticker_features,
        "sector_daily": q_sector_daily,
        "sector_static": q_sector_static,
        "sector_features": q_sector_features,
        "macro_aligned": q_macro_aligned,
        "macro_lags": q_macro_lags,
        "training_frame": q_training_frame,
        "daily_training_frame": q_daily_training_frame,
        "corr_matrix": q_corr_matrix,
        "corr_target": q_corr_target,
        "corr_screen": q_corr_screen,
        "stationary_screen": q_stationary_screen,
        "describe": q_describe,
        "describe_facts": q_describe_facts,
        "label_counts": q_label_counts,
        "fold_report": q_fold_report,
        "holdout": q_holdout,
        "baseline_rmse": q_baseline_rmse,
        "baseline_accuracy": q_baseline_accuracy,
        "nb_scores": q_nb_scores,
        "nb_summary": q_nb_summary,
        "nb_report": q_nb_report,
        "nb_confusion": q_nb_confusion,
        "ridge_scores": q_ridge_scores,
        "lasso_scores": q_lasso_scores,
        "elasticnet_scores": q_elasticnet_scores,
        "logistic_scores": q_logistic_scores,
        "logistic_report": q_logistic_report,
        "logistic_confusion": q_logistic_confusion,
        "monthly_rollup": q_monthly_rollup,
        "event_props": q_event_props,
        "event_gate": q_event_gate,
        "bar_quality": q_bar_quality,
        "month_spine": q_month_spine,
        "symbol_batches": q_symbol_batches,
        "sector_market_cap": q_sector_market_cap,
        "corr_flagged": q_corr_flagged,
        "stationary_all": q_stationary_all,
        "series_ends": q_series_ends,
        "sector_lookup": q_sector_lookup,
        "payload_prices": q_payload_prices,
        "partitioned_bars": q_partitioned_bars,
        "csv_bars": q_csv_bars,
        "sector_tree": q_sector_tree,
        "bars_window": q_bars_window,
        "classifier_sweep": q_classifier_sweep,
        "regressor_sweep": q_regressor_sweep,
        "feature_importance": q_feature_importance,
        "boosted_scores": q_boosted_scores,
        "boosted_importance": q_boosted_importance,
        "boosted_report": q_boosted_report,
        "boosted_confusion": q_boosted_confusion,
        "boosted_regression": q_boosted_regression,
        "adaboost_scores": q_adaboost_scores,
        "holdout_report": q_holdout_report,
        "classifier_report": q_classifier_report,
        "holdout_scores": q_holdout_scores,
        **(llm.queries() if llm else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {
        "ticker_features": O.TICKER_FEATURES,
        "sector_daily": O.SECTOR_DAILY,
        "sector_static": O.SECTOR_STATIC,
        "sector_features": O.SECTOR_FEATURES,
        "macro_aligned": O.MACRO_ALIGNED,
        "macro_lags": O.MACRO_LAGS,
        "training_frame": O.TRAINING_FRAME,
        "daily_training_frame": O.DAILY_TRAINING_FRAME,
        "corr_matrix": O.CORR_MATRIX,
        "corr_target": O.CORR_TARGET,
        "corr_screen": O.CORR_SCREEN,
        "stationary_screen": O.STATIONARY_SCREEN,
        "describe": O.DESCRIBE,
        "describe_facts": O.DESCRIBE_FACTS,
        "label_counts": O.LABEL_COUNTS,
        "fold_report": O.FOLD_REPORT,
        "holdout": O.HOLDOUT,
        "baseline_rmse": O.BASELINE_RMSE,
        "baseline_accuracy": O.BASELINE_ACCURACY,
        "nb_scores": O.NB_SCORES,
        "nb_summary": O.NB_SUMMARY,
        "nb_report": O.NB_REPORT,
        "nb_confusion": O.NB_CONFUSION,
        "ridge_scores": O.RIDGE_SCORES,
        "lasso_scores": O.LASSO_SCORES,
        "elasticnet_scores": O.ELASTICNET_SCORES,
        "logistic_scores": O.LOGISTIC_SCORES,
        "logistic_report": O.LOGISTIC_REPORT,
        "logistic_confusion": O.LOGISTIC_CONFUSION,
        "monthly_rollup": O.MONTHLY_ROLLUP,
        "event_props": O.EVENT_PROPS,
        "event_gate": O.EVENT_GATE,
        "bar_quality": O.BAR_QUALITY,
        "month_spine": O.MONTH_SPINE,
        "symbol_batches": O.SYMBOL_BATCHES,
        "corr_flagged": O.CORR_FLAGGED,
        "stationary_all": O.STATIONARY_ALL,
        "series_ends": O.SERIES_ENDS,
        "sector_lookup": O.SECTOR_LOOKUP,
        "payload_prices": O.PAYLOAD_PRICES,
        "partitioned_bars": O.PARTITIONED_BARS,
        "csv_bars": O.CSV_BARS,
        "sector_tree": O.SECTOR_TREE,
        "bars_window": O.BARS_WINDOW,
        "sector_market_cap": O.SECTOR_MARKET_CAP,
        **(llm.oracle_sql() if llm else {}),
        **({"pipeline": corpus_pipeline.ORACLE_SQL}
           if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}),
    }
