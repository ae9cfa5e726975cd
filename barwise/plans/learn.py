"""Registered model queries.

``base_scores`` and ``stacked_scores`` return every prediction (rows-only checks:
learners have no SQL form); ``base_score_facts`` and ``stacked_score_facts`` are
facts that hold for any sound learner, and ``boost_tree`` is one tree in full,
which SQL can check. The base learners run 100 iterations with the libraries'
default depth, the stack 100 trees. ``random_search`` has the reference's trials
and ranges but for the iterations (``SEARCH_RANGES``, ``SEARCH_PATIENCE``); README
has the times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwise.operators import backtest as bt
from barwise.operators import boosting
from barwise.operators import model as ml
from barwise.operators.features import LABEL, MODEL_FEATURES
from barwise.operators.split import split_periods
from barwise.plans import catalog as cat

# Budgets of the registered checks.
BASE_PARAMS = {
    "lightgbm": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "regAlpha": 0.1, "regLambda": 1.0,
                 "subsamplingRate": 0.8, "featureFraction": 0.8},
    "xgboost": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "regAlpha": 0.1, "regLambda": 1.0,
                "subsamplingRate": 0.8, "featureFraction": 0.6},
    "catboost": {"maxIter": 100, "stepSize": 0.1, "maxDepth": 6, "l2LeafReg": 3.0},
}
SEARCH_RANGES = {"maxIter": (2, 4, "int")}
SEARCH_TRIALS, SEARCH_PATIENCE = 10, 2
# The tree of ``boost_tree``.
TREE_FEATURES = ["adj_close", "rsi_2w", "momentum_4w", "stoch_d", "atr", "weekly_return"]
TREE_PARAMS = dict(depth=2, alpha=5.0, lambda_=2.0, rate=0.5, min_child=20.0)


def frame(spark: SparkSession, sf: str) -> DataFrame:
    df = split_periods(cat.complete(spark, sf)).where(F.col("period").isNotNull())
    return ml.model_frame(df).persist()


def model_facts(scored: DataFrame, predictions: list[str]) -> DataFrame:
    """Per learner and period: rows, NULL predictions, and whether the error on
    the training rows is below the label's standard deviation (NULL elsewhere)."""
    long = scored.select("period", LABEL, F.explode(F.create_map(*[
        x for p in predictions for x in (F.lit(p), F.col(p))])).alias("learner", "prediction"))
    err = F.col(LABEL) - F.col("prediction")
    return long.groupBy("learner", "period").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("prediction").isNull()).alias("null_predictions"),
        F.when(F.col("period") == "train", F.sqrt(F.avg(err * err)) < F.stddev_pop(LABEL)).alias("beats_std"))


_FITTED: dict[tuple[str, str], dict] = {}


def base_models(df: DataFrame, sf: str):
    """The base learners, fitted once per application and folder: four queries
    score with the same ones."""
    name = (df.sparkSession.sparkContext.applicationId, sf)
    if name not in _FITTED:
        _FITTED[name] = _fit_base_models(df)
    return _FITTED[name]


def _fit_base_models(df: DataFrame):
    train = df.where(F.col("period") == "train")
    trials = [dict(trial_id=p, profile=p, features=MODEL_FEATURES, params=params) for p, params in BASE_PARAMS.items()]
    return {m.name: m for m in ml.fit_trials(train, trials)}


def base_predictions(spark, sf):
    df = frame(spark, sf)
    return ml.score(df, base_models(df, sf))


def stacked_predictions(spark, sf):
    scored = base_predictions(spark, sf).persist()
    stack = ml.fit_stack(scored.where(F.col("period") == "train"), list(BASE_PARAMS))
    return stack.transform(scored)


def q_base_scores(spark, sf):
    return base_predictions(spark, sf).select("symbol", "date", "period", *BASE_PARAMS)


def q_base_score_facts(spark, sf):
    return model_facts(base_predictions(spark, sf), list(BASE_PARAMS))


def q_stacked_scores(spark, sf):
    return stacked_predictions(spark, sf).select("symbol", "date", "period", "predicted_return")


def q_stacked_score_facts(spark, sf):
    return model_facts(stacked_predictions(spark, sf), ["predicted_return"])


def q_boost_tree(spark, sf):
    """The first tree of a booster over the training rows, node by node."""
    train = frame(spark, sf).where(F.col("period") == "train")
    one = boosting.Trial("tree", TREE_FEATURES, rounds=1, **TREE_PARAMS)
    model = boosting.fit_many(train.select("symbol", "date", LABEL, *TREE_FEATURES), [one], LABEL)[0]
    rows = [(path, feature, threshold, gain, value) for _, path, feature, threshold, gain, value in boosting.tree_rows(model)]
    out = spark.createDataFrame(rows, "path string, feature string, threshold double, gain double, value double")
    return out.select("path", "feature", cat.r("threshold", 6), cat.r("gain", 1), cat.r("value", 4))


def periods(spark, sf):
    df = frame(spark, sf)
    return df.where(F.col("period") == "train"), df.where(F.col("period") == "test")


def search_trials():
    return ml.sample_trials(list(ml.PROFILES), ["roi", "sharpe_ratio"], SEARCH_TRIALS, ranges=SEARCH_RANGES)


def q_random_search(spark, sf):
    """Every trial's backtest on the test period, and the best of each pair."""
    train, test = periods(spark, sf)
    trials = search_trials()
    sigs = ml.random_search(train, test, trials, patience=SEARCH_PATIENCE).persist()
    grid = spark.createDataFrame(
        [(t["trial_id"], 5, 0.04, 0.001, 100000.0, 0.0) for t in trials], bt.SCENARIO_SCHEMA)
    res = bt.run_backtest(sigs, cat.daily(spark, sf), grid)
    meta = spark.createDataFrame([(t["trial_id"], t["profile"], t["metric"]) for t in trials],
                                 "scenario_id string, profile string, metric string")
    rank = Window.partitionBy("profile", "metric").orderBy(
        F.desc(F.when(F.col("metric") == "roi", F.col("roi")).otherwise(F.col("sharpe_ratio"))), "scenario_id")
    return (res["summary"].join(meta, "scenario_id").withColumn("best", F.row_number().over(rank) == 1)
            .select("profile", "metric", "scenario_id", "roi", "sharpe_ratio", "trades", "best"))


def q_refit_report(spark, sf):
    """M8: the first trial of every (profile, objective) refit on the training
    period, with its test errors and its backtest on the weekly bars."""
    train, test = periods(spark, sf)
    trials = [t for t in search_trials() if t["trial_id"].endswith("_0")]
    best = spark.createDataFrame([(t["trial_id"],) for t in trials], "scenario_id string")
    out = ml.refit_best(train, test, trials, best, cat.weekly(spark, sf))
    return out["metrics"].join(out["summary"], "scenario_id").select(
        "scenario_id", "n", "rmse", "mae", "roi", "sharpe_ratio", "net_profit", "trades")


def queries():
    return {
        "base_scores": q_base_scores,
        "base_score_facts": q_base_score_facts,
        "stacked_scores": q_stacked_scores,
        "stacked_score_facts": q_stacked_score_facts,
        "boost_tree": q_boost_tree,
        "random_search": q_random_search,
        "refit_report": q_refit_report,
    }
