"""Base learners, stacking, random search and metrics.

The reference trains three boosting libraries on one machine and stacks them
with a scikit-learn forest. Here the base learners are ``operators.boosting``
(second-order boosting over the partitioned, binned feature frame, all trials of
a search in shared passes), and the stack is Spark ML's forest. The three
profiles keep the reference's hyper-parameter surface, leaf penalties included.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.operators import boosting
from barwise.operators.boosting import PATIENCE, SEED, Booster, Trial
from barwise.operators.features import LABEL, MODEL_FEATURES

# Search ranges of the reference (fixed values): name -> (low, high, kind).
PROFILES = {
    "lightgbm": {"maxIter": (100, 1000, "int"), "stepSize": (0.01, 0.3, "log"),
                 "maxDepth": (3, 15, "int"), "regAlpha": (0.001, 10, "log"), "regLambda": (0.001, 10, "log"),
                 "subsamplingRate": (0.1, 1.0, "uniform"), "featureFraction": (0.1, 1.0, "uniform")},
    "xgboost": {"maxIter": (100, 1000, "int"), "stepSize": (0.01, 0.3, "log"),
                "maxDepth": (3, 15, "int"), "regAlpha": (0.001, 10, "log"), "regLambda": (0.001, 10, "log"),
                "subsamplingRate": (0.1, 1.0, "uniform"), "featureFraction": (0.1, 1.0, "uniform")},
    "catboost": {"maxIter": (100, 1000, "int"), "stepSize": (0.01, 0.3, "log"),
                 "maxDepth": (3, 15, "int"), "l2LeafReg": (0.001, 10, "log"),
                 "baggingTemperature": (0, 1, "uniform"), "randomStrength": (0.001, 10, "log")},
}
# Settings of the profiles' libraries that no search varies (fixed values).
PROFILE_SETTINGS = {
    "lightgbm": {"leaves": 31, "min_child": 20.0, "lambda_": 0.0},
    "xgboost": {"min_child": 1.0},
    "catboost": {"symmetric": True, "lambda_": 3.0, "min_child": 0.0, "temperature": 1.0, "noise": 1.0},
}
# Our names of the hyper-parameters -> fields of ``Trial``.
PARAMETERS = {"maxIter": "rounds", "stepSize": "rate", "maxDepth": "depth", "regAlpha": "alpha", "regLambda": "lambda_",
              "l2LeafReg": "lambda_", "subsamplingRate": "row_fraction", "featureFraction": "feature_fraction",
              "baggingTemperature": "temperature", "randomStrength": "noise"}


def finite(c: str) -> Column:
    """M1: cap +/-inf (e.g. volume change after an empty week) to the largest
    finite double so tree binning stays defined; NULL/NaN are already gone."""
    x = F.col(c).cast("double")
    big = 1.7976931348623157e308
    return (F.when(x == float("inf"), F.lit(big))
            .when(x == float("-inf"), F.lit(-big)).otherwise(x)).alias(c)


def model_frame(df: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Feature columns made finite, keys and label kept."""
    keep = [c for c in ("symbol", "date", "period", LABEL, "weekly_return", "open", "adj_close")
            if c in df.columns and c not in features]
    return df.select(*keep, *[finite(c) for c in features])


def trial(name: str, profile: str, features: Sequence[str], params: dict) -> Trial:
    """The settings of one learner: the profile's, then ``params``."""
    given = {PARAMETERS[k]: v for k, v in params.items()}
    whole = {k: int(given[k]) for k in ("rounds", "depth") if k in given}
    return Trial(name, list(features), **(PROFILE_SETTINGS[profile] | given | whole))


def fit_base(df: DataFrame, profile: str, features: Sequence[str], params: dict,
             name: str, validation_col: str | None = None, patience: int = PATIENCE) -> Booster:
    """M2-M4: one base learner on a feature subset (P16), which it stores.

    M5: with ``validation_col`` (a boolean column marking the early-stopping
    rows, e.g. the test period) boosting stops ``patience`` iterations after
    the best validation error and keeps the trees up to that."""
    return boosting.fit_many(df, [trial(name, profile, features, params)], LABEL, validation_col, patience)[0]


def score(df: DataFrame, models: dict[str, Booster]) -> DataFrame:
    """Append one prediction column per model in a single pass
    (columns are added in place, so no positional re-alignment)."""
    return boosting.score(df, models)


def fit_stack(df: DataFrame, cols: Sequence[str], trees: int = 100, depth: int = 10) -> PipelineModel:
    """Random forest over the base predictions (bootstrap, all features
    per split, seed 42). The reference's trees have no depth limit."""
    assembler = VectorAssembler(inputCols=list(cols), outputCol="stack_features")
    rf = RandomForestRegressor(featuresCol="stack_features", labelCol=LABEL,
                               predictionCol="predicted_return", numTrees=trees, maxDepth=depth,
                               featureSubsetStrategy="all", seed=SEED)
    return Pipeline(stages=[assembler, rf]).fit(df)


def regression_metrics(df: DataFrame, y: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """RMSE and MAE (optionally per group) as one aggregate."""
    err = F.col(y) - F.col(pred)
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                               F.sqrt(F.avg(err * err)).alias("rmse"),
                               F.avg(F.abs(err)).alias("mae"))


def signals_from(df: DataFrame, col: str, scenario_id: str | None = None) -> DataFrame:
    """A signal frame (date, symbol, predicted_return[, scenario_id])."""
    out = df.select("date", "symbol", F.col(col).alias("predicted_return"))
    return out.withColumn("scenario_id", F.lit(scenario_id)) if scenario_id else out


def sample_trials(profiles: Sequence[str], metrics: Sequence[str], n_trials: int,
                  features: Sequence[str] = MODEL_FEATURES, seed: int = SEED,
                  ranges: dict | None = None) -> list[dict]:
    """M6: seeded random search space — a feature mask and the profile's
    hyper-parameters per trial (Optuna's adaptive sampler is replaced by
    independent seeded draws so all trials can share passes). ``ranges``
    replaces a profile's search range by name; draws are passed on unchanged."""
    rng = random.Random(seed)
    trials = []
    for profile in profiles:
        for metric in metrics:
            for t in range(n_trials):
                mask = [f for f in features if rng.random() < 0.5] or [features[0]]
                params = {}
                for name, (lo, hi, kind) in (PROFILES[profile] | (ranges or {})).items():
                    if kind == "int":
                        v = rng.randint(lo, hi)
                    elif kind == "log":
                        import math
                        v = math.exp(rng.uniform(math.log(lo), math.log(hi)))
                    else:
                        v = rng.uniform(lo, hi)
                    params[name] = v
                trials.append({"trial_id": f"{profile}_{metric}_{t}", "profile": profile,
                               "metric": metric, "features": mask, "params": params})
    return trials


def fit_trials(train: DataFrame, trials: list[dict], test: DataFrame | None = None, patience: int = PATIENCE) -> list[Booster]:
    """All trials at once, over one binned frame; ``test`` rows, if given, are
    the early-stopping set (M5), as in the reference's search."""
    df, val = train, None
    if test is not None:
        val = "_is_val"
        df = train.withColumn(val, F.lit(False)).unionByName(test.withColumn(val, F.lit(True)))
    return boosting.fit_many(df, [trial(t["trial_id"], t["profile"], t["features"], t["params"]) for t in trials], LABEL, val, patience)


def trial_signals(df: DataFrame, models: Sequence[Booster], *keep: str) -> DataFrame:
    """(date, symbol, scenario_id, predicted_return, *keep): every model's
    predictions, scored in one pass, with ``scenario_id`` = the model's name."""
    scored = score(df, {f"_p{i}": m for i, m in enumerate(models)})
    each = F.explode(F.array(*[F.struct(F.lit(m.name).alias("scenario_id"), F.col(f"_p{i}").alias("predicted_return"))
                               for i, m in enumerate(models)]))
    return scored.select("date", "symbol", *keep, each.alias("_t")).select("date", "symbol", "_t.scenario_id", "_t.predicted_return", *keep)


def random_search(train: DataFrame, test: DataFrame, trials: list[dict],
                  early_stopping: bool = True, patience: int = PATIENCE) -> DataFrame:
    """M6: fit every trial on ``train``, all in shared passes, and score
    ``test``; returns all trials' signals with ``scenario_id = trial_id``,
    ready for one multi-scenario backtest."""
    return trial_signals(test, fit_trials(train, trials, test if early_stopping else None, patience))


def refit_best(train: DataFrame, test: DataFrame, trials: list[dict], best: DataFrame,
               bars: DataFrame) -> dict[str, DataFrame]:
    """M8: refit each selected trial (``best``: scenario_id = trial_id), then
    report RMSE/MAE on ``test`` and backtest its test signals on ``bars``
    (the reference prices this step on the weekly frame). Returns
    ``metrics`` and ``summary`` DataFrames keyed by trial."""
    from barwise.operators import backtest as bt
    chosen = {r.scenario_id for r in best.select("scenario_id").distinct().collect()}
    picked = [t for t in trials if t["trial_id"] in chosen]
    sig = trial_signals(test, fit_trials(train, picked), LABEL)
    grid = train.sparkSession.createDataFrame(
        [(t["trial_id"], 5, 0.04, 0.001, 100000.0, 0.0) for t in picked], bt.SCENARIO_SCHEMA)
    return {"metrics": regression_metrics(sig, LABEL, "predicted_return", by=["scenario_id"]),
            "summary": bt.run_backtest(sig.drop(LABEL), bars, grid)["summary"]}


def score_and_store(spark, frame: DataFrame, models: dict[str, Booster],
                    stack: PipelineModel, table: str, period: str = "prediction") -> DataFrame:
    """Score one period with the base models and the stacker and append
    the predictions (date, symbol, predicted_return, return, open, adj_close)
    with insert-ignore on (date, symbol). ``return`` is the signal week's
    own return, as in the reference."""
    from barwise.sources.tables import PREDICTIONS_DDL, create_table, insert_ignore
    rows = stack.transform(score(frame.where(F.col("period") == period), models))
    out = rows.select("date", "symbol", "predicted_return", F.col("weekly_return").alias("return"),
                      "open", "adj_close", F.lit(0).alias("arrival"))
    create_table(spark, table, PREDICTIONS_DDL)
    return insert_ignore(spark, out, table)


def save_models(models: dict[str, Booster], path: str) -> None:
    """Persist each model, its feature list with it, as one JSON text."""
    spark = SparkSession.getActiveSession()
    for name, m in models.items():
        spark.createDataFrame([(m.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")


def load_models(path: str, names: Sequence[str]) -> dict[str, Booster]:
    """Load those of ``names`` that exist, skip the others. A model that
    exists and can't be read is an error."""
    spark = SparkSession.getActiveSession()
    out = {}
    for name in names:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            out[name] = Booster.from_json(spark.read.parquet(f"{path}/{name}").first()["model"])
    return out
