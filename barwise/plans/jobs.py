"""End-to-end jobs, composed from the operators.

* ``load_feeds``   - 3.1: provider feeds -> normalised bars -> insert-ignore.
* ``train_models`` - 3.3: seeded random search over the learner profiles,
                     all trials backtested in one job, best per (profile,
                     objective) refit and saved.
* ``predict``      - 3.2: features -> base scores -> stacked forest ->
                     metrics and backtests for validation and prediction ->
                     predictions stored with insert-ignore.

Each job is a handful of lazy plans; nothing is collected except the small
trial list and the chosen trial ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.operators import backtest as bt
from barwise.operators import model as ml
from barwise.operators.features import LABEL, add_features
from barwise.operators.resample import resample_ohlcv
from barwise.operators.split import DEFAULT_BOUNDS, drop_incomplete, split_periods
from barwise.sources.bars import normalize
from barwise.sources.tables import insert_ignore

OBJECTIVES = ("roi", "sharpe_ratio")


def load_feeds(spark: SparkSession, feeds: Mapping[str, DataFrame], table: str) -> DataFrame:
    """Normalise every feed (feeds without a date column are skipped), give
    each the arrival rank of its position (an earlier feed wins a duplicate
    key), and append the new bars to ``table``. Returns the appended rows."""
    batch = None
    for rank, (symbol, raw) in enumerate(feeds.items()):
        bars = normalize(raw, symbol=symbol)
        if bars is None:
            continue
        bars = bars.withColumn("arrival", F.lit(rank))
        batch = bars if batch is None else batch.unionByName(bars)
    if batch is None:
        raise ValueError("no feed has a date column")
    return insert_ignore(spark, batch, table)


def feature_frame(bars: DataFrame, benchmark: str | None = None,
                  bounds: Sequence[str] = DEFAULT_BOUNDS) -> DataFrame:
    """Complete weekly feature rows with their period, ready for the models."""
    stocks = bars.where(F.col("symbol") != benchmark) if benchmark else bars
    feats = split_periods(drop_incomplete(add_features(resample_ohlcv(stocks))), bounds)
    return ml.model_frame(feats.where(F.col("period").isNotNull()))


def train_models(spark: SparkSession, bars: DataFrame, model_path: str, n_trials: int = 10,
                 benchmark: str | None = None, ranges: dict | None = None,
                 grid_params: dict | None = None) -> dict[str, DataFrame]:
    """Random search (M6), one multi-scenario backtest of every trial on the
    test period priced on daily bars (M7), best trial per (profile,
    objective) (A15), refit and save (M8, S12)."""
    frame = feature_frame(bars, benchmark).persist()
    train = frame.where(F.col("period") == "train")
    test = frame.where(F.col("period") == "test")
    trials = ml.sample_trials(list(ml.PROFILES), OBJECTIVES, n_trials, ranges=ranges)
    sigs = ml.random_search(train, test, trials)
    p = dict(k=5, take_profit=0.04, fee=0.001, initial_cash=100000.0, risk_free=0.0)
    p.update(grid_params or {})
    grid = spark.createDataFrame(
        [(t["trial_id"], p["k"], p["take_profit"], p["fee"], p["initial_cash"], p["risk_free"])
         for t in trials], bt.SCENARIO_SCHEMA)
    summary = bt.scenario_sweep(sigs, bars, grid)
    meta = spark.createDataFrame([(t["trial_id"], t["profile"], t["metric"]) for t in trials],
                                 "scenario_id string, profile string, metric string")
    tagged = summary.join(meta, "scenario_id")
    best = None
    for objective in OBJECTIVES:
        b = bt.best_scenario(tagged.where(F.col("metric") == objective), objective, ["profile"])
        b = b.withColumn("objective", F.lit(objective))
        best = b if best is None else best.unionByName(b)
    chosen = {r.scenario_id: f"{r.profile}_{r.objective}" for r in best.collect()}
    picked = [t for t in trials if t["trial_id"] in chosen]
    ml.save_models({chosen[m.name]: m for m in ml.fit_trials(train, picked)}, model_path)
    return {"summary": summary, "best": best}


def predict(spark: SparkSession, bars: DataFrame, model_path: str, predictions_table: str,
            benchmark: str | None = None, scenarios: DataFrame | None = None,
            stack_trees: int = 100) -> dict[str, DataFrame]:
    """Score every period with the saved models that exist (S13), stack them
    with a forest trained on the in-sample base predictions (M10, as in the
    reference), report RMSE/MAE and backtests for validation and prediction
    (M11, B1-B12) and store the prediction-period rows (S11)."""
    names = [f"{p}_{o}" for p in ml.PROFILES for o in OBJECTIVES]
    models = ml.load_models(model_path, names)
    if not models:
        raise ValueError(f"no models under {model_path}")
    frame = feature_frame(bars, benchmark)
    scored = ml.score(frame, models).persist()
    stack = ml.fit_stack(scored.where(F.col("period") == "train"), list(models), trees=stack_trees)
    out = stack.transform(scored.where(F.col("period").isin("validation", "prediction")))
    grid = scenarios if scenarios is not None else bt.scenario_grid(spark)
    result = {"metrics": ml.regression_metrics(out, LABEL, "predicted_return", by=["period"])}
    for period in ("validation", "prediction"):
        sig = ml.signals_from(out.where(F.col("period") == period), "predicted_return")
        result[f"{period}_summary"] = bt.scenario_sweep(sig, bars, grid)
    result["stored"] = ml.score_and_store(spark, frame, models, stack, predictions_table)
    return result
