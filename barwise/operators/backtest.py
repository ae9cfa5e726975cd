"""Take-profit strategy backtest as relational operators.

The reference walks dates and symbols in one Python loop. Because at least
one share is always bought, cash never blocks a trade, so the loop splits in
two folds:

1. ``trade_pairs``: per (scenario, symbol), which signals buy and which sell
   and at what return. Fully parallel; a group is one symbol's signal dates
   in one scenario (at most one row per date: bounded by the calendar).
2. ``ledger``: per scenario, share sizing, fee-adjusted cash and the logged
   portfolio value over the (short) action list, in signal-date, symbol,
   buy-before-sell order. A group is one scenario's actions, at most k buys
   per signal date: bounded by k x the calendar, not by data volume.

Everything around the folds (scenario replication, per-date top-k, the
next-bar equi-join, last close, Sharpe, final value) is built-in relational
work. The first fold is an expression over one series' sorted array, the second
a grouped map (``applyInPandas``). Scenarios
(take-profit x fee x k x ..., or every random-search trial) run in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwise.operators.asof import asof_join
from barwise.session import task_partitions
from barwise.operators.signals import last_close, topk_signals, tradable_signals

SCENARIO_SCHEMA = T.StructType([
    T.StructField("scenario_id", T.StringType(), False),
    T.StructField("k", T.IntegerType(), False),
    T.StructField("take_profit", T.DoubleType(), False),
    T.StructField("fee", T.DoubleType(), False),
    T.StructField("initial_cash", T.DoubleType(), False),
    T.StructField("risk_free", T.DoubleType(), False),
])


def scenario_grid(spark: SparkSession, take_profit: Sequence[float] = (0.04,),
                  fee: Sequence[float] = (0.001,), k: Sequence[int] = (5,),
                  initial_cash: float = 100000.0, risk_free: float = 0.0) -> DataFrame:
    """Cartesian parameter grid, one row per scenario (a driver-side list)."""
    rows = [(f"k{kk}_tp{tp}_fee{ff}", int(kk), float(tp), float(ff), float(initial_cash),
             float(risk_free)) for kk in k for tp in take_profit for ff in fee]
    return spark.createDataFrame(rows, SCENARIO_SCHEMA)


def ranked_scenarios(preds: DataFrame, scenarios: DataFrame) -> DataFrame:
    """The top-k rows of every scenario, with its parameters.

    Predictions that carry a ``scenario_id`` join the grid on it and are ranked
    per scenario. Predictions without one are shared: they are ranked once, up
    to the grid's largest k, and the few rows left join the grid on the rank
    (each scenario stands for ranks 1 to its k), so the ranking shuffle doesn't
    grow with the number of scenarios. AQE picks the joins by measured sizes.
    """
    k_max = scenarios.agg(F.max("k")).first()[0]
    if "scenario_id" in preds.columns:
        return topk_signals(preds.join(scenarios, "scenario_id"), k="k", k_max=k_max)
    top = topk_signals(preds, k=int(k_max or 0))
    ranks = scenarios.withColumn("rank", F.explode(F.sequence(F.lit(1), F.greatest("k", F.lit(1))))).where("rank <= k")
    return top.join(ranks, "rank")


LOG_SCHEMA = T.StructType([
    T.StructField("scenario_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("signal_date", T.DateType()),
    T.StructField("trade_date", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("action", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("shares", T.DoubleType()),
    T.StructField("total_cash", T.DoubleType()),
    T.StructField("portfolio_value", T.DoubleType()),
    T.StructField("profit_percentage", T.DoubleType()),
    T.StructField("held", T.MapType(T.StringType(), T.DoubleType())),
])


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition fold inputs by their group keys into the session's
    shuffle-partition count. The folds are compute-heavy but small in bytes,
    so AQE's size-based coalescing would otherwise pack every group into one
    task; an explicit partition count is kept as is, and the grouping on the
    same keys adds no Exchange."""
    return df.repartition(task_partitions(df.sparkSession), *keys)


def trade_pairs(tradable: DataFrame) -> DataFrame:
    """Per (scenario, symbol) fold over the tradable signal dates.

    Flat -> buy at the next open; then, in the same step, a held position
    whose return since purchase reaches take_profit is sold at the next open
    (so take_profit <= 0 sells at once). Emits one row per action with the
    trade return (0 for buys). The fold is an expression over the sorted array
    of one series, which has a row per signal date at most; its state grows by
    one place per action, so dates without a trade cost no copy. A missing or
    zero price is bought at, but nothing is sold at or against it.
    """
    cols = tradable.select("scenario_id", "symbol", "take_profit", "date", "next_date",
                           "next_open", "close")
    series = _spread(cols, "scenario_id", "symbol").groupBy("scenario_id", "symbol").agg(
        F.expr("sort_array(collect_list(struct(date, next_date, next_open, close))) AS days"),
        F.expr("min(take_profit) AS take_profit"))
    fold = """inline(aggregate(days,
        named_struct('i', 0, 'holding', false, 'paid', CAST(NULL AS DOUBLE),
                     'acts', CAST(array() AS ARRAY<STRUCT<i: INT, action: STRING, ret: DOUBLE>>)),
        (s, d) -> transform(
            array(named_struct('paid', IF(s.holding, s.paid, d.next_open),
                               'ret', IF(s.holding, try_divide(d.next_open - s.paid, s.paid), try_divide(d.next_open - d.next_open, d.next_open)))),
            t -> named_struct(
                'i', s.i + 1, 'holding', NOT coalesce(t.ret >= take_profit, false), 'paid', t.paid,
                'acts', CASE WHEN s.holding AND NOT coalesce(t.ret >= take_profit, false) THEN s.acts ELSE concat(s.acts,
                    IF(s.holding, array(), array(named_struct('i', s.i, 'action', 'buy', 'ret', 0D))),
                    IF(coalesce(t.ret >= take_profit, false), array(named_struct('i', s.i, 'action', 'sell', 'ret', t.ret)), array())) END))[0],
        s -> s.acts)) AS (i, action, ret)"""
    acts = series.selectExpr("scenario_id", "symbol", "days", fold).selectExpr(
        "scenario_id", "symbol", "element_at(days, i + 1) AS d", "action", "ret")
    return acts.selectExpr("scenario_id", "symbol", "d.date AS signal_date", "d.next_date AS trade_date", "action",
                           "d.next_open AS price", "d.close AS close", "ret")


def _held_value(held: dict[str, float], close: float) -> float:
    """Held shares times ``close``, added left to right in symbol order
    (Python 3.12's ``sum`` compensates rounding; plain addition is kept so
    every engine gets the same bits)."""
    acc = 0.0
    for s in sorted(held):
        acc += held[s] * close
    return acc


def _ledger_fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """One scenario: cash, share sizing and the logged value, action by action.

    Order: signal date, symbol, buy before sell. ``(cash / 3) // price`` is
    Python float floor division, as in the reference. The logged value
    values every held share at this symbol's signal-date close (the
    reference's quirk), after a buy and before a sold position is removed;
    holdings are summed in symbol order from 0.
    """
    pdf = pdf.assign(_ord=(pdf["action"] != "buy").astype("int8")).sort_values(
        ["signal_date", "symbol", "_ord"], kind="mergesort")
    cash = float(pdf["initial_cash"].iloc[0])
    fee = float(pdf["fee"].iloc[0])
    held: dict[str, float] = {}
    rows = []
    for seq, (d, td, sym, act, px, close, ret) in enumerate(zip(
            pdf["signal_date"], pdf["trade_date"], pdf["symbol"], pdf["action"],
            pdf["price"], pdf["close"], pdf["ret"])):
        if act == "buy":
            shares = max(1.0, (cash / 3) // px)
            cash -= shares * px * (1 + fee)
            held[sym] = shares
            value = cash + _held_value(held, close)
            rows.append((seq, d, td, sym, act, px, shares, cash, value, 0.0, dict(held)))
        else:
            shares = held[sym]
            cash += shares * px * (1 - fee)
            value = cash + _held_value(held, close)
            rows.append((seq, d, td, sym, act, px, shares, cash, value, ret * 100, dict(held)))
            del held[sym]
    res = pd.DataFrame(rows, columns=["seq", "signal_date", "trade_date", "symbol", "action", "price",
                                      "shares", "total_cash", "portfolio_value", "profit_percentage",
                                      "held"])
    res.insert(0, "scenario_id", pdf["scenario_id"].iloc[0])
    return res


def close_asof(points: DataFrame, bars: DataFrame) -> DataFrame:
    """J4 as a backward as-of lookup: for each (symbol, date) point, the last
    close on or before that date."""
    closes = bars.where(F.col("close").isNotNull()).select("symbol", "date", F.col("close").alias("asof_close"))
    return asof_join(points.select("symbol", "date").distinct(), closes, ["symbol"], "date")


def mark_each(log: DataFrame, bars: DataFrame) -> DataFrame:
    """SURVEY X1 ``mark="each"``: log rows with the portfolio value marking
    every held symbol at its own last close on or before the signal date
    (instead of the acting symbol's close), summed in symbol order."""
    held = log.select("scenario_id", "seq", "signal_date",
                      F.explode("held").alias("symbol", "shares"))
    marks = close_asof(held.select("symbol", F.col("signal_date").alias("date")), bars)
    valued = (held.join(marks, (held["symbol"] == marks["symbol"]) & (held["signal_date"] == marks["date"]))
              .select("scenario_id", "seq", held["symbol"], (F.col("shares") * F.col("asof_close")).alias("v")))
    per_action = valued.groupBy("scenario_id", "seq").agg(F.lit(True).alias("_holds"), F.expr(
        "aggregate(array_sort(collect_list(struct(symbol, v))), 0D, (acc, h) -> acc + h.v)").alias("_held_value"))
    return (log.join(per_action, ["scenario_id", "seq"], "left")
            .withColumn("portfolio_value", F.col("total_cash") + F.when(F.col("_holds"), F.col("_held_value")).otherwise(F.lit(0.0)))
            .drop("_held_value", "_holds"))


def ledger(actions: DataFrame, scenarios: DataFrame) -> DataFrame:
    """The action log of every scenario (one row per action, with its
    position ``seq``). shares = max(1, (cash / 3) // price); cash -=
    shares*price*(1+fee) on buy, += shares*price*(1-fee) on sell.

    A group is one scenario's action list: at most k buys per signal date,
    bounded by k x the calendar, not by data volume. Scenarios run in
    parallel tasks.
    """
    params = scenarios.select("scenario_id", "fee", "initial_cash")
    acts = actions.select("scenario_id", "symbol", "signal_date", "trade_date", "action",
                          "price", "close", "ret").join(params, "scenario_id")
    return _spread(acts, "scenario_id").groupBy("scenario_id").applyInPandas(_ledger_fold, LOG_SCHEMA)


def action_log(log: DataFrame) -> DataFrame:
    """The action log, one row per action, in log order ``seq``."""
    return log


def trade_stats(actions: DataFrame) -> DataFrame:
    """A9/A10 inputs: count, mean and population std of closed-trade returns."""
    sells = actions.where(F.col("action") == "sell")
    return sells.groupBy("scenario_id").agg(
        F.count(F.lit(1)).alias("trades"),
        F.avg("ret").alias("mean_return"),
        F.stddev_pop("ret").alias("std_return"))


def trade_sharpe(actions: DataFrame, scenarios: DataFrame) -> DataFrame:
    """A10 from the trades alone: (mean - rf) / (population std + 1e-8) of the
    closed trades' returns, 0 without trades."""
    out = scenarios.select("scenario_id", "risk_free").join(trade_stats(actions), "scenario_id", "left")
    sharpe = F.when(F.coalesce(F.col("trades"), F.lit(0)) == 0, F.lit(0.0)).otherwise(
        (F.col("mean_return") - F.col("risk_free")) / (F.col("std_return") + F.lit(1e-8)))
    return out.select("scenario_id", F.coalesce("trades", F.lit(0)).cast("bigint").alias("trades"), sharpe.alias("sharpe_ratio"))


def final_state(log: DataFrame, scenarios: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cash after the last action (initial cash without actions) and the
    shares still held: symbols whose last action is a buy."""
    last = log.groupBy("scenario_id").agg(F.max_by("total_cash", "seq").alias("cash"))
    cash = (scenarios.select("scenario_id", "initial_cash")
            .join(last, "scenario_id", "left")
            .select("scenario_id", F.coalesce("cash", "initial_cash").alias("cash")))
    per_sym = log.groupBy("scenario_id", "symbol").agg(
        F.max_by(F.struct("action", "shares"), "seq").alias("last"))
    held = per_sym.where(F.col("last.action") == "buy").select(
        "scenario_id", "symbol", F.col("last.shares").alias("shares"))
    return cash, held


def portfolio_summary(log: DataFrame, actions: DataFrame, bars: DataFrame,
                      scenarios: DataFrame) -> DataFrame:
    """Final value (cash + held shares at each symbol's last
    close over the whole price frame), net profit, ROI %, trade Sharpe
    ((mean - rf) / (population std + 1e-8), 0 without trades)."""
    cash, held = final_state(log, scenarios)
    held = held.join(last_close(bars), "symbol")
    # Sum in symbol order from 0, like the reference's Python sum.
    # A held symbol without a last close leaves the sum NULL: not a worthless one.
    marks = held.groupBy("scenario_id").agg(F.lit(True).alias("holds"), F.expr(
        "aggregate(array_sort(collect_list(struct(symbol, shares * last_close AS v))), 0D, "
        "(acc, h) -> acc + h.v)").alias("held_value"))
    stats = trade_sharpe(actions, scenarios)
    p = scenarios.select("scenario_id", "initial_cash")
    out = (cash.join(p, "scenario_id")
           .join(marks, "scenario_id", "left")
           .join(stats, "scenario_id"))
    final = F.col("cash") + F.when(F.col("holds"), F.col("held_value")).otherwise(F.lit(0.0))
    net = final - F.col("initial_cash")
    return out.select(
        "scenario_id",
        final.alias("final_portfolio_value"),
        net.alias("net_profit"),
        (net / F.col("initial_cash") * 100).alias("roi"),
        "sharpe_ratio",
        "trades",
    )


def top_actions(log: DataFrame, n: int = 5, by: str | None = None) -> DataFrame:
    """T6 (``by=None``: the first n actions) and T7 (``by="profit_percentage"``:
    the n most profitable, ties in log order), per scenario."""
    from pyspark.sql import Window
    order = [F.col("seq")] if by is None else [F.desc(by), F.col("seq")]
    w = Window.partitionBy("scenario_id").orderBy(*order)
    return log.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)


def run_backtest(preds: DataFrame, bars: DataFrame, scenarios: DataFrame,
                 mark: str = "reference") -> dict[str, DataFrame]:
    """B1-B12 for every scenario in one job.

    ``preds``: (date, symbol, predicted_return[, scenario_id]); ``bars``:
    daily (or weekly) bars with open/close. Returns the stages as DataFrames:
    ``tradable``, ``actions``, ``log``, ``summary``. ``mark="each"`` values
    the logged portfolio at each held symbol's own close (SURVEY X1); the
    default keeps the reference's quirk.
    """
    tradable = tradable_signals(ranked_scenarios(preds, scenarios), bars)
    # The action list and the per-scenario ledger are small (bounded by
    # k x signal dates per scenario) and each is read by two consumers.
    actions = trade_pairs(tradable).persist(StorageLevel.MEMORY_AND_DISK)
    led = ledger(actions, scenarios).persist(StorageLevel.MEMORY_AND_DISK)
    log = mark_each(led, bars) if mark == "each" else led
    return {
        "tradable": tradable,
        "actions": actions,
        "log": log.drop("held"),
        "summary": portfolio_summary(led, actions, bars, scenarios),
    }


def scenario_sweep(signals: DataFrame, bars: DataFrame, scenarios: DataFrame) -> DataFrame:
    """M7: one summary row per scenario, all scenarios in one job."""
    return run_backtest(signals, bars, scenarios)["summary"]


def best_scenario(summary: DataFrame, metric: str = "roi",
                  group: Sequence[str] = ()) -> DataFrame:
    """Per group, the scenario with the highest metric (ties: the
    smallest id). Two aggregates and an equi-join on the group keys (a
    constant key when ungrouped); no global ordering."""
    g = list(group) or ["_all"]
    s = summary if group else summary.withColumn("_all", F.lit(0))
    best = s.groupBy(*g).agg(F.max(metric).alias("_best"))
    hits = s.join(best, g).where(F.col(metric) == F.col("_best"))
    out = hits.groupBy(*g).agg(F.min("scenario_id").alias("scenario_id"),
                               F.first("_best").alias("metric"))
    return out if group else out.drop("_all")
