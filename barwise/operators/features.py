"""Technical-indicator features of weekly bars.

All windows share one specification (``symbol`` ordered by ``date``), so the
chain plans as one Sort over the symbol partitioning produced by the resample;
the recursive EMAs run first, composed from maps of calendar blocks. ``p`` is
adj_close, ``v`` volume; every ratio is ``ieee_div``.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.functions import ts
from barwise.functions.arith import ieee_div
from barwise.functions.ewm import add_emas

# EMA spans of the reference's MACD family (output, input, span).
EMA_SPECS = [
    ("ema12", "adj_close", 12.0),
    ("ema26", "adj_close", 26.0),
    ("macd_short", "adj_close", 6.0),
    ("macd_long", "adj_close", 19.0),
    ("signal_line", "macd", 9.0),
]

# Model inputs in the reference's order (fixed values; %K/%D renamed, lower-cased).
MODEL_FEATURES = [
    "adj_close", "volume", "weekly_price_diff", "range", "gap", "volatility",
    "volume_ma", "volume_ratio", "rsi_2w", "normalized_rsi_2w",
    "momentum_4w", "momentum_8w", "ema12", "ema26", "macd", "signal_line",
    "macd_distance", "macd_short", "macd_long", "macd_diff", "low14",
    "high14", "stoch_k", "stoch_d", "stochastic_k_d_distance", "obv", "vwap",
    "vwap_distance", "hl", "hc", "lc", "tr", "atr", "atr_percentage",
    "pivot", "pivot_distance", "support_distance", "resistance_distance",
    "weekly_return", "adj_close_lag_1w",
    "volume_lag_1w", "weekly_return_lag_1w", "adj_close_lag_2w",
    "volume_lag_2w", "weekly_return_lag_2w", "adj_close_lag_3w",
    "volume_lag_3w", "weekly_return_lag_3w", "adj_close_lag_4w",
    "volume_lag_4w", "weekly_return_lag_4w", "price_to_range_ratio",
    "volume_change", "adj_close_change", "momentum_2w",
    "weekly_return_lag_5w", "weekly_return_lag_6w", "weekly_return_lag_7w",
    "weekly_return_lag_8w", "rolling_mean_4w", "rolling_std_4w",
    "bollinger_upper", "bollinger_lower", "bollinger_bandwidth",
    "rolling_skew_4w", "rolling_kurt_4w", "sharpe_ratio", "day_of_week",
    "week_of_year", "month",
]
LABEL = "next_weekly_return"


def _c(name: str) -> Column:
    return F.col(name)


# SQL-expression helpers for the staged feature chain. A stage is handed to
# ``selectExpr`` as text, which the JVM parses in one go; building the same
# expressions as Column objects costs thousands of driver round trips.
_W = "PARTITION BY symbol ORDER BY date"
_INF = "CAST('Infinity' AS DOUBLE)"


def _over(frame: str = "") -> str:
    return f"OVER ({_W}{(' ' + frame) if frame else ''})"


def _rows(n: int) -> str:
    return _over(f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")


_EXP = _over("ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
_ALL = _over("ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")


def div_sql(a: str, b: str) -> str:
    """``ieee_div`` as SQL text (operands should be column names)."""
    return (f"(CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN ({b}) != 0 THEN CAST(({a}) AS DOUBLE) / CAST(({b}) AS DOUBLE) "
            f"WHEN ({a}) > 0 THEN {_INF} WHEN ({a}) < 0 THEN -{_INF} "
            f"ELSE CAST(NULL AS DOUBLE) END)")


def _gated(n: int, x: str, agg: str) -> str:
    return f"CASE WHEN count({x}) {_rows(n)} >= {n} THEN {agg}({x}) {_rows(n)} END"


def add_window_features(df: DataFrame, causal: bool = False) -> DataFrame:
    """F1-F10, F19-F24, F27-F69 (everything but the EMAs and VWAP).

    Built as a few stages in which every window result is a named column and
    every ratio divides plain column references: expressions stay small
    (``ieee_div`` repeats its operands) and each window function is evaluated
    once. All stages share one window spec, so Catalyst plans a single Sort
    and no Exchange beyond the input's.
    """
    # causal=True: the whole-history constants F1, F2, F4, F51
    # use the history up to each row instead of the symbol's full history.
    hist = _EXP if causal else _ALL
    n4 = 4
    skew_c = (n4 * (n4 - 1)) ** 0.5 / (n4 - 2)
    kurt_a = (n4 + 1) * (n4 - 1) / ((n4 - 2) * (n4 - 3))
    kurt_b = 6 * (n4 - 1) / ((n4 - 2) * (n4 - 3))
    # Stage 1: windows over the bar columns.
    s1 = df.selectExpr(
        "*",
        f"lag(adj_close) {_over()} AS _lag_p",
        f"lag(open) {_over()} AS _lag_open",
        f"lag(volume) {_over()} AS _lag_v",
        f"last(adj_close, true) {_EXP} AS _ffp",
        f"first(open, true) {hist} AS _first_open",
        f"last(adj_close, true) {hist} AS _last_p",
        f"max(high) {hist} AS _max_high",
        f"min(low) {hist} AS _min_low",
        f"avg(volume) {_rows(4)} AS volume_ma",
        f"{_gated(14, 'adj_close', 'min')} AS low14",
        f"{_gated(14, 'adj_close', 'max')} AS high14",
        f"{_gated(4, 'adj_close', 'avg')} AS rolling_mean_4w",
        f"{_gated(4, 'adj_close', 'stddev_samp')} AS rolling_std_4w",
        *[f"lag(adj_close, {k}) {_over()} AS adj_close_lag_{k}w" for k in range(1, 5)],
        *[f"lag(volume, {k}) {_over()} AS volume_lag_{k}w" for k in range(1, 5)],
        f"lag(adj_close, 8) {_over()} AS _lag8_p",
    )
    # Stage 2: row arithmetic on stage-1 columns.
    s2 = s1.selectExpr(
        "*",
        "_last_p - _first_open AS weekly_price_diff",
        "_max_high - _min_low AS range",
        "open - _lag_open AS gap",
        "adj_close - _lag_p AS _d1",
        "adj_close - adj_close_lag_4w AS momentum_4w",
        "adj_close - _lag8_p AS momentum_8w",
        "adj_close - adj_close_lag_2w AS momentum_2w",
        f"{div_sql('volume', '_lag_v')} - 1.0D AS volume_change",
        f"{div_sql('volume', 'volume_ma')} AS volume_ratio",
        "adj_close - low14 AS _p_low", "high14 - low14 AS _hl14",
        "high - low AS hl",
        "abs(high - _lag_p) AS hc",
        "abs(low - _lag_p) AS lc",
        "(high + low + adj_close) / 3 AS pivot",
        "rolling_mean_4w + 2 * rolling_std_4w AS bollinger_upper",
        "rolling_mean_4w - 2 * rolling_std_4w AS bollinger_lower",
        "weekday(date) AS day_of_week",
        "weekofyear(date) AS week_of_year",
        "month(date) AS month",
    )
    # Stage 3: windows over stage-2 columns and their arithmetic.
    s3 = s2.selectExpr(
        "*",
        f"{div_sql('_p_low', '_hl14')} * 100 AS stoch_k",
        f"lag(_ffp) {_over()} AS _lag_ffp",
        f"sum(coalesce(signum(_d1) * volume, 0.0D)) {_EXP} AS obv",
        f"avg(CASE WHEN _d1 IS NOT NULL THEN greatest(_d1, 0.0D) END) {_rows(2)} AS _ag",
        f"avg(CASE WHEN _d1 IS NOT NULL THEN -least(_d1, 0.0D) END) {_rows(2)} AS _al",
        "greatest(hl, hc, lc) AS tr",
        f"{div_sql('range', '_first_open')} AS volatility",
        f"{div_sql('adj_close', 'range')} AS price_to_range_ratio",
        "adj_close - pivot AS pivot_distance",
        "adj_close - (2 * pivot - high) AS support_distance",
        "adj_close - (2 * pivot - low) AS resistance_distance",
        "bollinger_upper - bollinger_lower AS _band",
    )
    s4 = s3.selectExpr(
        "*",
        f"{div_sql('_ffp', '_lag_ffp')} - 1.0D AS weekly_return",
        f"{div_sql('_ag', '_al')} AS _rs",
        f"{_gated(3, 'stoch_k', 'avg')} AS stoch_d",
        f"{_gated(14, 'tr', 'avg')} AS atr",
        f"{div_sql('_band', 'rolling_mean_4w')} AS bollinger_bandwidth",
    )
    s5 = s4.selectExpr(
        "*",
        f"lead(weekly_return) {_over()} AS {LABEL}",
        *[f"lag(weekly_return, {k}) {_over()} AS weekly_return_lag_{k}w" for k in range(1, 9)],
        "weekly_return AS adj_close_change",
        f"CASE WHEN count(weekly_return) {_rows(4)} >= 4 THEN coalesce(skewness(weekly_return) "
        f"{_rows(4)} * {skew_c!r}D, 0.0D) END AS rolling_skew_4w",
        f"CASE WHEN count(weekly_return) {_rows(4)} >= 4 THEN coalesce(kurtosis(weekly_return) "
        f"{_rows(4)} * {kurt_a!r}D + {kurt_b!r}D, -3.0D) END AS rolling_kurt_4w",
        f"{div_sql('weekly_return', 'rolling_std_4w')} AS sharpe_ratio",
        f"CASE WHEN _rs IS NULL THEN CAST(NULL AS DOUBLE) WHEN _rs = {_INF} THEN 100.0D "
        "ELSE 100.0D - 100.0D / (1.0D + _rs) END AS rsi_2w",
        "stoch_k - stoch_d AS stochastic_k_d_distance",
        f"{div_sql('atr', 'adj_close')} * 100 AS atr_percentage",
    )
    keep = [c for c in s5.columns if not c.startswith("_")]
    return s5.selectExpr(*keep, "(rsi_2w - 30) / (70 - 30) AS normalized_rsi_2w")


def rsi(c: Column, n: int = 2) -> Column:
    """F7 as a single expression (for ad-hoc use; the feature chain stages it).

    Mean gain/loss over n rows (min_periods=1); loss 0 with a gain gives
    100; no movement at all gives NULL (0/0)."""
    delta = ts.diff(c)
    gain = F.when(delta.isNotNull(), F.greatest(delta, F.lit(0.0)))
    loss = F.when(delta.isNotNull(), -F.least(delta, F.lit(0.0)))
    ag = ts.rolling(gain, n, "mean", min_periods=1)
    al = ts.rolling(loss, n, "mean", min_periods=1)
    rs = ieee_div(ag, al)
    return (F.when(rs.isNull(), F.lit(None).cast("double"))
            .when(rs == float("inf"), F.lit(100.0))
            .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + rs)))


def add_ema_features(df: DataFrame) -> DataFrame:
    """The EMAs of the price, then that of their difference."""
    out = add_emas(df, [s for s in EMA_SPECS if s[1] == "adj_close"])
    out = add_emas(out.selectExpr("*", "ema12 - ema26 AS macd"), [s for s in EMA_SPECS if s[1] == "macd"])
    return out.selectExpr("*", "macd - signal_line AS macd_distance", "macd_short - macd_long AS macd_diff")


MAX_SYMBOL_BUCKETS = 1024


def symbol_prefix(totals: DataFrame, cols: dict[str, str], buckets: int = MAX_SYMBOL_BUCKETS) -> DataFrame:
    """Exclusive prefix sums over symbols in symbol order: for each symbol,
    the sum of ``cols`` (input -> output name) over all smaller symbols.

    Two levels, so no task sees every symbol: the ``buckets`` symbols of least
    hash become range boundaries (one array, a scalar subquery of the same
    plan), each symbol gets the bucket of its range, the ordered pass runs over
    the bucket totals only (at most ``buckets`` + 1 rows), and the prefix within
    a bucket is a window per bucket. Nothing runs before the action.
    """
    some = totals.select(F.col("symbol").alias("_s")).filter("_s IS NOT NULL").orderBy(F.xxhash64("_s"), "_s").limit(buckets)
    bounds = some.agg(F.sort_array(F.collect_list("_s")).alias("bounds")).scalar()
    below = F.size(F.filter("_bounds", lambda b: b <= F.col("symbol")))
    tb = (totals.withColumn("_bounds", bounds).withColumn("_bucket", F.when(F.col("symbol").isNull(), -1).otherwise(below))
          .drop("_bounds"))
    sums = {c: f"_b{c}" for c in cols}
    per_bucket = tb.groupBy("_bucket").agg(*[F.sum(c).alias(sums[c]) for c in cols])
    before_b = "OVER (ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    bucket_off = per_bucket.selectExpr(
        "_bucket", *[f"coalesce(sum({sums[c]}) {before_b}, 0) AS _bo{c}" for c in cols])
    before_s = ("OVER (PARTITION BY _bucket ORDER BY symbol "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    within = tb.selectExpr("symbol", "_bucket",
                           *[f"coalesce(sum({c}) {before_s}, 0) AS _wo{c}" for c in cols])
    return within.join(F.broadcast(bucket_off), "_bucket").selectExpr(
        "symbol", *[f"_bo{c} + _wo{c} AS {out}" for c, out in cols.items()])


def cumulative_vwap(df: DataFrame, scope: str = "global", bars: DataFrame | None = None) -> DataFrame:
    """running sum(p*v) / sum(v).

    ``scope="global"`` reproduces the reference: ONE running sum over all
    symbols in (symbol, date) order. A global ordered window would move every
    row to one task; instead each symbol's totals (one row per symbol) get a
    running offset over symbols (``symbol_prefix``: an ordered pass over at
    most 1,025 bucket totals plus per-bucket windows), which is added to the
    symbol's own running sums. The offsets join back on the symbol without shuffling the bar side
    (it is already partitioned by symbol; AQE broadcasts the offsets when
    they are small). ``bars`` may give the same rows by a shorter plan, for the
    totals. ``scope="symbol"`` is the causal, per-symbol variant.
    """
    pv = "CASE WHEN adj_close IS NOT NULL THEN adj_close * volume END"
    run = df.selectExpr("*", f"sum({pv}) {_EXP} AS _run_pv", f"sum(volume) {_EXP} AS _run_v")
    if scope == "symbol":
        out = run.selectExpr(
            "*", f"CASE WHEN adj_close IS NOT NULL THEN {div_sql('_run_pv', '_run_v')} END AS vwap")
    else:
        totals = (df if bars is None else bars).groupBy("symbol").agg(
            F.expr(f"coalesce(sum({pv}), 0.0D)").alias("_tpv"),
            F.expr("coalesce(sum(volume), 0L)").alias("_tv"))
        offsets = symbol_prefix(totals, {"_tpv": "_opv", "_tv": "_ov"})
        out = run.join(offsets, "symbol").selectExpr(
            "*", "_opv + _run_pv AS _num", "_ov + _run_v AS _den").selectExpr(
            "*", f"CASE WHEN adj_close IS NOT NULL THEN {div_sql('_num', '_den')} END AS vwap")
    out = out.selectExpr("*", "adj_close - vwap AS vwap_distance")
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def add_features(weekly: DataFrame, vwap_scope: str = "global",
                 materialize: bool = True, causal: bool = False) -> DataFrame:
    """F1-F69 over weekly bars (one row per symbol and week).

    The global VWAP and the EMAs need the weekly bars twice (totals and
    rows). Spark prunes the consumers differently, so
    their shuffles would not be shared and the whole upstream (scan, join,
    daily and weekly aggregates) would run twice. ``materialize`` persists
    the weekly bars (memory, spilling to disk; a lost block is recomputed
    from lineage) so the upstream runs once. A cached plan keeps its
    hash-by-symbol partitioning, so the windows and the per-symbol totals add
    no Exchange over the weekly rows. The EMAs come first, on the narrow rows;
    the small tables of block entries and offsets are joined by key. ``causal=True`` replaces the look-ahead features
    (whole-history constants, the all-symbol VWAP) by causal ones.
    """
    if causal:  # SURVEY X1: no look-ahead anywhere
        vwap_scope = "symbol"
    if materialize and vwap_scope == "global":
        weekly = weekly.persist(StorageLevel.MEMORY_AND_DISK)
    df = cumulative_vwap(add_ema_features(weekly), vwap_scope, weekly)
    return add_window_features(df, causal)


def feature_columns() -> list[str]:
    return MODEL_FEATURES + [LABEL]
