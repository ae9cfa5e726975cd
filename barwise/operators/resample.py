"""Weekly OHLCV resample on a Friday grid.

Plan shape: one hash Exchange on the symbol, then the weekly aggregate, the
gap fill, the EMA pass and every feature window run inside that partitioning
(no further Exchange). A symbol's daily series is bounded by the calendar
(one row per trading day), so a symbol-sized task never grows with volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwise.session import task_partitions

WEEKDAY = {"MON": 0, "TUE": 1, "WED": 2, "THU": 3, "FRI": 4, "SAT": 5, "SUN": 6}
PRICES = ["open", "high", "low", "close", "adj_close"]


def week_end(date: Column | str, week_end_day: str = "FRI") -> Column:
    """Label of the week (end day, inclusive) that holds ``date``:
    bins are (prev end, end], so a Friday maps to itself and Saturday to the
    next Friday."""
    d = F.col(date) if isinstance(date, str) else date
    return F.date_add(d, F.pmod(F.lit(WEEKDAY[week_end_day]) - F.weekday(d), F.lit(7)))


def weekly_aggregate(bars: DataFrame, week_end_day: str = "FRI", key: str = "symbol",
                     cluster: bool = True) -> DataFrame:
    """Aggregate each symbol's daily bars into labelled weeks.

    open = first non-NULL open by date, close/adj_close = last non-NULL by
    date (``min_by``/``max_by`` ignore NULL orderings, which makes them
    deterministic, unlike ``first``/``last``), high = max, low = min,
    volume = sum (0 when the week has no volume).
    """
    if cluster:
        # An explicit partition count: the weekly rows are few bytes but carry
        # the heavy window/EMA chain, which AQE's size-based coalescing would
        # otherwise squeeze into a handful of tasks.
        bars = bars.repartition(task_partitions(bars.sparkSession), key)
    d = F.col("date")

    def valid_date(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), d)

    return bars.groupBy(key, week_end(d, week_end_day).alias("date")).agg(
        F.min_by("open", valid_date("open")).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", valid_date("close")).alias("close"),
        F.max_by("adj_close", valid_date("adj_close")).alias("adj_close"),
        F.coalesce(F.sum("volume"), F.lit(0)).cast("bigint").alias("volume"),
    )


def fill_week_gaps(weekly: DataFrame, key: str = "symbol") -> DataFrame:
    """Add the empty weeks between a symbol's first and last week
    (prices NULL, volume 0).

    Each week emits itself plus the empty weeks up to its successor
    (``lead`` + ``sequence`` + ``explode``), so the grid is generated
    inside the symbol partitioning: no join, no union, no extra shuffle.
    """
    nxt = weekly.selectExpr("*", f"lead(date) OVER (PARTITION BY {key} ORDER BY date) AS _next")
    exploded = nxt.selectExpr(
        "*",
        "explode(concat(array(date), CASE WHEN _next > date_add(date, 7) "
        "THEN sequence(date_add(date, 7), date_sub(_next, 7), INTERVAL 7 DAYS) "
        "ELSE CAST(array() AS array<date>) END)) AS _wk")
    return exploded.selectExpr(
        key, "_wk AS date",
        *[f"CASE WHEN _wk = date THEN {c} END AS {c}" for c in PRICES],
        "CAST(CASE WHEN _wk = date THEN volume ELSE 0 END AS BIGINT) AS volume")


def resample_ohlcv(bars: DataFrame, week_end_day: str = "FRI", key: str = "symbol",
                   cluster: bool = True) -> DataFrame:
    """Weekly bars ``symbol, date, open, high, low, close, adj_close,
    volume`` on a gap-free weekly grid per symbol."""
    return fill_week_gaps(weekly_aggregate(bars, week_end_day, key, cluster), key)
