"""Benchmark-index return and its join onto every symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwise.functions import ts


def benchmark_return(bars: DataFrame, symbol: str) -> DataFrame:
    """the benchmark's daily return in percent (pct_change x 100).

    One symbol's daily series: at most one row per calendar day.
    """
    one = bars.where(F.col("symbol") == symbol).select("symbol", "date", "adj_close")
    return one.select("date", (ts.pct_change("adj_close") * 100).alias("benchmark_return"))


def with_benchmark_return(bars: DataFrame, symbol: str) -> DataFrame:
    """Left-join the benchmark return onto the other symbols by date.

    The benchmark side holds one row per calendar day (the key is
    (symbol, date) and it is one symbol), a bound fixed by the calendar span
    and independent of data volume, so it is broadcast and the bar side is
    never shuffled for this join.
    """
    others = bars.where(F.col("symbol") != symbol)
    return others.join(F.broadcast(benchmark_return(bars, symbol)), "date", "left")
