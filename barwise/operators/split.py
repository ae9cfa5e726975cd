"""Complete rows, period split and split counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The reference's bounds are 2012/2020/2023/2024; the bar fixture spans
# 1995-2001, so the defaults are shifted onto it (train, test, validation,
# prediction start dates).
DEFAULT_BOUNDS = ("1995-06-01", "1999-01-01", "2000-01-01", "2001-01-01")
PERIODS = ("train", "test", "validation", "prediction")


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None,
                    keep_unlabelled: bool = False) -> DataFrame:
    """Drop rows with any NULL or NaN (infinities are kept).

    ``keep_unlabelled=True`` (SURVEY X1) ignores the label column, so the
    newest week, whose next-week return is unknown, can still be scored."""
    cols = list(subset) if subset else df.columns
    if keep_unlabelled:
        cols = [c for c in cols if c != "next_weekly_return"]
    return df.na.drop(how="any", subset=cols)


def period_of(date: Column, bounds: Sequence[str] = DEFAULT_BOUNDS) -> Column:
    """Half-open periods [b0,b1) train, [b1,b2) test, [b2,b3) validation,
    [b3, inf) prediction; rows before b0 get NULL."""
    b = [F.lit(x).cast("date") for x in bounds]
    return (F.when(date < b[0], F.lit(None).cast("string"))
            .when(date < b[1], F.lit(PERIODS[0]))
            .when(date < b[2], F.lit(PERIODS[1]))
            .when(date < b[3], F.lit(PERIODS[2]))
            .otherwise(F.lit(PERIODS[3])))


def split_periods(df: DataFrame, bounds: Sequence[str] = DEFAULT_BOUNDS,
                  split: bool = True) -> DataFrame:
    """Tag each row with its period (one DataFrame, a ``period``
    column; filters derive the four frames and prune by the date predicate).
    ``split=False`` returns the frame unchanged."""
    if not split:
        return df
    return df.withColumn("period", period_of(F.col("date"), bounds))


def period_frame(df: DataFrame, period: str, bounds: Sequence[str] = DEFAULT_BOUNDS) -> DataFrame:
    """One period as a date-range filter (pushed into scans where possible)."""
    i = PERIODS.index(period)
    d = F.col("date")
    cond = d >= F.lit(bounds[i]).cast("date")
    if i + 1 < len(bounds):
        cond = cond & (d < F.lit(bounds[i + 1]).cast("date"))
    return df.where(cond)


def period_counts(df: DataFrame) -> DataFrame:
    """Rows and symbols per period."""
    return (df.where(F.col("period").isNotNull())
            .groupBy("period")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_distinct("symbol").alias("symbols")))
