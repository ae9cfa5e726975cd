"""Per-date top-k signals and their tradability."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topk_signals(preds: DataFrame, k: int | str = 5, score: str = "predicted_return",
                 by: tuple[str, ...] = ("scenario_id",), k_max: int | None = None) -> DataFrame:
    """T5/B1: the k best symbols per (scenario, date) by score.

    NULL scores come last and fill the k places when fewer rows have a score
    (as pandas ``DataFrame.nlargest`` keeps NaN rows last); ties go to the
    smaller symbol. ``k`` may be an int or the name of a per-row column
    (one k per scenario, then ``k_max`` bounds it). A literal bound makes
    ``row_number() <= k`` a window group limit: each map task keeps only the
    top rows per (scenario, date) before the shuffle, so a date with a
    million symbols moves k rows per task, not a million.
    """
    keys = [c for c in by if c in preds.columns] + ["date"]
    w = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(score), F.asc("symbol"))
    ranked = preds.withColumn("rank", F.row_number().over(w))
    if isinstance(k, int):
        return ranked.where(F.col("rank") <= F.lit(k))
    if k_max is not None:
        ranked = ranked.where(F.col("rank") <= F.lit(int(k_max)))
    return ranked.where(F.col("rank") <= F.col(k))


def with_next_bar(bars: DataFrame) -> DataFrame:
    """Each bar with the symbol's next bar (strictly later date).

    Not a range join: the trade needs the same-day bar anyway (J2), so the
    next bar is ``lead`` over the symbol's own series and the match becomes an
    equi-join on (symbol, date).
    """
    w = Window.partitionBy("symbol").orderBy("date")
    return bars.select(
        "symbol", "date", "open", "close",
        F.lead("date").over(w).alias("next_date"),
        F.lead("open").over(w).alias("next_open"),
    )


def tradable_signals(top: DataFrame, bars: DataFrame) -> DataFrame:
    """Top-k signals that have a bar on the signal date (J2) and a
    later bar (J3); the execution price/date are the next bar's open/date,
    and the signal-date close (J4) is carried for the logged value."""
    nxt = with_next_bar(bars).where(F.col("next_date").isNotNull())
    return top.join(nxt, ["symbol", "date"], "inner")


def last_close(bars: DataFrame) -> DataFrame:
    """The latest close per symbol (final mark-to-market)."""
    return bars.groupBy("symbol").agg(F.max_by("close", "date").alias("last_close"))
