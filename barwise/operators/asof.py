"""As-of joins in time buckets.

Each row of the left side gets the last row of the right side at or before its
time (backward), or the first at or after it (forward), per key. Both sides are
cut into buckets of time: within a bucket one ordered pass over the union of both
sides finds the match, and what a bucket can't know, the last right row of an
earlier bucket, comes from a pass over one summary row per bucket. So a hot key
splits over tasks by time, and no range join or pair list is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Days of a bucket. A key's summaries are as many as the calendar has buckets.
BUCKET_DAYS = 64


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], on: str, right_on: str | None = None,
              forward: bool = False, strict: bool = False, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """All rows and columns of ``left``, with the matching right row's other
    columns (NULL without a match).

    ``on`` is a date or timestamp; ``strict`` excludes equal times. Keys match
    as in an equi-join: a NULL key or time has no match. Of right rows with equal
    key and time the one whose values sort last (first, if forward) is taken.
    Right columns that the left has too must be renamed before.
    """
    right_on = right_on or on
    values = [c for c in right.columns if c not in (*by, right_on)] + ([right_on] if right_on != on else [])
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    usable = F.expr(" AND ".join(f"`{c}` IS NOT NULL" for c in by))
    bucket = lambda c: F.floor(F.datediff(F.col(c).cast("date"), F.lit("1970-01-01").cast("date")) / bucket_days)
    # a left row that excludes equal times comes on their other side
    rank = (1 if strict else -1) * (1 if forward else -1)
    row = F.struct(F.col(right_on).alias("_at"), *[F.col(c) for c in values if c != right_on])
    points = left.select(*by, F.col(on).alias("_time"), F.lit(rank).alias("_rank"), bucket(on).alias("_bucket"),
                         F.struct(*left.columns).alias("_left"), F.lit(True).alias("_is_left"))
    rows = right.where(usable & F.col(right_on).isNotNull()).select(
        *by, F.col(right_on).alias("_time"), F.lit(0).alias("_rank"), bucket(right_on).alias("_bucket"), row.alias("_row"),
        F.lit(False).alias("_is_left"))
    both = points.unionByName(rows, allowMissingColumns=True)
    order = [F.col("_time"), F.col("_rank"), F.col("_row")]
    window = Window.partitionBy(*by, "_bucket").orderBy(*order)
    if forward:
        found = F.first("_row", ignorenulls=True).over(window.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        edge, carried = F.min("_row"), F.first("_edge", ignorenulls=True)
        beyond = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(1, Window.unboundedFollowing)
    else:
        found = F.last("_row", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        edge, carried = F.max("_row"), F.last("_edge", ignorenulls=True)
        beyond = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    summary = (both.where(usable & F.col("_bucket").isNotNull()).groupBy(*by, "_bucket").agg(edge.alias("_edge"))
               .withColumn("_carry", carried.over(beyond)).where("_carry IS NOT NULL").select(*by, "_bucket", "_carry"))
    matched = both.withColumn("_found", found).where("_is_left").select(*by, "_bucket", "_left", "_found")
    known = usable & F.col("_bucket").isNotNull()
    out = matched.join(summary, [*by, "_bucket"], "left").withColumn("_hit", F.when(known, F.coalesce("_found", "_carry")))
    return out.select("_left.*", *[F.col("_hit")["_at" if c == right_on else c].alias(c) for c in values])
