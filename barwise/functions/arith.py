"""Scalar helpers that keep pandas' float semantics under Spark's ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def ieee_div(a, b) -> Column:
    """IEEE-754 division: NULL operand -> NULL; x/0 -> +/-inf; 0/0 -> NULL.

    ANSI mode raises on a zero divisor and ``try_divide`` returns NULL where
    pandas returns inf, so every ratio in the library goes through here. The
    NULL test comes first: a NULL divisor would otherwise fall through
    ``b != 0`` into the infinity branch.
    """
    a, b = _c(a), _c(b)
    return (
        F.when(a.isNull() | b.isNull(), F.lit(None).cast("double"))
        .when(b != 0, a.cast("double") / b.cast("double"))
        .when(a > 0, F.lit(float("inf")))
        .when(a < 0, F.lit(float("-inf")))
        .otherwise(F.lit(None).cast("double"))
    )


def nan_to_null(c) -> Column:
    """Map NaN to NULL (ingestion policy: pandas skips NaN, Spark ranks it highest)."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)
