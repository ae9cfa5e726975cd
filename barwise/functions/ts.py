"""Generic per-symbol time-series building blocks.

Every function returns a Column over the window ``by(symbol) order by(date)``
so that a whole feature chain shares ONE window specification: Catalyst then
plans one Exchange (hash on the symbol) and one Sort for all of them, and each
symbol's series is streamed by WindowExec (which spills) rather than held.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from barwise.functions.arith import _c, ieee_div

SYMBOL = "symbol"
DATE = "date"


def series(key: str = SYMBOL, order: str = DATE) -> WindowSpec:
    """W: rows of one symbol in date order."""
    return Window.partitionBy(key).orderBy(order)


def trailing(n: int, key: str = SYMBOL, order: str = DATE) -> WindowSpec:
    """Wk(n): the current row and the n-1 rows before it."""
    return series(key, order).rowsBetween(-(n - 1), Window.currentRow)


def expanding(key: str = SYMBOL, order: str = DATE) -> WindowSpec:
    """From the first row of the symbol up to the current row."""
    return series(key, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def whole(key: str = SYMBOL, order: str = DATE) -> WindowSpec:
    """All rows of the symbol (ordered, so first/last are well defined)."""
    return series(key, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def shift(c, n: int = 1, key: str = SYMBOL) -> Column:
    """pandas ``shift(n)``: positive n looks back, negative looks ahead."""
    w = series(key)
    return F.lag(_c(c), n).over(w) if n >= 0 else F.lead(_c(c), -n).over(w)


def diff(c, n: int = 1, key: str = SYMBOL) -> Column:
    """pandas ``diff(n)``."""
    return _c(c) - shift(c, n, key)


def ffill(c, key: str = SYMBOL) -> Column:
    """Forward fill within the symbol (leading NULLs stay NULL)."""
    return F.last(_c(c), ignorenulls=True).over(expanding(key))


def pct_change(c, n: int = 1, key: str = SYMBOL, fill: bool = True) -> Column:
    """pandas 2.x ``pct_change``: forward-fill, then x / x.shift(n) - 1.

    Division follows IEEE rules (x/0 -> inf), like pandas.
    """
    filled = ffill(c, key) if fill else _c(c)
    prev = F.lag(filled, n).over(series(key))
    return ieee_div(filled, prev) - F.lit(1.0)


def cumsum(c, key: str = SYMBOL) -> Column:
    """pandas ``cumsum``: NULL rows stay NULL, the running total skips them."""
    c = _c(c)
    return F.when(c.isNotNull(), F.sum(c).over(expanding(key)))


_AGGS = {
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "std": F.stddev_samp,
    "var": F.var_samp,
}


def rolling(c, n: int, agg: str = "mean", min_periods: int | None = None,
            key: str = SYMBOL) -> Column:
    """pandas ``rolling(n, min_periods).agg()`` over the last n rows.

    Spark frames have no minimum, so the result is gated on the number of
    non-NULL values in the frame; ``min_periods`` defaults to n as in pandas.
    """
    c = _c(c)
    w = trailing(n, key)
    need = n if min_periods is None else min_periods
    value = _AGGS[agg](c).over(w)
    return F.when(F.count(c).over(w) >= need, value)


def rolling_skew(c, n: int = 4, key: str = SYMBOL) -> Column:
    """Bias-corrected sample skewness over n rows (pandas ``rolling().skew()``).

    Spark's ``skewness`` is the population g1 and is NULL on a constant frame,
    where pandas reports 0.
    """
    c = _c(c)
    w = trailing(n, key)
    corr = (n * (n - 1)) ** 0.5 / (n - 2)
    value = F.coalesce(F.skewness(c).over(w) * F.lit(corr), F.lit(0.0))
    return F.when(F.count(c).over(w) >= n, value)


def rolling_kurt(c, n: int = 4, key: str = SYMBOL) -> Column:
    """Bias-corrected excess kurtosis over n rows (pandas ``rolling().kurt()``).

    G2 = ((n+1) g2 + 6)(n-1) / ((n-2)(n-3)); a constant frame gives -3.
    """
    c = _c(c)
    w = trailing(n, key)
    a = (n + 1) * (n - 1) / ((n - 2) * (n - 3))
    b = 6 * (n - 1) / ((n - 2) * (n - 3))
    # A constant frame has undefined g2 (Spark: NULL); pandas returns -3 there.
    value = F.coalesce(F.kurtosis(c).over(w) * F.lit(a) + F.lit(b), F.lit(-3.0))
    return F.when(F.count(c).over(w) >= n, value)


def first_valid(c, key: str = SYMBOL) -> Column:
    """First non-NULL value of the symbol's whole history."""
    return F.first(_c(c), ignorenulls=True).over(whole(key))


def last_valid(c, key: str = SYMBOL) -> Column:
    """Last non-NULL value of the symbol's whole history."""
    return F.last(_c(c), ignorenulls=True).over(whole(key))
