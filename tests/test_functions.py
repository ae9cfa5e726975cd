"""Golden micro-cases (FIXTURES.md section 3) for the window building blocks."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from barwise.functions import ts
from barwise.functions.arith import ieee_div
from barwise.functions.ewm import add_emas
from barwise.operators.features import cumulative_vwap, rsi


def series_df(spark, values, symbol="a", extra=None):
    rows = []
    for i, v in enumerate(values):
        row = [symbol, dt.date(2024, 1, 1) + dt.timedelta(days=7 * i), None if v is None else float(v)]
        if extra is not None:
            row.append(extra[i])
        rows.append(tuple(row))
    schema = "symbol string, date date, x double" + (", v bigint" if extra is not None else "")
    return spark.createDataFrame(rows, schema)


def collect(df, col):
    return [r[0] for r in df.orderBy("symbol", "date").select(col).collect()]


def close(a, b, tol=1e-6):
    if a is None or b is None:
        return a is None and b is None
    if math.isinf(a) or math.isinf(b):
        return a == b
    return abs(a - b) <= tol


def ema(values, span):
    """The recurrence, value by value."""
    alpha, y, weight, out = 2 / (span + 1), None, 1.0, []
    for v in values:
        weight *= 1 - alpha
        if v is not None:
            y = v if y is None else (weight * y + alpha * v) / (weight + alpha)
            weight = 1.0
        out.append(y)
    return out


def test_ema_with_gap(spark):
    df = add_emas(series_df(spark, [1, 2, None, 4, 4, 4, 4, 0]), [("e", "x", 3)])
    want = [1, 1.5, 1.5, 3.166667, 3.583333, 3.791667, 3.895833, 1.947917]
    assert all(close(a, b) for a, b in zip(collect(df, "e"), want))


def test_ema_leading_missing(spark):
    assert collect(add_emas(series_df(spark, [None, 2, 4]), [("e", "x", 3)]), "e") == [None, 2, 3]


@pytest.mark.parametrize("block_days", [7, 50, 896])
def test_ema_of_one_long_series_in_blocks(spark, block_days):
    """One symbol, in many blocks: the same as the recurrence, without Python
    nodes, and its rows lie in several tasks."""
    import random

    rng = random.Random(block_days)
    days = sorted(rng.sample(range(4000), 900))
    values = [None if rng.random() < 0.3 or 100 < i < 180 else rng.uniform(-5, 90) for i in range(len(days))]
    start = dt.date(1968, 3, 1)
    rows = [("A", start + dt.timedelta(days=d), v) for d, v in zip(days, values)] + [("B", start, None), ("C", start, 4.0), (None, start, 1.0)]
    df = spark.createDataFrame(rows, "symbol string, date date, x double").repartition(3)
    out = add_emas(df, [("a", "x", 2.0), ("b", "x", 26.0)], block_days=block_days)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    got = [r for r in out.collect() if r.symbol == "A"]
    got.sort(key=lambda r: r.date)
    for name, span in (("a", 2.0), ("b", 26.0)):
        for r, want in zip(got, ema(values, span)):
            assert (r[name] is None) == (want is None) and (want is None or abs(r[name] - want) < 1e-9)
    assert {r.symbol: r.a for r in out.collect() if r.symbol != "A"} == {"B": None, "C": 4.0, None: 1.0}
    if block_days == 7:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            assert out.where("symbol = 'A'").groupBy(F.spark_partition_id()).count().count() > 1
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_rolling_skew_kurt(spark):
    df = series_df(spark, [1, 2, 4, 8, 8, 8, 8, 8])
    skew = collect(df.select("symbol", "date", ts.rolling_skew("x", 4).alias("s")), "s")
    kurt = collect(df.select("symbol", "date", ts.rolling_kurt("x", 4).alias("k")), "k")
    assert all(close(a, b) for a, b in zip(skew, [None] * 3 + [1.137624, -0.370370, -2, 0, 0]))
    assert all(close(a, b) for a, b in zip(kurt, [None] * 3 + [0.757656, -3.901235, 4, -3, -3]))


def test_rsi_period_2(spark):
    df = series_df(spark, [1, 2, 3, 3, 3, 2])
    got = collect(df.select("symbol", "date", rsi(F.col("x")).alias("r")), "r")
    assert all(close(a, b) for a, b in zip(got, [None, 100, 100, 100, None, 0]))


def test_grouped_pct_change(spark):
    a = series_df(spark, [1, None, 2, 3], "a")
    b = series_df(spark, [5, 0, 6], "b")
    df = a.unionByName(b).select("symbol", "date", ts.pct_change("x").alias("p"))
    got = collect(df, "p")
    want = [None, 0.0, 1.0, 0.5, None, -1.0, float("inf")]
    assert all(close(x, y) for x, y in zip(got, want))


def test_cumsum_with_gap(spark):
    df = series_df(spark, [1, None, 2]).select("symbol", "date", ts.cumsum("x").alias("c"))
    assert collect(df, "c") == [1.0, None, 3.0]


def test_vwap_global(spark):
    df = series_df(spark, [10, 20, 5, None], extra=[1, 3, 2, 0]).withColumnRenamed(
        "x", "adj_close").withColumnRenamed("v", "volume")
    got = collect(cumulative_vwap(df), "vwap")
    assert all(close(a, b) for a, b in zip(got, [10, 17.5, 13.333333, None]))


def test_vwap_spans_symbols(spark):
    a = series_df(spark, [10, 20], "a", extra=[1, 1])
    b = series_df(spark, [30], "b", extra=[2])
    df = a.unionByName(b).withColumnRenamed("x", "adj_close").withColumnRenamed("v", "volume")
    got = collect(cumulative_vwap(df), "vwap")
    assert all(close(x, y) for x, y in zip(got, [10, 15, 22.5]))


def test_row_max_skips_null(spark):
    df = spark.createDataFrame([(None, 2.0, 1.0), (1.0, None, 0.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(F.greatest("a", "b", "c")).collect()] == [2.0, 1.0]


def test_obv(spark):
    from barwise.operators.features import add_window_features
    rows = []
    for sym, prices, vols in [("a", [1, 2, 1], [10, 20, 30]), ("b", [5, 5, 6], [1, 2, 3])]:
        for i, (p, v) in enumerate(zip(prices, vols)):
            rows.append((sym, dt.date(2024, 1, 5) + dt.timedelta(days=7 * i), float(p), float(p),
                         float(p), float(p), float(p), v))
    schema = "symbol string, date date, open double, high double, low double, close double, adj_close double, volume bigint"
    df = spark.createDataFrame(rows, schema)
    got = collect(add_window_features(df), "obv")
    assert got == [0.0, 20.0, -10.0, 0.0, 0.0, 3.0]
    alone = collect(add_window_features(df.where("symbol = 'a'")), "obv")
    assert alone == [0.0, 20.0, -10.0]


def test_topk_ties_and_nulls(spark):
    from barwise.operators.signals import topk_signals
    vals = [1, 3, 3, 2, 2, 2, None]
    rows = [(dt.date(2024, 1, 5), s, None if v is None else float(v)) for s, v in zip("abcdefg", vals)]
    df = spark.createDataFrame(rows, "date date, symbol string, predicted_return double")
    got = [r.symbol for r in topk_signals(df, 5).orderBy("rank").collect()]
    assert got == list("bcdef")


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 1),), (dt.date(2024, 12, 30),), (dt.date(2024, 1, 5),)], "d date")
    got = df.select(F.weekofyear("d"), F.weekday("d")).collect()
    assert got[0][0] == 53 and got[1][0] == 1 and got[2][1] == 4


def test_complete_rows_keep_inf(spark):
    from barwise.operators.split import drop_incomplete
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,), (None,)], "x double")
    got = sorted(r.x for r in drop_incomplete(df).collect())
    assert got == [1.0, float("inf")]


@pytest.mark.parametrize("a,b,want", [(1.0, 0.0, float("inf")), (-1.0, 0.0, float("-inf")),
                                      (0.0, 0.0, None), (None, 0.0, None), (1.0, None, None),
                                      (3.0, 2.0, 1.5)])
def test_ieee_div(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a double, b double")
    assert df.select(ieee_div("a", "b")).first()[0] == want


def test_insert_ignore_first_arrival_wins(spark):
    from barwise.sources.tables import new_rows
    existing = spark.createDataFrame([(dt.date(2024, 1, 1), "k1")], "date date, symbol string")
    batch = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "k1", 1.0, 1), (dt.date(2024, 1, 2), "k2", 2.0, 2),
         (dt.date(2024, 1, 2), "k2", 3.0, 3)],
        "date date, symbol string, v double, arrival int")
    got = new_rows(batch, existing).collect()
    assert [(r.symbol, r.v) for r in got] == [("k2", 2.0)]
    # a second run against the grown table adds nothing
    grown = existing.unionByName(new_rows(batch, existing).select("date", "symbol"))
    assert new_rows(batch, grown).count() == 0


def test_causal_features_ignore_the_future(spark):
    """causal=True: altering a later bar leaves earlier rows unchanged (the
    default keeps the reference's look-ahead constants, which do change)."""
    from barwise.operators.features import add_features
    rows = []
    for i in range(30):
        p = 10.0 + (i % 5) + i * 0.1
        rows.append(("a", dt.date(2024, 1, 5) + dt.timedelta(days=7 * i), p, p + 1, p - 1, p, p, 100 + i))
    schema = "symbol string, date date, open double, high double, low double, close double, adj_close double, volume bigint"
    base = spark.createDataFrame(rows, schema)
    bumped = spark.createDataFrame(rows[:-1] + [rows[-1][:3] + (999.0,) + rows[-1][4:]], schema)
    cols = ["range", "weekly_price_diff", "volatility", "vwap", "rsi_2w", "ema12"]

    def head(df, causal):
        out = add_features(df, causal=causal).orderBy("date").select(*cols).collect()
        return out[:20]
    assert head(base, True) == head(bumped, True)
    assert head(base, False) != head(bumped, False)


def test_keep_unlabelled(spark):
    from barwise.operators.split import drop_incomplete
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0), (None, 2.0)], "x double, next_weekly_return double")
    assert drop_incomplete(df).count() == 1
    assert drop_incomplete(df, keep_unlabelled=True).count() == 2


def test_symbol_prefix_two_level(spark):
    """Exclusive prefix over symbols equals the direct sum, whatever the
    number of buckets."""
    from barwise.operators.features import symbol_prefix
    rows = [(f"S{i:03d}", float(i), i) for i in range(200)]
    totals = spark.createDataFrame(rows, "symbol string, a double, b bigint")
    want = {}
    acc_a = acc_b = 0
    for sym, a, b in sorted(rows):
        want[sym] = (acc_a, acc_b)
        acc_a += a
        acc_b += b
    for nb in (1, 7, 1024):
        got = {r.symbol: (r.pa, r.pb) for r in symbol_prefix(totals, {"a": "pa", "b": "pb"}, nb).collect()}
        assert got == want
