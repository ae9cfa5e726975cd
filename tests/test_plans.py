"""Plan-shape tests: the properties the design relies on at scale."""
import re

from barwise.operators import features as ft
from barwise.operators.resample import resample_ohlcv
from barwise.sources.bars import lineitem_bars

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def above_cache(df) -> str:
    """The part of the plan executed above a persisted input."""
    return plan(df).split("InMemoryRelation")[0]


def test_feature_chain_adds_no_exchange(spark):
    """Over weekly bars partitioned by symbol, the ~60 window features, the
    lag/lead chains and the nested windows plan without any Exchange."""
    weekly = resample_ohlcv(lineitem_bars(spark, SF, "l_returnflag")).persist()
    weekly.count()
    p = above_cache(ft.add_window_features(weekly))
    assert "InMemoryTableScan" in p
    assert "Exchange" not in p, p
    assert p.count("Window") >= 3


def test_resample_and_gap_fill_share_one_symbol_shuffle(spark):
    spark.catalog.clearCache()  # an identical persisted plan would be substituted
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan
    try:
        p = plan(resample_ohlcv(lineitem_bars(spark, SF, "l_returnflag")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = set(re.findall(r"Exchange (hashpartitioning\([^)]*\)).*?plan_id=(\d+)", p))
    # one shuffle for the daily aggregate (date, symbol) and one on symbol
    assert len({pid for _, pid in exchanges}) == 2, p
    assert sum(1 for part, _ in exchanges if part.startswith("hashpartitioning(symbol#")) == 1, p


def test_vwap_single_partition_only_over_symbol_totals(spark):
    """The global running VWAP needs an ordered pass over symbols; that pass
    sees one row per symbol bucket, never the bars or all symbols."""
    weekly = resample_ohlcv(lineitem_bars(spark, SF, "l_returnflag")).persist()
    weekly.count()
    lines = plan(ft.cumulative_vwap(weekly)).splitlines()
    single = [i for i, ln in enumerate(lines) if "Exchange SinglePartition" in ln]
    assert len(single) == 1, "\n".join(lines)
    child = lines[single[0] + 1]
    # the ordered pass sees bucket totals (at most 1,025 rows), not symbols or bars
    assert "HashAggregate" in child and "_bucket" in child, child


def test_filters_and_columns_reach_the_scan(spark):
    from pyspark.sql import functions as F
    from barwise.sources.bars import read_bars
    import tempfile
    path = tempfile.mkdtemp(prefix="bw-bars-")
    lineitem_bars(spark, SF, "l_returnflag").write.mode("overwrite").parquet(path)
    df = read_bars(spark, path, symbols=["A", "N"], start="1996-01-01", end="1997-01-01")
    p = df.select("date", "adj_close")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in p and "In(symbol" in p and "GreaterThanOrEqual(date" in p, p
    assert re.search(r"ReadSchema: struct<date:date,symbol:string,adj_close:double>", p), p
    assert df.count() > 0


def test_per_scenario_topk_uses_group_limit(spark):
    """With a per-scenario k, the grid's largest k still bounds the window
    (partial top-k before the shuffle, final after)."""
    import datetime as dt
    from barwise.operators.signals import topk_signals
    rows = [("s1", 3, dt.date(2024, 1, 5), f"S{i}", float(i)) for i in range(20)]
    df = spark.createDataFrame(rows, "scenario_id string, k int, date date, symbol string, predicted_return double")
    top = topk_signals(df, k="k", k_max=3)
    assert plan(top).count("WindowGroupLimit") == 2
    assert [r.symbol for r in top.orderBy("rank").collect()] == ["S19", "S18", "S17"]
