"""Month-partitioned tables with key sketches, the quarantine and as-of joins."""
import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from barwise.operators.asof import asof_join
from barwise.sources import bars as B
from barwise.sources import tables as T

SCHEMA = "date date, symbol string, close double, arrival int"


def day(i):
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def stored(spark, table):
    return sorted((r.date, r.symbol, r.close) for r in spark.table(table).collect())


def test_loads_read_only_their_months(spark):
    table = f"bw_loads_{uuid.uuid4().hex}"
    history = [(day(i), s, float(i), 1) for i in range(0, 360, 3) for s in ("A", "B")]
    assert T.insert_ignore(spark, batch(spark, history), table).count() == len(history)
    # a batch of new bars: no key is looked for in the stored bars
    new = batch(spark, [(day(400), "A", 1.0, 2), (day(400), "A", 2.0, 1), (day(401), "C", 3.0, 1)]).withColumn("month", T.month_of())
    told = T.maybe_stored(T.first_rows(new), spark.table(f"{table}_keys"))
    assert told.filter("_maybe").count() == 0 and told.count() == 2
    assert T.insert_ignore(spark, new, table).count() == 2
    # a repeated batch, and one that mixes old and new rows
    mixed = [(day(0), "A", -1.0, 1), (day(1), "A", 7.0, 1), (day(400), "A", -1.0, 1), (day(3), "B", -1.0, 1)]
    assert [(r.date, r.close) for r in T.insert_ignore(spark, batch(spark, mixed), table).collect()] == [(day(1), 7.0)]
    for again in (history, mixed):
        assert T.insert_ignore(spark, batch(spark, again), table).count() == 0
    want = [(d, s, c) for d, s, c, _ in history] + [(day(400), "A", 2.0), (day(401), "C", 3.0), (day(1), "A", 7.0)]
    assert stored(spark, table) == sorted(want)
    plan = T.stored_keys(spark, table, [202002, 202003])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan and "IN (202002,202003)" in plan
    files = T.stored_keys(spark, table, [202002]).select(F.input_file_name()).distinct().collect()
    assert files and all("month=202002" in r[0] for r in files)


def test_sketch_never_misses_and_rarely_errs(spark):
    df = spark.range(40_000).select(F.lit(dt.date(2020, 5, 1)).alias("date"), F.col("id").cast("string").alias("symbol"),
                                    F.lit(202005).alias("month"))
    sketch = T.key_sketch(df.where("symbol % 2 = 0")).unionByName(T.key_sketch(df.where("symbol < 10")))
    told = T.maybe_stored(df, sketch).groupBy((F.col("symbol") % 2 == 0).alias("in"), "_maybe").count().collect()
    n = {(r["in"], r["_maybe"]): r["count"] for r in told}
    assert n[True, True] == 20_000 and n.get((False, True), 0) < 20_000 * 0.05
    other = df.withColumn("month", F.lit(202006))
    assert T.maybe_stored(other, sketch).filter("_maybe").count() == 0


def test_table_without_months_and_sketch_built_later(spark):
    plain = f"bw_plain_{uuid.uuid4().hex}"
    rows = [(day(i), "A", float(i), 1) for i in range(5)]
    batch(spark, rows).drop("arrival").write.saveAsTable(plain)
    assert T.insert_ignore(spark, batch(spark, rows + [(day(9), "A", 9.0, 1)]), plain).count() == 1
    late = f"bw_late_{uuid.uuid4().hex}"
    batch(spark, rows).drop("arrival").withColumn("month", T.month_of()).write.partitionBy("month").saveAsTable(late)
    assert T.insert_ignore(spark, batch(spark, rows + [(day(9), "A", 9.0, 1)]), late).count() == 1
    with pytest.raises(ValueError):
        T.insert_ignore(spark, batch(spark, [(None, "A", 1.0, 1)]), late)
    spark.sql(T.BARS_DDL.format(name=f"bw_ddl_{uuid.uuid4().hex}"))


def test_stored_bars_prune_partitions(spark):
    table = f"bw_scan_{uuid.uuid4().hex}"
    rows = [(day(i), s, float(i), 1) for i in range(0, 360, 5) for s in ("A", "B", "C")]
    df = batch(spark, rows).withColumns({c: F.lit(1.0) for c in ("open", "high", "low", "adj_close")}).withColumn("volume", F.lit(1).cast("long"))
    T.insert_ignore(spark, df, table)
    universe = spark.createDataFrame([("A",), ("Z",)], "symbol string")
    out = B.stored_bars(spark, table, universe, "2020-03-10", "2020-05-01")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "202003" in plan and "202005" in plan
    want = sorted((d, s) for d, s, _, _ in rows if s == "A" and dt.date(2020, 3, 10) <= d < dt.date(2020, 5, 1))
    assert sorted((r.date, r.symbol) for r in out.collect()) == want


def test_quarantine(spark, tmp_path):
    rows = [("2020-01-02", "A", "1.5", "10"), (None, "A", "1", "1"), ("soon", "LONGERTHANNINE", "x", "1.5x"), ("2020-01-03", None, "NaN", "2"),
            ("2020-01-04", "B", "NaN", None), ("", "B", None, "3")]
    raw = spark.createDataFrame(rows, "Date string, Stock_Name string, Close string, Volume string")
    told = B.screen(raw)
    assert [r.broken for r in told.collect()] == [[], ["no_date"], ["bad_date", "long_symbol", "bad_number"], ["no_symbol"], [], ["bad_date"]]
    counts = B.quarantine(told, f"{tmp_path}/feed")
    assert counts == {"rows": 6, "rejected": 4, "no_date": 1, "bad_date": 2, "no_symbol": 1, "long_symbol": 1, "bad_number": 1}
    good = sorted((r.date, r.symbol, r.close, r.volume) for r in B.accepted(spark, f"{tmp_path}/feed").collect())
    assert good == [(dt.date(2020, 1, 2), "A", 1.5, 10), (dt.date(2020, 1, 4), "B", None, None)]
    assert sorted(str(r.raw_date) for r in B.rejected(spark, f"{tmp_path}/feed").collect()) == ["", "2020-01-03", "None", "soon"]
    kept = B.screen(raw, keep_null_dates=True).where(F.size("broken") == 0).collect()
    assert sorted(str(r.date) for r in kept) == ["2020-01-02", "2020-01-04", "None", "None"]
    no_date = B.screen(raw.drop("Date"), symbol="X")
    assert {tuple(r.broken) for r in no_date.collect()} <= {("no_date",), ("no_date", "bad_number")}
    assert B.quarantine(B.screen(raw.limit(0)), f"{tmp_path}/none")["rows"] == 0


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("strict", [False, True])
def test_asof_join(spark, forward, strict):
    rng = random.Random(4)
    keys = ["hot"] * 30 + ["b", "c", None]
    right = [(rng.choice(keys[:-1]), day(rng.randrange(900)), float(i)) for i in range(300)] + [("hot", None, 1.0), (None, day(5), 2.0)]
    left = [(rng.choice(keys), day(rng.randrange(-50, 950)), i) for i in range(400)] + [("hot", None, -1), ("absent", day(3), -2)]
    ldf = spark.createDataFrame(left, "k string, t date, id int").repartition(4)
    rdf = spark.createDataFrame(right, "k string, u date, v double").repartition(4)
    got = {r.id: (r.u, r.v) for r in asof_join(ldf, rdf, ["k"], "t", "u", forward, strict, bucket_days=30).collect()}
    for k, t, i in left:
        some = [(u, v) for kk, u, v in right if kk == k and None not in (k, u, t)
                and (u > t if forward else u < t) | (u == t and not strict)]
        assert got[i] == ((min if forward else max)(some) if some else (None, None)), i
    assert len(got) == len(left)


def test_asof_join_splits_a_hot_key(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("k"), F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")).alias("t"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = asof_join(rows, rows.select("k", F.col("t").alias("u"), F.lit(1).alias("v")), ["k"], "t", "u")
        assert out.where("u = t").groupBy(F.spark_partition_id()).count().count() > 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
