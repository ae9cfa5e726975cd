import datetime as dt

from pyspark.sql import functions as F

from barwise.sources.bars import missing_symbols, normalize, requested, union_feeds
from barwise.sources.tables import constraint_violations, insert_ignore


def feed(spark, rows):
    return spark.createDataFrame(rows, "Date string, `Adj Close` double, Close double, High double, "
                                       "Low double, Open double, Volume bigint")


def test_normalize_coerces_dates_and_tags_symbol(spark):
    raw = feed(spark, [("2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0, 5), ("not a date", 2.0, 2.0, 2.0, 2.0, 2.0, 6),
                       (None, 3.0, 3.0, 3.0, 3.0, 3.0, 7), ("2024-01-03", float("nan"), 4.0, 4.0, 4.0, 4.0, 8)])
    out = normalize(raw, symbol="AAA").orderBy("date").collect()
    assert [(r.date, r.symbol, r.adj_close) for r in out] == [
        (dt.date(2024, 1, 2), "AAA", 1.0), (dt.date(2024, 1, 3), "AAA", None)]


def test_feed_without_date_is_skipped(spark):
    good = feed(spark, [("2024-01-02", 1.0, 1.0, 1.0, 1.0, 1.0, 5)])
    bad = spark.createDataFrame([(1.0,)], "Close double")
    out = union_feeds({"A": good, "B": bad})
    assert [r.symbol for r in out.collect()] == ["A"]


def test_float32_option(spark):
    raw = feed(spark, [("2024-01-02", 0.1, 0.1, 0.1, 0.1, 0.1, 1)])
    r = normalize(raw, symbol="A", float32=True).first()
    assert r.adj_close != 0.1 and abs(r.adj_close - 0.1) < 1e-7


def test_constraint_violations(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "A"), (dt.date(2024, 1, 1), "A"), (None, "B"), (dt.date(2024, 1, 2), "TOOLONGNAME")],
        "date date, symbol string")
    r = constraint_violations(df).first().asDict()
    assert r == {"null_date": 1, "null_symbol": 0, "long_symbol": 1, "dup_key": 1, "rows": 4}


def test_missing_symbols(spark):
    bars = spark.createDataFrame([(dt.date(2024, 1, 1), "A")], "date date, symbol string")
    assert [r.symbol for r in missing_symbols(bars, requested(spark, ["A", "Z"])).collect()] == ["Z"]


def test_insert_ignore_table_twice(spark):
    spark.sql("DROP TABLE IF EXISTS bw_ii")
    rows = [(dt.date(2024, 1, 1), "A", 1.0, 1), (dt.date(2024, 1, 1), "A", 2.0, 2), (dt.date(2024, 1, 2), "A", 3.0, 3)]
    batch = spark.createDataFrame(rows, "date date, symbol string, close double, arrival int")
    added = insert_ignore(spark, batch, "bw_ii")
    assert added.count() == 2
    again = insert_ignore(spark, batch, "bw_ii")
    assert again.count() == 0
    got = sorted((r.date, r.close) for r in spark.table("bw_ii").collect())
    assert got == [(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 1, 2), 3.0)]


def test_model_save_load_roundtrip(spark, tmp_path):
    from barwise.operators import model as ml
    rng = [(float(i), float(i % 7), float(i) * 0.1) for i in range(60)]
    df = spark.createDataFrame(rng, "a double, b double, next_weekly_return double")
    m = ml.fit_base(df, "catboost", ["a", "b"], {"maxIter": 3, "maxDepth": 2}, "p")
    ml.save_models({"catboost_roi": m}, str(tmp_path))
    loaded = ml.load_models(str(tmp_path), ["catboost_roi", "xgboost_roi"])
    assert list(loaded) == ["catboost_roi"]
    a = [r.p for r in m.transform(df).select("p").collect()]
    b = [r.p for r in loaded["catboost_roi"].transform(df).select("p").collect()]
    assert a == b
    rm = ml.regression_metrics(m.transform(df), "next_weekly_return", "p").first()
    assert rm.n == 60 and rm.rmse >= rm.mae >= 0


def test_score_and_store_and_early_stopping(spark):
    import datetime as dt
    from barwise.operators import model as ml
    rows = []
    for i in range(80):
        d = dt.date(2000, 1, 7) + dt.timedelta(days=7 * i)
        period = "train" if i < 50 else ("test" if i < 65 else "prediction")
        rows.append(("S%d" % (i % 3), d, period, float(i % 5), float(i % 7), float(i) * 0.01,
                     float(i % 4) * 0.01, 10.0 + i, 10.5 + i))
    df = spark.createDataFrame(rows, "symbol string, date date, period string, a double, b double, "
                                     "next_weekly_return double, weekly_return double, open double, adj_close double")
    tv = df.where("period in ('train', 'test')").withColumn("is_val", F.col("period") == "test")
    m = ml.fit_base(tv, "catboost", ["a", "b"], {"maxIter": 20, "maxDepth": 2}, "cb", validation_col="is_val")
    assert 1 <= m.n_trees <= 20 and len(m.errors) <= 20
    models = {"cb": m}
    stack = ml.fit_stack(ml.score(df.where("period = 'train'"), models), ["cb"], trees=5, depth=2)
    spark.sql("DROP TABLE IF EXISTS bw_preds")
    added = ml.score_and_store(spark, df, models, stack, "bw_preds")
    assert added.count() == 15
    assert ml.score_and_store(spark, df, models, stack, "bw_preds").count() == 0
    assert spark.table("bw_preds").columns == ["date", "symbol", "predicted_return", "return", "open", "adj_close", "month"]
