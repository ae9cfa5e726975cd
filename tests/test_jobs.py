"""End-to-end jobs on the sf0.001 fixture (return flag as symbol)."""
import os
import tempfile

from pyspark.sql import functions as F

from barwise.plans import jobs
from barwise.sources.bars import lineitem_bars, provider_feed


def test_load_train_predict(spark):
    bars = lineitem_bars(spark, "/root/testdata/sf0.001", "l_returnflag")
    feeds = {s: provider_feed(bars.where(F.col("symbol") == s)).drop("Stock_Name")
             for s in ("A", "N", "R")}
    spark.sql("DROP TABLE IF EXISTS bw_job_bars")
    added = jobs.load_feeds(spark, feeds, "bw_job_bars")
    assert added.count() == bars.count()
    assert jobs.load_feeds(spark, feeds, "bw_job_bars").count() == 0   # daily re-run adds nothing
    stored = spark.table("bw_job_bars")

    path = os.path.join(tempfile.mkdtemp(prefix="bw-models-"), "models")
    res = jobs.train_models(spark, stored, path, n_trials=1, ranges={"maxIter": (2, 3, "int"), "maxDepth": (2, 2, "int")})
    assert res["best"].count() == 6                                    # 3 profiles x 2 objectives
    spark.sql("DROP TABLE IF EXISTS bw_job_preds")
    out = jobs.predict(spark, stored, path, "bw_job_preds", stack_trees=5)
    assert out["metrics"].count() == 2
    assert out["validation_summary"].count() == 1
    n = out["stored"].count()
    assert n > 0 and spark.table("bw_job_preds").count() == n
