import os
import tempfile

from pyspark.sql import functions as F

from barwise.sources.bars import BAR_COLUMNS, lineitem_bars
from barwise.streaming.daily_load import start_daily_load


def test_daily_load_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="bw-stream-")
    src, ckpt = os.path.join(root, "in"), os.path.join(root, "ckpt")
    bars = lineitem_bars(spark, "/root/testdata/sf0.001", "l_returnflag").select(*BAR_COLUMNS)
    cut = F.lit("1998-01-01").cast("date")
    bars.where(F.col("date") < cut).write.parquet(os.path.join(src, "part1"))
    table = "bw_stream_bars"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    q = start_daily_load(spark, os.path.join(src, "*"), table, ckpt)
    q.awaitTermination(300)
    spark.catalog.refreshTable(table)  # the batches were written by the stream's session
    first = spark.table(table).count()
    assert first == bars.where(F.col("date") < cut).count()
    # a second drop overlaps the first: only the new dates are appended
    bars.where(F.col("date") >= F.lit("1997-06-01").cast("date")).write.parquet(os.path.join(src, "part2"))
    q = start_daily_load(spark, os.path.join(src, "*"), table, ckpt)
    q.awaitTermination(300)
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == bars.count()
    assert spark.table(table).groupBy("date", "symbol").count().where("count > 1").count() == 0
