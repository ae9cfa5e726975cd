"""Stored tables: constraints and idempotent append (insert-ignore).

Parquet has no MERGE, so ``ON CONFLICT DO NOTHING`` becomes: rank the batch
per key by an explicit arrival column (first arrival wins), leave out the keys
already stored, append.

Tables are partitioned by month, and next to each lies a table of key sketches:
per month, the stored keys' hashes as a bit map. A batch's keys are looked up
there first. Those whose bit is not set are surely new; for the others, only
their months' partitions are read, key columns only. A batch of new bars reads
no stored bar, a repeated one only its own months, however long the history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwise.session import checkpoint_dir

BAR_KEY = ("date", "symbol")
#: The partition column of stored tables, and the rule that gives it.
MONTH = "month"
#: Bits of one month's key sketch (128 kB).
SKETCH_BITS = 1 << 20

BARS_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
  date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE,
  adj_close DOUBLE, volume BIGINT, symbol STRING, month INT)
USING parquet PARTITIONED BY (month)
"""

PREDICTIONS_DDL = """
CREATE TABLE IF NOT EXISTS {name} (
  date DATE, symbol STRING, predicted_return DOUBLE, `return` DOUBLE,
  open DOUBLE, adj_close DOUBLE, month INT)
USING parquet PARTITIONED BY (month)
"""

SKETCH_DDL = """
CREATE TABLE IF NOT EXISTS {name} (month INT, piece BIGINT, bits BINARY) USING parquet
"""


def month_of(date: str = "date") -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("int")


def create_table(spark: SparkSession, name: str, ddl: str = BARS_DDL) -> None:
    """Create the table if missing."""
    spark.sql(ddl.format(name=name))


def constraint_violations(df: DataFrame, not_null: Sequence[str] = ("date",),
                          key: Sequence[str] = BAR_KEY, max_len: dict | None = None) -> DataFrame:
    """One row of violation counts.

    * ``null_<c>``: NULLs in a NOT NULL column (including key columns),
    * ``dup_key``: rows beyond the first per key,
    * ``long_<c>``: values longer than the column's declared length.

    Every check is a sum, so it is counted per key first (one shuffle on the
    key, partially aggregated) and then summed into one row.
    """
    max_len = {"symbol": 9} if max_len is None else max_len
    cols = list(dict.fromkeys(list(not_null) + list(key)))
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols if c not in key],
        *[F.count_if(F.length(c) > n).alias(f"long_{c}") for c, n in max_len.items()],
    )
    null_keys = [F.sum(F.when(F.col(c).isNull(), F.col("_n")).otherwise(0)).alias(f"null_{c}")
                 for c in cols if c in key]
    others = [F.sum(f"null_{c}").alias(f"null_{c}") for c in cols if c not in key]
    longs = [F.sum(f"long_{c}").alias(f"long_{c}") for c in max_len]
    out = per_key.agg(*null_keys, *others, *longs,
                      F.sum(F.col("_n") - 1).alias("dup_key"),
                      F.sum("_n").alias("rows"))
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in out.columns])


def assert_valid(df: DataFrame, **kw) -> None:
    """Raise if any constraint is violated (one bad row fails the batch)."""
    row = constraint_violations(df, **kw).first().asDict()
    bad = {k: v for k, v in row.items() if k != "rows" and v}
    if bad:
        raise ValueError(f"constraint violations: {bad}")


def new_rows(batch: DataFrame, existing: DataFrame, key: Sequence[str] = BAR_KEY,
             arrival: str = "arrival") -> DataFrame:
    """Rows of ``batch`` that insert-ignore would add.

    Within the batch the first row per key by ``arrival`` wins (not
    ``dropDuplicates``, whose winner is arbitrary); keys already stored
    win over the batch. ``row_number() = 1`` is planned as a window group
    limit, so only the winner per key survives the sort.
    """
    return first_rows(batch, key, arrival).join(existing.select(*key), list(key), "left_anti")


def first_rows(batch: DataFrame, key: Sequence[str] = BAR_KEY, arrival: str = "arrival") -> DataFrame:
    """The first row per key by ``arrival``."""
    # Arrival first; the remaining columns only make exact ties deterministic.
    rest = [c for c in batch.columns if c not in key and c != arrival]
    w = Window.partitionBy(*key).orderBy(F.col(arrival), *[F.col(c) for c in rest])
    return (batch.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def is_partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.name == MONTH and c.isPartition for c in spark.catalog.listColumns(table))


def _placed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` with a key's place in its month's sketch: a piece, and a bit in it."""
    place = F.pmod(F.xxhash64(*key), F.lit(SKETCH_BITS)) + 1
    return df.withColumn("_piece", F.bitmap_bucket_number(place)).withColumn("_bit", F.bitmap_bit_position(place))


def key_sketch(df: DataFrame, key: Sequence[str] = BAR_KEY) -> DataFrame:
    """(month, piece, bits) of the keys of ``df``, which has a month column."""
    return (_placed(df, key).groupBy(MONTH, F.col("_piece").alias("piece"))
            .agg(F.bitmap_construct_agg("_bit").alias("bits")))


def maybe_stored(df: DataFrame, sketch: DataFrame, key: Sequence[str] = BAR_KEY) -> DataFrame:
    """``df`` with ``_maybe``: false only for keys that are surely not stored."""
    whole = sketch.groupBy(F.col(MONTH).alias("_m"), F.col("piece").alias("_p")).agg(F.bitmap_or_agg("bits").alias("_bits"))
    at = _placed(df, key).join(whole, (F.col(MONTH) == F.col("_m")) & (F.col("_piece") == F.col("_p")), "left")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(F.col("_bit") / 8) + 1).cast("int"), F.lit(1))), 16, 10)
    hit = F.getbit(byte.cast("int"), (F.col("_bit") % 8).cast("int")) == 1
    return at.withColumn("_maybe", F.coalesce(hit, F.lit(False))).drop("_m", "_p", "_bits", "_piece", "_bit")


def sketch_table(spark: SparkSession, table: str, key: Sequence[str] = BAR_KEY) -> str:
    """The name of the table's key sketches, built from the stored keys if there
    are none. Rows stored past ``insert_ignore`` are unknown to them: drop the
    sketch table then, and it is built anew."""
    name = f"{table}_keys"
    if not spark.catalog.tableExists(name):
        spark.sql(SKETCH_DDL.format(name=name))
        key_sketch(spark.table(table), key).select(MONTH, "piece", "bits").write.insertInto(name)
    return name


def stored_keys(spark: SparkSession, table: str, months: Sequence[int], key: Sequence[str] = BAR_KEY) -> DataFrame:
    """The keys stored in the given months: other partitions are never listed."""
    return spark.table(table).where(F.col(MONTH).isin(list(months))).select(*key)


def _append(rows: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Cut the lineage before the append: the plan reads the table it writes,
    and a retried task must not see its own output."""
    ckpt = rows.checkpoint(eager=True)
    assert_valid(ckpt, not_null=[key[0]], key=key)
    return ckpt


def insert_ignore(spark: SparkSession, batch: DataFrame, table: str,
                  key: Sequence[str] = BAR_KEY, arrival: str = "arrival") -> DataFrame:
    """Append the new rows of ``batch`` to ``table`` (created if missing,
    partitioned by month).

    Columns are taken by name in the table's order; rows are validated first. A
    re-run appends nothing. The new keys enter the sketch before the rows enter
    the table, so a crash between leaves keys that are looked for in vain, never
    a stored key that is taken for new. Returns the appended rows. A table that
    has no month partitions is compared as a whole.
    """
    checkpoint_dir(spark)
    if MONTH not in batch.columns and key[0] == "date":
        batch = batch.withColumn(MONTH, month_of())
    if not spark.catalog.tableExists(table):
        cols = [c for c in batch.columns if c != arrival]
        writer = batch.limit(0).select(*cols).write.format("parquet")
        (writer.partitionBy(MONTH) if MONTH in cols else writer).saveAsTable(table)
    # Writers in other sessions (e.g. a streaming foreachBatch clone) leave
    # this session's cached file listing stale; a stale listing would miss
    # stored keys, so refresh before the keys are read.
    spark.catalog.refreshTable(table)
    target = spark.table(table)
    if not is_partitioned(spark, table):
        ckpt = _append(new_rows(batch, target, key, arrival).select(*target.columns), table, key)
        ckpt.write.insertInto(table)
        return ckpt
    name = sketch_table(spark, table, key)
    spark.catalog.refreshTable(name)
    told = maybe_stored(first_rows(batch, key, arrival), spark.table(name), key).checkpoint()
    months = [r[0] for r in told.filter("_maybe").select(MONTH).distinct().collect()]  # as many as the calendar has
    fresh = told.filter("NOT _maybe")
    if months:
        known = stored_keys(spark, table, months, key)
        fresh = fresh.unionByName(told.filter("_maybe").join(known, list(key), "left_anti"))
    ckpt = _append(fresh.select(*target.columns), table, key)
    if ckpt.head(1):
        key_sketch(ckpt, key).select(MONTH, "piece", "bits").write.insertInto(name)
        ckpt.hint("rebalance", MONTH).write.insertInto(table)
    return ckpt
