"""Daily OHLCV bars: read, derive, normalise.

The canonical daily-bar layout is ``date, symbol, open, high, low, close,
adj_close, volume`` keyed by ``(symbol, date)``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwise.functions.arith import nan_to_null

BAR_SCHEMA = T.StructType([
    T.StructField("date", T.DateType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("adj_close", T.DoubleType(), True),
    T.StructField("volume", T.LongType(), True),
])
BAR_COLUMNS = [f.name for f in BAR_SCHEMA.fields]
PRICE_COLUMNS = ["open", "high", "low", "close", "adj_close"]

# Provider feed layout -> our names (fixed values: the provider's column names).
PROVIDER_COLUMNS = {
    "Date": "date",
    "Adj Close": "adj_close",
    "Close": "close",
    "High": "high",
    "Low": "low",
    "Open": "open",
    "Volume": "volume",
    "Stock_Name": "symbol",
}


def lineitem_bars(spark: SparkSession, sf_dir: str, symbol: str = "p_brand") -> DataFrame:
    """Derive daily bars from the order lines (the test-data price source).

    price = extendedprice / quantity traded on the ship date; the symbol is a
    part attribute (``p_brand``) or a line attribute (``l_returnflag``).
    open/close are the price of the first/last line by a unique line key.

    Plan: lineitem is joined to the two-column part projection on the part
    key (AQE turns this into a broadcast when part is small and splits skewed
    join partitions when it is not), then partially aggregated per
    (date, symbol) before the only shuffle, so a hot symbol costs one
    partial row per task, not its raw lines.
    """
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    if symbol.startswith("p_"):
        part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", symbol)
        li = li.join(part, li["l_partkey"] == part["p_partkey"])
    price = F.col("l_extendedprice") / F.col("l_quantity")
    key = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]
    # The line key is unique, so the smallest/largest (key, price...) struct
    # carries the first/last line's prices: two struct aggregates serve open,
    # close and adj_close.
    first = F.min(F.struct(*key, price.alias("p")))
    last = F.max(F.struct(*key, price.alias("p"), (price * (1 - F.col("l_discount"))).alias("a")))
    daily = li.groupBy(F.col("l_shipdate").cast("date").alias("date"), F.col(symbol).alias("symbol")).agg(
        first.alias("_first"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        last.alias("_last"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
    )
    return daily.select("date", "symbol", F.col("_first.p").alias("open"), "high", "low",
                        F.col("_last.p").alias("close"), F.col("_last.a").alias("adj_close"),
                        "volume")


def read_bars(spark: SparkSession, path: str, symbols: Iterable[str] | None = None,
              start: str | None = None, end: str | None = None) -> DataFrame:
    """Read stored daily bars with the fixed schema; symbols and the
    half-open range [start, end) are pushed to the Parquet scan."""
    df = spark.read.schema(BAR_SCHEMA).parquet(path)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") < F.lit(end).cast("date"))
    return df


def stored_bars(spark: SparkSession, table: str, universe: DataFrame | None = None,
                start: str | None = None, end: str | None = None) -> DataFrame:
    """S1/S5 from a stored table: the half-open range prunes its month
    partitions, and the universe (a one-column DataFrame) filters the scan
    through a semi join, which AQE broadcasts when it is small."""
    df = spark.table(table)
    for bound, low in ((start, True), (end, False)):
        if bound is not None:
            day = F.lit(bound).cast("date")
            month = int(bound[:4]) * 100 + int(bound[5:7])
            df = df.where((F.col("date") >= day) & (F.col("month") >= month) if low else (F.col("date") < day) & (F.col("month") <= month))
    if universe is not None:
        df = df.join(universe, "symbol", "left_semi")
    return df.select(*BAR_COLUMNS)


def requested(spark: SparkSession, symbols: Iterable[str]) -> DataFrame:
    """The ticker universe as a one-column DataFrame."""
    return spark.createDataFrame([(s,) for s in symbols], "symbol string")


def missing_symbols(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """S1 skip rule: requested symbols that have no bar (left anti join).

    Semi/anti joins only need the distinct keys of the bar side; Spark
    aggregates them partially before the shuffle.
    """
    present = bars.select("symbol").distinct()
    return universe.join(present, "symbol", "left_anti")


def normalize(raw: DataFrame, symbol: str | None = None,
              mapping: Mapping[str, str] = PROVIDER_COLUMNS,
              float32: bool = False) -> DataFrame | None:
    """One provider feed -> canonical bars.

    * P1: a feed without a date column is rejected (returns None).
    * P3: dates are parsed coercively (bad text -> NULL) and NULL dates dropped.
    * P5: a constant symbol is added when the feed carries none.
    * columns are matched by NAME, cast to the fixed types; NaN -> NULL.
    * ``float32=True`` rounds prices through single precision like the
      reference's FloatType schema.
    """
    renamed = {src: dst for src, dst in mapping.items() if src in raw.columns}
    if "date" not in renamed.values() and "date" not in raw.columns:
        return None
    df = raw
    for src, dst in renamed.items():
        if src != dst:
            df = df.withColumnRenamed(src, dst)
    if symbol is not None:
        df = df.withColumn("symbol", F.lit(symbol))
    date_type = dict(df.dtypes)["date"]
    if date_type in ("date",):
        date = F.col("date")
    elif date_type.startswith("timestamp"):
        date = F.col("date").cast("date")
    else:
        date = F.try_to_timestamp(F.col("date").cast("string")).cast("date")
    cols = [date.alias("date"), F.col("symbol").cast("string").alias("symbol")]
    for name in PRICE_COLUMNS:
        if name in df.columns:
            c = nan_to_null(F.col(name).cast("double"))
            if float32:
                c = c.cast("float").cast("double")
        else:
            c = F.lit(None).cast("double")
        cols.append(c.alias(name))
    vol = F.col("volume").cast("bigint") if "volume" in df.columns else F.lit(None).cast("bigint")
    cols.append(vol.alias("volume"))
    return df.select(*cols).where(F.col("date").isNotNull())


#: What a row can break, in the order it is told (fixed names of the rules).
RULES = ("no_date", "bad_date", "no_symbol", "long_symbol", "bad_number")


def screen(raw: DataFrame, symbol: str | None = None, mapping: Mapping[str, str] = PROVIDER_COLUMNS,
           max_len: int = 9, keep_null_dates: bool = False) -> DataFrame:
    """One feed as canonical bars, with ``broken``: the rules (``RULES``) that
    each row breaks, and ``raw_date``, the date as it came.

    ``no_date`` is a missing date, ``bad_date`` text that is none,
    ``long_symbol`` one of more than ``max_len`` characters, ``bad_number`` text
    that is no number. NaN is a missing value (D2), no fault. With
    ``keep_null_dates`` (P4, the re-read) rows may lack a date.
    """
    df = raw.toDF(*[mapping.get(c, c) for c in raw.columns])
    if symbol is not None:
        df = df.withColumn("symbol", F.lit(symbol))
    if "date" not in df.columns:
        df = df.withColumn("date", F.lit(None).cast("string"))
    kinds = dict(df.dtypes)
    text = F.col("date").cast("string")
    date = F.col("date").cast("date") if kinds["date"] in ("date", "timestamp", "timestamp_ntz") else F.try_to_timestamp(text).cast("date")
    out, faults = [], []
    for name in [*PRICE_COLUMNS, "volume"]:
        kind = "bigint" if name == "volume" else "double"
        if name not in df.columns:
            out.append(F.lit(None).cast(kind).alias(name))
            continue
        number = F.col(name).try_cast(kind)
        faults.append(F.col(name).isNotNull() & number.isNull() & ~(F.col(name).try_cast("double").isNotNull() & F.isnan(F.col(name).try_cast("double"))))
        out.append((nan_to_null(number) if kind == "double" else number).alias(name))
    sym = F.col("symbol").cast("string") if "symbol" in df.columns else F.lit(None).cast("string")
    bad = {"no_date": F.col("date").isNull() & F.lit(not keep_null_dates),
           "bad_date": F.col("date").isNotNull() & date.isNull() & F.lit(not keep_null_dates),
           "no_symbol": sym.isNull(), "long_symbol": F.coalesce(F.length(sym) > max_len, F.lit(False)),
           "bad_number": F.array_max(F.array(*faults)) if faults else F.lit(False)}
    broken = F.filter(F.array(*[F.when(bad[r], F.lit(r)) for r in RULES]), lambda r: r.isNotNull())
    return df.select(date.alias("date"), sym.alias("symbol"), *out, text.alias("raw_date"), broken.alias("broken"))


def quarantine(screened: DataFrame, path: str) -> dict[str, int]:
    """Writes ``screen``'s rows in one pass, good and rejected ones apart
    (folders ``ok=true`` and ``ok=false`` under ``path``), and returns how many
    rows there were, how many are rejected, and how many break each rule, as
    observed by that pass. Read them with ``accepted`` and ``rejected``."""
    from pyspark.sql import Observation
    seen = Observation()
    ok = F.size("broken") == 0
    (screened.withColumn("ok", ok).observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("ok")).alias("rejected"),
        *[F.count_if(F.array_contains("broken", r)).alias(r) for r in RULES])
     .write.mode("overwrite").partitionBy("ok").parquet(path))
    return dict(seen.get)


def _screened(spark: SparkSession, path: str) -> DataFrame:
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BAR_SCHEMA.fields)
    return spark.read.schema(f"{kinds}, raw_date string, broken array<string>, ok boolean").parquet(path)


def accepted(spark: SparkSession, path: str) -> DataFrame:
    return _screened(spark, path).where("ok").select(*BAR_COLUMNS)


def rejected(spark: SparkSession, path: str) -> DataFrame:
    return _screened(spark, path).where("NOT ok").drop("ok")


def union_feeds(feeds: Mapping[str, DataFrame], **kw) -> DataFrame:
    """Normalise every feed and union them by name; feeds without a date
    column are skipped (P1) and the others proceed."""
    out = None
    for sym, raw in feeds.items():
        df = normalize(raw, symbol=sym, **kw)
        if df is None:
            continue
        out = df if out is None else out.unionByName(df)
    if out is None:
        raise ValueError("no feed has a date column")
    return out


def provider_feed(bars: DataFrame) -> DataFrame:
    """Render canonical bars in the provider layout (date as text) — the
    inverse of ``normalize``; used to exercise the ingestion path on data
    derived from the given tables."""
    inv = {v: k for k, v in PROVIDER_COLUMNS.items()}
    return bars.select(
        F.date_format("date", "yyyy-MM-dd").alias(inv["date"]),
        *[F.col(c).alias(inv[c]) for c in ["adj_close", "close", "high", "low", "open", "volume"]],
        F.col("symbol").alias(inv["symbol"]),
    )
