"""Recursive exponential moving averages (pandas ``ewm(span, adjust=False)``).

The first value starts the average; after g - 1 missing rows, with c = 1 - alpha,
the next value v makes y = (c^g y + alpha v) / (c^g + alpha). Missing rows repeat
the last average, rows before the first value have none.

A value is thus an affine map of the average before it. Rows fall into blocks of
the calendar; inside a block, window functions compose the maps of its rows, and
a block as a whole is a map again. The blocks' maps of one series, a few numbers
for each (the calendar bounds them: at most 4,074 blocks of 128 weeks in the years 1
to 9999), are folded into the average each block starts from, which finishes its
rows. All of it is JVM expressions, and a long series spreads over tasks by
block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Days of a block: 128 weekly rows, so that products of factors stay far from
#: the smallest double for any span of 2 and above.
BLOCK_DAYS = 896


def _maps(df: DataFrame, key: str, order: str, source: str, spans: list[float]) -> DataFrame:
    """Adds, per row: ``_n`` (its place in the block), ``_m`` and ``_v`` (place and
    value of the block's first value), ``_t`` (place of its last value so far)
    and for each span ``_p{i}``, ``_s{i}``: the average is p (y + s), if y is the
    average at the block's first value."""
    w = f"PARTITION BY `{key}`, _block ORDER BY `{order}` ROWS BETWEEN UNBOUNDED PRECEDING AND"
    so_far, whole, before = (f"({w} {end})" for end in ("CURRENT ROW", "UNBOUNDED FOLLOWING", "1 PRECEDING"))
    has = "CASE WHEN _x IS NOT NULL THEN _n END"
    df = df.selectExpr("*", f"`{source}` AS _x", f"row_number() OVER {so_far} AS _n")
    df = df.selectExpr("*", f"min({has}) OVER {whole} AS _m", f"first(_x, true) OVER {whole} AS _v",
                       f"max({has}) OVER {so_far} AS _t", f"_n - max({has}) OVER {before} AS _g")
    after = "CASE WHEN _x IS NOT NULL AND _g IS NOT NULL THEN"
    decays, factors = [], []
    for i, span in enumerate(spans):
        alpha = 2.0 / (span + 1.0)
        decays.append(f"pow({1.0 - alpha!r}D, CAST(_g AS DOUBLE)) AS _d{i}")
        factors += [f"{after} _d{i} / (_d{i} + {alpha!r}D) ELSE 1D END AS _a{i}",
                    f"{after} {alpha!r}D * _x / (_d{i} + {alpha!r}D) ELSE 0D END AS _b{i}"]
    df = df.selectExpr("*", *decays).selectExpr("*", *factors)
    running = Window.partitionBy(key, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.select("*", *[F.product(f"_a{i}").over(running).alias(f"_p{i}") for i in range(len(spans))])
    return df.selectExpr("*", *[f"sum(_b{i} / _p{i}) OVER {so_far} AS _s{i}" for i in range(len(spans))])


def _first(y: str, gap: str, v: str, span: float) -> str:
    """The average at a value ``gap`` rows after the last one."""
    alpha = 2.0 / (span + 1.0)
    decay = f"pow({1.0 - alpha!r}D, CAST({gap} AS DOUBLE))"
    return f"CASE WHEN {y} IS NULL THEN {v} ELSE ({decay} * {y} + {alpha!r}D * {v}) / ({decay} + {alpha!r}D) END"


def _entries(maps: DataFrame, key: str, spans: list[float]) -> DataFrame:
    """(_key, _of, _k, _y0, _y1, ...): rows since the last value, and the
    averages, before each block."""
    each = range(len(spans))
    totals = maps.groupBy(key, "_block").agg(
        F.expr("max(_n) AS n"), F.expr("max(_m) AS m"), F.expr("max(_v) AS v"), F.expr("max(_t) AS t"),
        *[F.expr(f"max_by(_{c}{i}, _n) AS {c}{i}") for i in each for c in "ps"])
    fields = ["n", "m", "v", "t", *[f"{c}{i}" for i in each for c in "ps"]]
    blocks = totals.groupBy(key).agg(F.expr(f"sort_array(collect_list(struct(_block, {', '.join(fields)}))) AS _blocks"))
    kinds = ", ".join(f"_y{i}: DOUBLE" for i in each)
    entry = ", ".join(f"'_y{i}', acc.last._y{i}" for i in each)
    after = ", ".join(
        f"'_y{i}', CASE WHEN b.m IS NULL THEN acc.last._y{i} ELSE b.p{i} * ("
        + _first(f"acc.last._y{i}", "(acc.last._k + b.m)", "b.v", s) + f" + b.s{i}) END" for i, s in enumerate(spans))
    none = ", ".join(f"'_y{i}', CAST(NULL AS DOUBLE)" for i in each)
    scan = f"""inline(aggregate(_blocks,
        named_struct('out', CAST(array() AS ARRAY<STRUCT<_of: BIGINT, _k: BIGINT, {kinds}>>), 'last', named_struct('_k', 0L, {none})),
        (acc, b) -> named_struct(
            'out', concat(acc.out, array(named_struct('_of', b._block, '_k', acc.last._k, {entry}))),
            'last', named_struct('_k', CASE WHEN b.m IS NULL THEN acc.last._k + b.n ELSE CAST(b.n - b.t AS BIGINT) END, {after})),
        acc -> acc.out))"""
    return blocks.selectExpr(f"`{key}` AS _key", scan)


def add_emas(df: DataFrame, specs: list[tuple[str, str, float]],
             key: str = "symbol", order: str = "date", block_days: int = BLOCK_DAYS) -> DataFrame:
    """Appends an EMA column for every (output, source, span); the specs share
    one source. ``order`` is a date, unique per ``key``. The plan reads ``df``
    twice (maps of the blocks, rows): persist an expensive one."""
    sources = {s for _, s, _ in specs}
    if len(sources) != 1:
        raise ValueError(f"one source expected, got {sorted(sources)}")
    spans = [s for *_, s in specs]
    block = f"floor(datediff(`{order}`, DATE'1970-01-01') / {block_days}) AS _block"
    maps = _maps(df.selectExpr("*", block), key, order, *sources, spans)
    out = maps.join(_entries(maps, key, spans), F.expr(f"`{key}` <=> _key AND _block = _of"))
    kept = [f"`{c}`" for c in df.columns]
    return out.selectExpr(*kept, *[
        f"CASE WHEN _t IS NULL THEN _y{i} ELSE _p{i} * (" + _first(f"_y{i}", "(_k + _m)", "_v", span) + f" + _s{i}) END AS `{name}`"
        for i, (name, _, span) in enumerate(specs)])
