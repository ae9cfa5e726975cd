"""DuckDB SQL oracles for the registered queries.

Each oracle recomputes its query from the raw views (``lineitem``, ``part``)
with plain SQL: windows for the features, recursive CTEs for the EMAs and
the two backtest folds, ``generate_series`` for the weekly grid. The SQL is
assembled from shared CTE fragments so every oracle states the whole
derivation.
"""

from __future__ import annotations

from barwise.operators.features import EMA_SPECS, MODEL_FEATURES
from barwise.plans import catalog as cat


def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def div(a: str, b: str) -> str:
    """IEEE division as in ``ieee_div``."""
    return (f"(CASE WHEN ({a}) IS NULL OR ({b}) IS NULL THEN NULL "
            f"WHEN ({b}) <> 0 THEN CAST(({a}) AS DOUBLE) / ({b}) "
            f"WHEN ({a}) > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN ({a}) < 0 THEN CAST('-inf' AS DOUBLE) ELSE NULL END)")


def rnd(expr: str, n: int = 6, name: str | None = None) -> str:
    return f'round("{expr}", {n}) AS "{name or expr}"'


_KEY = ("struct_pack(a := l_orderkey, b := l_linenumber, c := l_partkey, d := l_suppkey, "
        "e := l_extendedprice, f := l_quantity)")

DAILY = f"""daily AS (
  SELECT CAST(l_shipdate AS DATE) AS date, {cat.SYMBOL_COLUMN} AS symbol,
    arg_min(l_extendedprice / l_quantity, {_KEY}) AS open,
    max(l_extendedprice / l_quantity) AS high,
    min(l_extendedprice / l_quantity) AS low,
    arg_max(l_extendedprice / l_quantity, {_KEY}) AS close,
    arg_max(l_extendedprice / l_quantity * (1 - l_discount), {_KEY}) AS adj_close,
    CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem JOIN part ON p_partkey = l_partkey
  GROUP BY 1, 2)"""

WEEKLY = f"""stocks AS (SELECT * FROM daily WHERE symbol <> '{cat.BENCHMARK}'),
wk_agg AS (
  SELECT symbol, CAST(date + CAST(((4 - (isodow(date) - 1)) % 7 + 7) % 7 AS INTEGER) AS DATE) AS wk,
    arg_min(open, date) FILTER (WHERE open IS NOT NULL) AS open,
    max(high) AS high, min(low) AS low,
    arg_max(close, date) FILTER (WHERE close IS NOT NULL) AS close,
    arg_max(adj_close, date) FILTER (WHERE adj_close IS NOT NULL) AS adj_close,
    CAST(COALESCE(sum(volume), 0) AS BIGINT) AS volume
  FROM stocks GROUP BY 1, 2),
bounds AS (SELECT symbol, min(wk) AS lo, max(wk) AS hi FROM wk_agg GROUP BY symbol),
grid AS (
  SELECT symbol, CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP),
                                              INTERVAL 7 DAY)) AS DATE) AS date
  FROM bounds),
weekly AS (
  SELECT g.symbol, g.date, a.open, a.high, a.low, a.close, a.adj_close,
         CAST(COALESCE(a.volume, 0) AS BIGINT) AS volume
  FROM grid g LEFT JOIN wk_agg a ON a.symbol = g.symbol AND a.wk = g.date)"""

_W = "PARTITION BY symbol ORDER BY date"


def _gate(n: int, x: str, agg: str) -> str:
    return (f"CASE WHEN count({x}) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN {n - 1} "
            f"PRECEDING AND CURRENT ROW) >= {n} THEN {agg}({x}) OVER (PARTITION BY symbol ORDER BY "
            f"date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END")


def _moments() -> tuple[str, str]:
    """Skew/kurt of the last 4 weekly returns from central moment sums,
    mirroring Spark's population formulas plus the sample correction."""
    xs = ["weekly_return"] + [f"weekly_return_lag_{k}w" for k in range(1, 4)]
    mean = "((" + " + ".join(xs) + ") / 4)"
    dev = [f"({x} - {mean})" for x in xs]
    m2 = " + ".join(f"{d} * {d}" for d in dev)
    m3 = " + ".join(f"{d} * {d} * {d}" for d in dev)
    m4 = " + ".join(f"{d} * {d} * {d} * {d}" for d in dev)
    ok = " AND ".join(f"{x} IS NOT NULL" for x in xs)
    corr = dbl((4 * 3) ** 0.5 / 2)
    skew = (f"CASE WHEN {ok} THEN COALESCE(CASE WHEN ({m2}) = 0 THEN NULL ELSE "
            f"sqrt(4.0) * ({m3}) / sqrt(({m2}) * ({m2}) * ({m2})) * {corr} END, 0.0) END")
    kurt = (f"CASE WHEN {ok} THEN COALESCE(CASE WHEN ({m2}) = 0 THEN NULL ELSE "
            f"(4.0 * ({m4}) / (({m2}) * ({m2})) - 3.0) * {dbl(7.5)} + {dbl(9.0)} END, -3.0) END")
    return skew, kurt


_SKEW, _KURT = _moments()
_RS = div("ag", "al")

FEATURES = f"""f1 AS (
  SELECT *,
    last_value(adj_close IGNORE NULLS) OVER wa - first_value(open IGNORE NULLS) OVER wa AS weekly_price_diff,
    max(high) OVER wa - min(low) OVER wa AS "range",
    first_value(open IGNORE NULLS) OVER wa AS first_open,
    open - lag(open) OVER w AS gap,
    avg(volume) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS volume_ma,
    adj_close - lag(adj_close) OVER w AS d1,
    lag(adj_close) OVER w AS lag_p,
    adj_close - lag(adj_close, 4) OVER w AS momentum_4w,
    adj_close - lag(adj_close, 8) OVER w AS momentum_8w,
    adj_close - lag(adj_close, 2) OVER w AS momentum_2w,
    {_gate(14, 'adj_close', 'min')} AS low14,
    {_gate(14, 'adj_close', 'max')} AS high14,
    last_value(adj_close IGNORE NULLS) OVER wc AS ffp,
    {div('volume', 'lag(volume) OVER w')} - 1 AS volume_change,
    {_gate(4, 'adj_close', 'avg')} AS rolling_mean_4w,
    {_gate(4, 'adj_close', 'stddev_samp')} AS rolling_std_4w,
    {", ".join(f"lag(adj_close, {k}) OVER w AS adj_close_lag_{k}w" for k in range(1, 5))},
    {", ".join(f"lag(volume, {k}) OVER w AS volume_lag_{k}w" for k in range(1, 5))}
  FROM weekly
  WINDOW w AS ({_W}),
         wc AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         wa AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
f2 AS (
  SELECT *,
    {div('"range"', 'first_open')} AS volatility,
    {div('adj_close', '"range"')} AS price_to_range_ratio,
    sum(COALESCE(CAST(sign(d1) AS DOUBLE) * volume, 0.0)) OVER wc AS obv,
    CASE WHEN d1 IS NOT NULL THEN greatest(d1, 0.0) END AS gain,
    CASE WHEN d1 IS NOT NULL THEN -least(d1, 0.0) END AS loss,
    {div('ffp', 'lag(ffp) OVER w')} - 1 AS weekly_return,
    high - low AS hl, abs(high - lag_p) AS hc, abs(low - lag_p) AS lc,
    (high + low + adj_close) / 3 AS "pivot",
    {div('volume', 'volume_ma')} AS volume_ratio,
    {div('adj_close - low14', 'high14 - low14')} * 100 AS stoch_k,
    rolling_mean_4w + 2 * rolling_std_4w AS bollinger_upper,
    rolling_mean_4w - 2 * rolling_std_4w AS bollinger_lower
  FROM f1
  WINDOW w AS ({_W}), wc AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f3 AS (
  SELECT *,
    CASE WHEN count(gain) OVER w2 >= 1 THEN avg(gain) OVER w2 END AS ag,
    CASE WHEN count(loss) OVER w2 >= 1 THEN avg(loss) OVER w2 END AS al,
    lead(weekly_return) OVER w AS next_weekly_return,
    {", ".join(f"lag(weekly_return, {k}) OVER w AS weekly_return_lag_{k}w" for k in range(1, 9))},
    weekly_return AS adj_close_change,
    {div('weekly_return', 'rolling_std_4w')} AS sharpe_ratio,
    greatest(hl, hc, lc) AS tr,
    adj_close - "pivot" AS pivot_distance,
    adj_close - (2 * "pivot" - high) AS support_distance,
    adj_close - (2 * "pivot" - low) AS resistance_distance,
    {div('bollinger_upper - bollinger_lower', 'rolling_mean_4w')} AS bollinger_bandwidth,
    CAST(isodow(date) - 1 AS INTEGER) AS day_of_week,
    CAST(weekofyear(date) AS INTEGER) AS week_of_year,
    CAST(month(date) AS INTEGER) AS month
  FROM f2
  WINDOW w AS ({_W}), w2 AS ({_W} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
f4 AS (
  SELECT *,
    CASE WHEN {_RS} IS NULL THEN NULL WHEN {_RS} = CAST('inf' AS DOUBLE) THEN 100.0
         ELSE 100.0 - 100.0 / (1.0 + {_RS}) END AS rsi_2w,
    {_gate(3, 'stoch_k', 'avg')} AS stoch_d,
    {_gate(14, 'tr', 'avg')} AS atr,
    {_SKEW} AS rolling_skew_4w,
    {_KURT} AS rolling_kurt_4w
  FROM f3),
wf AS (
  SELECT *,
    (rsi_2w - 30) / (70 - 30) AS normalized_rsi_2w,
    stoch_k - stoch_d AS stochastic_k_d_distance,
    {div('atr', 'adj_close')} * 100 AS atr_percentage
  FROM f4)"""


def _ema_cte() -> str:
    """EMAs by recursion over each symbol's rows (the plain recurrence)."""
    direct = [(n, s) for n, src, s in EMA_SPECS if src == "adj_close"]
    sig = [(n, "ema12-ema26", s) for n, src, s in EMA_SPECS if src == "macd"]

    def step(y: str, w: str, x: str, span: float) -> tuple[str, str]:
        a = 2.0 / (span + 1.0)
        c = 1.0 - a
        ynew = (f"CASE WHEN e.{y} IS NULL THEN {x} WHEN {x} IS NULL THEN e.{y} "
                f"WHEN e.{y} = {x} THEN e.{y} ELSE (e.{w} * {dbl(c)} * e.{y} + {dbl(a)} * {x}) / "
                f"(e.{w} * {dbl(c)} + {dbl(a)}) END")
        wnew = f"CASE WHEN e.{y} IS NULL THEN 1.0 WHEN {x} IS NULL THEN e.{w} * {dbl(c)} ELSE 1.0 END"
        return ynew, wnew

    init = ", ".join(f"x AS {n}, CAST(1.0 AS DOUBLE) AS w_{n}" for n, _ in direct)
    rec = []
    for n, s in direct:
        ynew, wnew = step(n, f"w_{n}", "b.x", s)
        rec.append(f"{ynew} AS {n}, {wnew} AS w_{n}")
    out = f"""eb AS (SELECT symbol, date, adj_close AS x, row_number() OVER ({_W}) AS rn FROM weekly),
ema1 AS (
  SELECT symbol, rn, date, {init} FROM eb WHERE rn = 1
  UNION ALL
  SELECT b.symbol, b.rn, b.date, {", ".join(rec)}
  FROM ema1 e JOIN eb b ON b.symbol = e.symbol AND b.rn = e.rn + 1)"""
    for n, src, s in sig:
        left, right = src.split("-")
        x = f"(b.{left} - b.{right})"
        ynew, wnew = step(n, f"w_{n}", x, s)
        out += f""",
ema2 AS (
  SELECT symbol, rn, date, {left} - {right} AS {n}, CAST(1.0 AS DOUBLE) AS w_{n} FROM ema1 WHERE rn = 1
  UNION ALL
  SELECT b.symbol, b.rn, b.date, {ynew} AS {n}, {wnew} AS w_{n}
  FROM ema2 e JOIN ema1 b ON b.symbol = e.symbol AND b.rn = e.rn + 1),
ema AS (
  SELECT a.symbol, a.date, {", ".join(f"a.{m}" for m, _ in direct)}, b.{n},
         a.ema12 - a.ema26 AS macd, a.ema12 - a.ema26 - b.{n} AS macd_distance,
         a.macd_short - a.macd_long AS macd_diff
  FROM ema1 a JOIN ema2 b ON a.symbol = b.symbol AND a.rn = b.rn)"""
    return out


EMA = _ema_cte()

VWAP = f"""vw AS (
  SELECT symbol, date,
    CASE WHEN adj_close IS NOT NULL THEN {div('sum(adj_close * volume) OVER g', 'sum(volume) OVER g')} END AS vwap,
    adj_close
  FROM weekly
  WINDOW g AS (ORDER BY symbol, date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
vwap AS (SELECT symbol, date, vwap, adj_close - vwap AS vwap_distance FROM vw)"""

_ALL = [c for c in MODEL_FEATURES] + ["next_weekly_return"]
FULL = f"""full_f AS (
  SELECT wf.*, ema.ema12, ema.ema26, ema.macd, ema.signal_line, ema.macd_distance,
         ema.macd_short, ema.macd_long, ema.macd_diff, vwap.vwap, vwap.vwap_distance
  FROM wf JOIN ema USING (symbol, date) JOIN vwap USING (symbol, date)),
complete AS (SELECT * FROM full_f WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in _ALL)})"""


def _period() -> str:
    b = [f"DATE '{x}'" for x in ("1995-06-01", "1999-01-01", "2000-01-01", "2001-01-01")]
    return (f"CASE WHEN date < {b[0]} THEN NULL WHEN date < {b[1]} THEN 'train' "
            f"WHEN date < {b[2]} THEN 'test' WHEN date < {b[3]} THEN 'validation' "
            f"ELSE 'prediction' END")


def scaled_rounding(sql: str) -> str:
    """Rewrite every ``round(x, n)`` as ``round(x * 10^n, 0) / 10^n`` (the
    form the Spark side uses; see ``catalog.fixed``)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0 or (j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_")):
            if j < 0:
                out.append(sql[i:])
                return "".join(out)
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k, comma = 0, j + 6, None
        while True:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                if depth == 0:
                    break
                depth -= 1
            elif ch == "," and depth == 0:
                comma = k
            k += 1
        inner, n = sql[j + 6:comma], int(sql[comma + 1:k].strip())
        scale = f"CAST({10 ** n} AS DOUBLE)"
        out.append(sql[i:j] + f"(round(({scaled_rounding(inner)}) * {scale}, 0) / {scale} + 0.0)")
        i = k + 1


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


BASE = (DAILY, WEEKLY)


def _window_group(cols: list[str], digits: int = 6) -> str:
    return (with_(*BASE, FEATURES)
            + "SELECT symbol, date, " + ", ".join(rnd(c, digits) for c in cols) + " FROM wf")


# ---------------------------------------------------------------- backtest SQL

def _grid_values(rows) -> str:
    vals = ", ".join(
        f"('{sid}', {k}, {dbl(tp)}, {dbl(fee)}, {dbl(cash)}, {dbl(rf)})"
        for sid, k, tp, fee, cash, rf in rows)
    return (f"scen AS (SELECT * FROM (VALUES {vals}) "
            "t(scenario_id, k, take_profit, fee, initial_cash, risk_free))")


def _sweep_rows():
    s = cat.SWEEP
    return [(f"k{kk}_tp{tp}_fee{ff}", int(kk), float(tp), float(ff), 100000.0, 0.0)
            for kk in s["k"] for tp in s["take_profit"] for ff in s["fee"]]


def _default_rows():
    return [("k5_tp0.04_fee0.001", 5, 0.04, 0.001, 100000.0, 0.0)]


SIGNALS = f"""sig_ff AS (
  SELECT symbol, date, last_value(adj_close IGNORE NULLS) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ffp
  FROM weekly),
sig AS (SELECT date, symbol, {div('ffp', f'lag(ffp) OVER ({_W})')} - 1 AS predicted_return FROM sig_ff)"""

NEXTBAR = f"""nb AS (
  SELECT symbol, date, open, close, lead(date) OVER ({_W}) AS next_date, lead(open) OVER ({_W}) AS next_open
  FROM daily)"""

_PP = "(CASE WHEN s.holding THEN s.pp ELSE b.next_open END)"
_RET = f"((b.next_open - {_PP}) / {_PP})"


def _floordiv(a: str, b: str) -> str:
    # DuckDB's ``%`` on doubles is the exact IEEE remainder (its fmod() is not).
    d = f"((({a}) - (CAST({a} AS DOUBLE) % CAST({b} AS DOUBLE))) / ({b}))"
    return f"({d} - {d} % CAST(1 AS DOUBLE) + CASE WHEN {d} % CAST(1 AS DOUBLE) > 0.5 THEN 1.0 ELSE 0.0 END)"


_SHARES = f"greatest(1.0, {_floordiv('s.cash / 3', 'b.price')})"
_BUY_CASH = f"(s.cash - {_SHARES} * b.price * (1 + b.fee))"
_SELL_SH = "list_filter(s.held, lambda h: h.symbol = b.symbol)[1].shares"
_SELL_CASH = f"(s.cash + {_SELL_SH} * b.price * (1 - b.fee))"


def _held_value(held: str) -> str:
    return f"list_reduce(list_sort({held}), lambda acc, h: acc + h.shares * b.close, CAST(0.0 AS DOUBLE))"


def backtest_ctes(rows) -> list[str]:
    buy_held = (f"list_append(s.held, struct_pack(symbol := b.symbol, shares := "
                f"CAST({_SHARES} AS DOUBLE)))")
    return [
        _grid_values(rows),
        SIGNALS,
        NEXTBAR,
        """top AS (
  SELECT g.scenario_id, g.take_profit, s.date, s.symbol, s.predicted_return,
         row_number() OVER (PARTITION BY g.scenario_id, s.date ORDER BY s.predicted_return DESC NULLS LAST, s.symbol ASC) AS rank,
         g.k
  FROM sig s CROSS JOIN scen g
  QUALIFY rank <= g.k)""",
        """trad AS (
  SELECT t.scenario_id, t.take_profit, t.date, t.symbol, nb.close, nb.next_date, nb.next_open,
         row_number() OVER (PARTITION BY t.scenario_id, t.symbol ORDER BY t.date) AS rn
  FROM top t JOIN nb ON nb.symbol = t.symbol AND nb.date = t.date WHERE nb.next_date IS NOT NULL)""",
        f"""st1 AS (
  SELECT scenario_id, symbol, rn, date, next_date, next_open, close, take_profit,
         TRUE AS bought, next_open AS pp, CAST(0.0 AS DOUBLE) AS ret,
         (CAST(0.0 AS DOUBLE) >= take_profit) AS sold, NOT (CAST(0.0 AS DOUBLE) >= take_profit) AS holding
  FROM trad WHERE rn = 1
  UNION ALL
  SELECT b.scenario_id, b.symbol, b.rn, b.date, b.next_date, b.next_open, b.close, b.take_profit,
         NOT s.holding, {_PP}, {_RET}, {_RET} >= b.take_profit, NOT ({_RET} >= b.take_profit)
  FROM st1 s JOIN trad b ON b.scenario_id = s.scenario_id AND b.symbol = s.symbol AND b.rn = s.rn + 1)""",
        """acts AS (
  SELECT scenario_id, symbol, date AS signal_date, next_date AS trade_date, 'buy' AS action, 0 AS ord,
         next_open AS price, close, CAST(0.0 AS DOUBLE) AS ret FROM st1 WHERE bought
  UNION ALL
  SELECT scenario_id, symbol, date, next_date, 'sell', 1, next_open, close, ret FROM st1 WHERE sold)""",
        """acts_n AS (
  SELECT a.*, g.fee, g.initial_cash,
         row_number() OVER (PARTITION BY a.scenario_id ORDER BY a.signal_date, a.symbol, a.ord) - 1 AS seq
  FROM acts a JOIN scen g USING (scenario_id))""",
        f"""led AS (
  SELECT b.scenario_id, b.seq, b.signal_date, b.trade_date, b.symbol, b.action, b.price,
         CAST({_SHARES.replace('s.cash', 'b.initial_cash')} AS DOUBLE) AS shares,
         {_BUY_CASH.replace('s.cash', 'b.initial_cash')} AS cash,
         [struct_pack(symbol := b.symbol, shares := CAST({_SHARES.replace('s.cash', 'b.initial_cash')} AS DOUBLE))] AS held,
         {_BUY_CASH.replace('s.cash', 'b.initial_cash')} + {_SHARES.replace('s.cash', 'b.initial_cash')} * b.close AS portfolio_value,
         CAST(0.0 AS DOUBLE) AS profit_percentage
  FROM acts_n b WHERE b.seq = 0
  UNION ALL
  SELECT b.scenario_id, b.seq, b.signal_date, b.trade_date, b.symbol, b.action, b.price,
         CASE WHEN b.action = 'buy' THEN CAST({_SHARES} AS DOUBLE) ELSE {_SELL_SH} END,
         CASE WHEN b.action = 'buy' THEN {_BUY_CASH} ELSE {_SELL_CASH} END,
         CASE WHEN b.action = 'buy' THEN {buy_held}
              ELSE list_filter(s.held, lambda h: h.symbol <> b.symbol) END,
         CASE WHEN b.action = 'buy' THEN {_BUY_CASH} + {_held_value(buy_held)}
              ELSE {_SELL_CASH} + {_held_value('s.held')} END,
         CASE WHEN b.action = 'buy' THEN CAST(0.0 AS DOUBLE) ELSE b.ret * 100 END
  FROM led s JOIN acts_n b ON b.scenario_id = s.scenario_id AND b.seq = s.seq + 1)""",
        """last_state AS (
  SELECT scenario_id, cash, held FROM led
  QUALIFY row_number() OVER (PARTITION BY scenario_id ORDER BY seq DESC) = 1)""",
        """lastc AS (SELECT symbol, arg_max(struct_pack(c := close), date).c AS last_close FROM daily GROUP BY symbol)""",
        """marks AS (
  SELECT true AS holds, ls.scenario_id,
         list_reduce(list_sort(list(struct_pack(symbol := h.symbol, v := h.shares * lc.last_close))),
                     lambda acc, x: acc + x.v, CAST(0.0 AS DOUBLE)) AS held_value
  FROM last_state ls, unnest(ls.held) u(h) JOIN lastc lc ON lc.symbol = h.symbol
  GROUP BY ls.scenario_id)""",
        """stats AS (
  SELECT scenario_id, count(*) AS trades, avg(ret) AS mean_return, stddev_pop(ret) AS std_return
  FROM acts WHERE action = 'sell' GROUP BY scenario_id)""",
        """summary AS (
  SELECT g.scenario_id,
         COALESCE(ls.cash, g.initial_cash) + CASE WHEN m.holds THEN m.held_value ELSE 0.0 END AS final_portfolio_value,
         COALESCE(ls.cash, g.initial_cash) + CASE WHEN m.holds THEN m.held_value ELSE 0.0 END - g.initial_cash AS net_profit,
         (COALESCE(ls.cash, g.initial_cash) + CASE WHEN m.holds THEN m.held_value ELSE 0.0 END - g.initial_cash) / g.initial_cash * 100 AS roi,
         CASE WHEN COALESCE(st.trades, 0) = 0 THEN 0.0
              ELSE (st.mean_return - g.risk_free) / (st.std_return + 1e-8) END AS sharpe_ratio,
         CAST(COALESCE(st.trades, 0) AS BIGINT) AS trades
  FROM scen g LEFT JOIN last_state ls USING (scenario_id) LEFT JOIN marks m USING (scenario_id)
       LEFT JOIN stats st USING (scenario_id))""",
    ]


def _bt(rows=None) -> str:
    return with_(*BASE, *backtest_ctes(rows or _sweep_rows()))


_SUMMARY_SELECT = ("SELECT scenario_id, round(final_portfolio_value, 2) AS final_portfolio_value, "
                   "round(net_profit, 2) AS net_profit, round(roi, 4) AS roi, "
                   "round(sharpe_ratio, 4) AS sharpe_ratio, trades FROM summary")

_PRICE = ["open", "high", "low", "close", "adj_close"]


def _model_facts(*learners: str) -> str:
    names = ", ".join(f"('{x}')" for x in learners)
    return with_(*BASE, FEATURES, EMA, VWAP, FULL) + f"""SELECT learner, period, count(*) AS n, CAST(0 AS BIGINT) AS null_predictions,
  CASE WHEN period = 'train' THEN true END AS beats_std
FROM (SELECT *, {_period()} AS period FROM complete), (VALUES {names}) l(learner) WHERE period IS NOT NULL
GROUP BY learner, period"""


def _boost_tree() -> str:
    """One tree of two levels: split gains and leaves from plain sums."""
    from barwise.operators.boosting import MAX_BINS
    from barwise.plans.learn import TREE_FEATURES, TREE_PARAMS
    p = TREE_PARAMS
    soft = lambda g: f"(sign({g}) * greatest(abs({g}) - {p['alpha']}, 0))"
    score = lambda g, h: f"({soft(g)} * {soft(g)} / ({h} + {p['lambda_']}))"
    names = ", ".join(f"('{f}', {i})" for i, f in enumerate(TREE_FEATURES))
    values = "CASE feature " + " ".join(f"""WHEN '{f}' THEN CAST("{f}" AS DOUBLE)""" for f in TREE_FEATURES) + " END"
    at = "[" + ", ".join(repr(k / MAX_BINS) for k in range(1, MAX_BINS)) + "]"

    def level(n: int) -> str:
        return f"""sums{n} AS (
  SELECT path, c.feature, c.k, c.edge, sum(g) FILTER (v <= c.edge) AS gl, count(*) FILTER (v <= c.edge) AS hl, sum(g) AS g, count(*) AS h
  FROM node{n} JOIN edges c USING (feature) GROUP BY path, c.feature, c.k, c.edge),
best{n} AS (
  SELECT * FROM (SELECT *, {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} AS gain FROM sums{n}
    WHERE hl >= {p['min_child']} AND h - hl >= {p['min_child']})
  QUALIFY row_number() OVER (PARTITION BY path ORDER BY gain DESC, k, edge) = 1 AND gain > 0),
node{n + 1} AS (
  SELECT r.id, r.feature, r.k, r.v, r.g, r.path || CASE WHEN s.v <= b.edge THEN 'L' ELSE 'R' END AS path
  FROM node{n} r JOIN best{n} b ON b.path = r.path JOIN node{n} s ON s.id = r.id AND s.feature = b.feature)"""

    leaf = f"-{p['rate']} * {soft('sum(g)')} / (count(*) + {p['lambda_']})"
    return with_(*BASE, FEATURES, EMA, VWAP, FULL).rstrip() + f""",
train AS (
  SELECT *, row_number() OVER () AS id FROM complete WHERE {_period()} = 'train'),
node0 AS (
  SELECT id, feature, k, {values} AS v, (SELECT avg(next_weekly_return) FROM train) - next_weekly_return AS g, '' AS path
  FROM train, (VALUES {names}) n(feature, k)),
edges AS (
  SELECT DISTINCT feature, k, edge FROM (
    SELECT feature, k, unnest(quantile_disc(v, {at})) AS edge, max(v) AS top FROM node0 GROUP BY feature, k) WHERE edge < top),
{level(0)},
{level(1)},
ends AS (
  SELECT path, feature, g FROM node2 UNION ALL
  SELECT path, feature, g FROM node1 WHERE path NOT IN (SELECT path FROM best1) UNION ALL
  SELECT path, feature, g FROM node0 WHERE path NOT IN (SELECT path FROM best0))
SELECT path, feature, round(edge, 6) AS threshold, round(gain, 1) AS gain, CAST(NULL AS DOUBLE) AS value
FROM (SELECT * FROM best0 UNION ALL SELECT * FROM best1)
UNION ALL
SELECT path, NULL, NULL, NULL, round({leaf}, 4) FROM ends WHERE feature = '{TREE_FEATURES[0]}' GROUP BY path"""


def oracle_sql() -> dict[str, str]:
    absent = ", ".join(f"('{s}')" for s in cat.ABSENT_SYMBOLS)
    batch = f"""batch AS (
  SELECT *, 1 AS arrival FROM daily
  UNION ALL
  SELECT date, symbol, open, high, low, close, close AS adj_close, volume, 2 AS arrival
  FROM daily WHERE date >= DATE '{cat.STORED_BEFORE}')"""
    bench = f"""bm_ff AS (
  SELECT date, last_value(adj_close IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ffp
  FROM daily WHERE symbol = '{cat.BENCHMARK}'),
bm AS (SELECT date, ({div('ffp', 'lag(ffp) OVER (ORDER BY date)')} - 1) * 100 AS benchmark_return FROM bm_ff)"""
    flags = DAILY.replace(f"{cat.SYMBOL_COLUMN} AS symbol", "l_returnflag AS symbol").replace("FROM lineitem JOIN part ON p_partkey = l_partkey", "FROM lineitem")
    weeks = WEEKLY.replace(f"SELECT * FROM daily WHERE symbol <> '{cat.BENCHMARK}'", "SELECT * FROM daily")
    out = {
        "asof_bars": with_(flags, weeks) + """SELECT w.symbol, w.date, b.date AS last_date, round(b.close, 4) AS last_close,
  n.date AS next_date, round(n.open, 4) AS next_open
FROM weekly w ASOF LEFT JOIN daily b ON b.symbol = w.symbol AND b.date <= w.date
ASOF LEFT JOIN daily n ON n.symbol = w.symbol AND n.date > w.date""",
        "daily_bars": with_(DAILY) + "SELECT date, symbol, "
        + ", ".join(rnd(c, 4) for c in _PRICE) + ", volume FROM daily",
        "universe_filter": with_(DAILY) + f"""SELECT date, symbol, round(adj_close, 4) AS adj_close, volume
FROM daily WHERE symbol IN (SELECT p_brand FROM part UNION SELECT * FROM (VALUES {absent}) t(s))
  AND date >= DATE '{cat.UNIVERSE_START}' AND date < DATE '{cat.UNIVERSE_END}'""",
        "stored_loads": with_(DAILY) + f"""SELECT CASE WHEN date < DATE '{cat.STORED_BEFORE}' THEN 1 ELSE 2 END AS step,
  CAST(year(date) * 100 + month(date) AS INTEGER) AS month, date, symbol, round(adj_close, 4) AS adj_close, volume FROM daily""",
        "feed_quarantine": with_(DAILY).rstrip() + """,
feed AS (SELECT *, day(date) AS d, strftime(date, '%Y-%m-%d') AS iso FROM daily),
dirty AS (SELECT *, CASE d WHEN 3 THEN NULL WHEN 5 THEN 'n/a' WHEN 7 THEN substr(iso, 1, 8) || '41' WHEN 9 THEN '' ELSE iso END AS raw_date,
  CASE WHEN d IN (3, 11) THEN NULL WHEN d IN (7, 13) THEN symbol || '-delisted' ELSE symbol END AS name,
  CASE WHEN d = 15 THEN 'NaN' WHEN d IN (7, 17) THEN '1,5' ELSE CAST(adj_close AS VARCHAR) END AS price FROM feed),
told AS (SELECT *, array_to_string(list_filter([CASE WHEN raw_date IS NULL THEN 'no_date' END,
    CASE WHEN raw_date IS NOT NULL AND try_cast(raw_date AS DATE) IS NULL THEN 'bad_date' END,
    CASE WHEN name IS NULL THEN 'no_symbol' END, CASE WHEN length(name) > 9 THEN 'long_symbol' END,
    CASE WHEN try_cast(price AS DOUBLE) IS NULL THEN 'bad_number' END], lambda x: x IS NOT NULL), ',') AS broken FROM dirty)
SELECT CASE WHEN broken <> '' THEN raw_date END AS raw_date, name AS symbol, volume, nullif(broken, '') AS broken,
  CASE WHEN broken = '' THEN try_cast(raw_date AS DATE) END AS date,
  CASE WHEN broken = '' AND d <> 15 THEN round(adj_close, 4) END AS adj_close FROM told""",
        "last_close": with_(DAILY) + """SELECT symbol, round(arg_max(struct_pack(c := CASE WHEN day(date) % 2 = 0 THEN close END), date).c, 4) AS last_close
FROM daily GROUP BY symbol""",
        "missing_symbols": with_(DAILY) + f"""SELECT symbol FROM (
  SELECT p_brand AS symbol FROM part UNION SELECT * FROM (VALUES {absent}) t(s)) u
WHERE symbol NOT IN (SELECT symbol FROM daily)""",
        "normalize_dates": with_(DAILY) + "SELECT date, symbol, round(open, 4) AS open, "
        "round(adj_close, 4) AS adj_close, volume FROM daily",
        "constraint_violations": with_(DAILY, batch) + """SELECT
  CAST(count(*) FILTER (WHERE date IS NULL) AS BIGINT) AS null_date,
  CAST(count(*) FILTER (WHERE symbol IS NULL) AS BIGINT) AS null_symbol,
  CAST(count(*) FILTER (WHERE length(symbol) > 9) AS BIGINT) AS long_symbol,
  CAST(count(*) - count(DISTINCT (date, symbol)) AS BIGINT) AS dup_key,
  CAST(count(*) AS BIGINT) AS rows
FROM batch""",
        "insert_ignore": with_(DAILY, batch) + f"""SELECT date, symbol, round(adj_close, 4) AS adj_close, volume, arrival
FROM batch b
WHERE arrival = (SELECT min(arrival) FROM batch c WHERE c.date = b.date AND c.symbol = b.symbol)
  AND NOT EXISTS (SELECT 1 FROM daily d WHERE d.date < DATE '{cat.STORED_BEFORE}'
                  AND d.date = b.date AND d.symbol = b.symbol)""",
        "benchmark_return": with_(DAILY, bench) + "SELECT date, round(benchmark_return, 6) AS benchmark_return FROM bm",
        "benchmark_join": with_(DAILY, bench) + f"""SELECT d.date, d.symbol, round(d.adj_close, 4) AS adj_close,
  round(bm.benchmark_return, 6) AS benchmark_return
FROM daily d LEFT JOIN bm ON bm.date = d.date WHERE d.symbol <> '{cat.BENCHMARK}'""",
        "weekly_bars": with_(*BASE) + "SELECT symbol, date, "
        + ", ".join(rnd(c, 4) for c in _PRICE) + ", volume FROM weekly",
        "weekly_gaps": with_(*BASE) + "SELECT symbol, date, volume FROM weekly WHERE adj_close IS NULL",
        "feat_whole_history": _window_group(["weekly_price_diff", "range", "volatility",
                                             "price_to_range_ratio"]),
        "feat_gap": _window_group(["gap"]),
        "feat_volume": _window_group(["volume_ma", "volume_ratio", "volume_change"]),
        "feat_rsi": _window_group(["rsi_2w", "normalized_rsi_2w"]),
        "feat_momentum": _window_group(["momentum_4w", "momentum_8w", "momentum_2w"]),
        "feat_ema_macd": with_(*BASE, EMA) + "SELECT symbol, date, " + ", ".join(
            rnd(c) for c in ["ema12", "ema26", "macd", "signal_line", "macd_distance",
                             "macd_short", "macd_long", "macd_diff"]) + " FROM ema",
        "feat_stochastic": _window_group(["low14", "high14", "stoch_k", "stoch_d",
                                          "stochastic_k_d_distance"]),
        "feat_obv": _window_group(["obv"], 2),
        "feat_vwap": with_(*BASE, VWAP) + "SELECT symbol, date, round(vwap, 6) AS vwap, "
        "round(vwap_distance, 6) AS vwap_distance FROM vwap",
        "feat_true_range": _window_group(["hl", "hc", "lc", "tr", "atr", "atr_percentage"]),
        "feat_pivot": _window_group(["pivot", "pivot_distance", "support_distance",
                                     "resistance_distance"]),
        "feat_returns": _window_group(["weekly_return", "next_weekly_return", "adj_close_change"]),
        "feat_lags": _window_group(
            [f"adj_close_lag_{k}w" for k in range(1, 5)] + [f"volume_lag_{k}w" for k in range(1, 5)]
            + [f"weekly_return_lag_{k}w" for k in range(1, 9)]),
        "feat_bollinger": _window_group(["rolling_mean_4w", "rolling_std_4w", "bollinger_upper",
                                         "bollinger_lower", "bollinger_bandwidth"]),
        "feat_moments": _window_group(["rolling_skew_4w", "rolling_kurt_4w"], 4),
        "feat_sharpe": _window_group(["sharpe_ratio"]),
        "feat_calendar": with_(*BASE, FEATURES)
        + "SELECT symbol, date, day_of_week, week_of_year, month FROM wf",
        "feature_frame": with_(*BASE, FEATURES, EMA, VWAP, FULL)
        + "SELECT symbol, date, " + ", ".join(rnd(c) for c in cat.COMPLETE_COLS) + " FROM complete",
        "period_split": with_(*BASE, FEATURES, EMA, VWAP, FULL)
        + f"SELECT symbol, date, {_period()} AS period FROM complete",
        "split_counts": with_(*BASE, FEATURES, EMA, VWAP, FULL)
        + f"""SELECT period, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT symbol) AS BIGINT) AS symbols
FROM (SELECT symbol, {_period()} AS period FROM complete) WHERE period IS NOT NULL GROUP BY period""",
        "base_score_facts": _model_facts("lightgbm", "xgboost", "catboost"),
        "stacked_score_facts": _model_facts("predicted_return"),
        "boost_tree": _boost_tree(),
        "topk_signals": with_(*BASE, SIGNALS) + """SELECT date, symbol, CAST(rank AS INTEGER) AS rank,
  round(predicted_return, 6) AS predicted_return
FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY predicted_return DESC NULLS LAST, symbol) AS rank
      FROM sig) WHERE rank <= 5""",
        "next_bar_asof": with_(*BASE, SIGNALS) + """SELECT s.symbol, s.date, b.date AS next_date,
  round(b.open, 4) AS next_open
FROM sig s JOIN daily d ON d.symbol = s.symbol AND d.date = s.date
ASOF JOIN daily b ON b.symbol = s.symbol AND b.date > s.date""",
        "tradable_signals": with_(*BASE, SIGNALS, NEXTBAR) + """SELECT t.date, t.symbol, round(nb.close, 4) AS close,
  nb.next_date, round(nb.next_open, 4) AS next_open
FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY predicted_return DESC NULLS LAST, symbol) AS rank
      FROM sig) t
JOIN nb ON nb.symbol = t.symbol AND nb.date = t.date
WHERE t.rank <= 5 AND nb.next_date IS NOT NULL""",
        "trade_pairs": _bt() + """SELECT scenario_id, symbol, signal_date, trade_date, action,
  round(price, 4) AS price, round(ret, 6) AS ret FROM acts""",
        "trade_sharpe": _bt() + "SELECT scenario_id, trades, round(sharpe_ratio, 4) AS sharpe_ratio FROM summary",
        "action_log": _bt() + """SELECT scenario_id, CAST(seq AS BIGINT) AS seq, signal_date, trade_date, symbol, action,
  round(price, 4) AS price, round(shares, 1) AS shares, round(cash, 2) AS total_cash,
  round(portfolio_value, 2) AS portfolio_value, round(profit_percentage, 4) AS profit_percentage FROM led""",
        "portfolio_summary": _bt(_default_rows()) + _SUMMARY_SELECT,
        "scenario_sweep": _bt() + _SUMMARY_SELECT,
        "best_scenario": _bt() + """SELECT metric_name, min(scenario_id) AS scenario_id, round(max(metric), 4) AS metric
FROM (SELECT 'roi' AS metric_name, scenario_id, roi AS metric FROM summary
      WHERE roi = (SELECT max(roi) FROM summary)
      UNION ALL
      SELECT 'sharpe_ratio', scenario_id, sharpe_ratio FROM summary
      WHERE sharpe_ratio = (SELECT max(sharpe_ratio) FROM summary))
GROUP BY metric_name""",
        "top_actions": _bt() + """SELECT list, scenario_id, CAST(pos AS INTEGER) AS pos, signal_date, symbol, action,
  round(profit_percentage, 4) AS profit_percentage
FROM (SELECT 'first' AS list, *, row_number() OVER (PARTITION BY scenario_id ORDER BY seq) AS pos FROM led
      UNION ALL
      SELECT 'most_profitable', *, row_number() OVER (PARTITION BY scenario_id ORDER BY profit_percentage DESC, seq)
      FROM led)
WHERE pos <= 5""",
        "regression_metrics": with_(*BASE, FEATURES, EMA, VWAP, FULL) + f"""SELECT period, CAST(count(*) AS BIGINT) AS n,
  round(sqrt(avg((next_weekly_return - weekly_return) * (next_weekly_return - weekly_return))), 6) AS rmse,
  round(avg(abs(next_weekly_return - weekly_return)), 6) AS mae
FROM (SELECT *, {_period()} AS period FROM complete) WHERE period IS NOT NULL GROUP BY period""",
    }
    out["stored_universe"] = out["universe_filter"]
    return {k: scaled_rounding(v) for k, v in out.items()}
