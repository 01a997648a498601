"""DuckDB SQL equivalents of the registered queries.

Common table expressions rebuild the derived tables from the driver's views
so each statement is self-contained.
"""

from __future__ import annotations

ORDER_TICKS = """order_ticks AS (
  SELECT o_orderpriority AS ticker, o_orderdate AS ts, CAST(o_totalprice AS DOUBLE) AS price,
         1.0::DOUBLE AS qty, o_orderkey AS tick_id
  FROM orders
  WHERE o_orderpriority IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice))"""

LINE_TICKS = """line_ticks AS (
  SELECT p_brand AS ticker, l_shipdate AS ts, l_extendedprice / l_quantity AS price,
         l_quantity AS qty, row(l_orderkey, l_linenumber, l_partkey, l_suppkey) AS tick_id
  FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE p_brand IS NOT NULL AND l_quantity <> 0)"""

EVENT_TICKS = """event_ticks AS (
  SELECT CAST(event_type AS VARCHAR) AS ticker, ts, CAST(value AS DOUBLE) AS price,
         1.0::DOUBLE AS qty, event_id AS tick_id
  FROM events
  WHERE event_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value))"""


def bars_cte(name: str, ticks: str, period: str = "day") -> str:
    if period == "day":
        pcol, pname = "CAST(ts AS DATE)", "bar_date"
    else:
        pcol, pname = f"date_trunc('{period}', ts)", "bar_ts"
    return f"""{name} AS (
  SELECT ticker, {pcol} AS {pname},
         arg_min(price, row(ts, tick_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, row(ts, tick_id)) AS close, CAST(sum(qty) AS BIGINT) AS volume,
         count(*) AS n_ticks
  FROM {ticks} GROUP BY 1, 2)"""


ORDER_BARS = bars_cte("order_bars", "order_ticks")
BRAND_BARS = bars_cte("brand_bars", "line_ticks")
EVENT_BARS_H = bars_cte("event_bars", "event_ticks", "hour")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r6(expr: str, alias: str, d: int = 6) -> str:
    return f"round({expr}, {d}) AS {alias}"


ORACLE: dict[str, str] = {}

ORACLE["bars_daily"] = with_(ORDER_TICKS, ORDER_BARS) + """
SELECT ticker, bar_date, open, high, low, close, volume, n_ticks FROM order_bars"""

ORACLE["avg_close_sql"] = with_(
    ORDER_TICKS, ORDER_BARS,
    'stocks AS (SELECT bar_date AS "Date", close AS "Close", ticker AS "Ticker" FROM order_bars)') + """
SELECT Ticker, round(AVG(Close), 6) AS avg_close FROM stocks GROUP BY Ticker"""

# ---------------------------------------------------------------- scans, filters, unions
RANGE_SQL = "bar_date >= DATE '1996-01-01' AND bar_date < DATE '2000-01-01'"
PICK_VALUES = "(VALUES (0, '2-HIGH'), (1, '4-NOT SPECIFIED'), (2, 'ZZZ-NONE'), (3, '1-URGENT'))"
UNION_STOCKS = """stocks_all AS (
  SELECT bar_date AS "Date", close AS "Close", ticker AS "Ticker" FROM order_bars
  UNION ALL SELECT bar_date, close, ticker FROM brand_bars)"""
ROUND_BARS = "open, high, low, close"   # selections of input values: exact, no rounding

ORACLE["bars_brand_daily"] = with_(LINE_TICKS, BRAND_BARS) + f"""
SELECT ticker, bar_date, {ROUND_BARS}, volume, n_ticks FROM brand_bars"""

ORACLE["bars_hourly"] = with_(EVENT_TICKS, EVENT_BARS_H) + f"""
SELECT ticker, bar_ts, {ROUND_BARS}, volume, n_ticks FROM event_bars"""

ORACLE["close_history"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT ticker, bar_date, close FROM order_bars
WHERE ticker = '1-URGENT' AND {RANGE_SQL}"""

ORACLE["ohlcv_history"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT ticker, bar_date, {ROUND_BARS}, volume FROM order_bars
WHERE ticker IN ('2-HIGH', '4-NOT SPECIFIED', 'ZZZ-NONE', '1-URGENT') AND {RANGE_SQL}"""

ORACLE["date_range_filter"] = with_(LINE_TICKS, BRAND_BARS) + f"""
SELECT ticker, bar_date, {ROUND_BARS}, volume, n_ticks FROM brand_bars WHERE {RANGE_SQL}"""

ORACLE["ticker_filter"] = with_(LINE_TICKS, BRAND_BARS) + f"""
SELECT ticker, bar_date, {ROUND_BARS}, volume, n_ticks FROM brand_bars
WHERE ticker IN ('Brand#12', 'Brand#45', 'Brand#99')"""

ORACLE["wide_to_tidy"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT ticker, bar_date, {ROUND_BARS}, volume FROM order_bars"""

ORACLE["multi_ticker_union"] = with_(ORDER_TICKS, ORDER_BARS, LINE_TICKS, BRAND_BARS, UNION_STOCKS) + """
SELECT "Date", "Close", "Ticker" FROM stocks_all"""

ORACLE["mean_close"] = with_(ORDER_TICKS, ORDER_BARS, LINE_TICKS, BRAND_BARS, UNION_STOCKS) + """
SELECT "Ticker", round(avg("Close"), 6) AS mean_close FROM stocks_all
WHERE "Ticker" IS NOT NULL GROUP BY "Ticker\""""

ORACLE["avg_close_union_sql"] = with_(ORDER_TICKS, ORDER_BARS, LINE_TICKS, BRAND_BARS, UNION_STOCKS) + """
SELECT "Ticker", round(AVG("Close"), 6) AS avg_close FROM stocks_all GROUP BY "Ticker\""""

ORACLE["head_rows"] = with_(ORDER_TICKS, ORDER_BARS, LINE_TICKS, BRAND_BARS, UNION_STOCKS) + f"""
SELECT "Date", "Close", s."Ticker" FROM stocks_all s
JOIN {PICK_VALUES} req(pos, "Ticker") ON s."Ticker" = req."Ticker"
ORDER BY pos, "Date" LIMIT 5"""

_HAVE = "(SELECT DISTINCT ticker FROM order_bars)"
ORACLE["availability_report"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT req.pos, req.ticker, CAST(coalesce(c.n_bars, 0) AS BIGINT) AS n_bars,
       CASE WHEN coalesce(c.n_bars, 0) > 0 THEN 'ok' ELSE 'no_data' END AS status
FROM {PICK_VALUES} req(pos, ticker)
LEFT JOIN (SELECT ticker, count(*) AS n_bars FROM order_bars GROUP BY ticker) c
  ON c.ticker = req.ticker"""

ORACLE["tickers_with_data"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT pos, ticker FROM {PICK_VALUES} req(pos, ticker) WHERE ticker IN {_HAVE}"""

ORACLE["tickers_without_data"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT pos, ticker FROM {PICK_VALUES} req(pos, ticker) WHERE ticker NOT IN {_HAVE}"""

ORACLE["candle_summary"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT ticker, count(*) AS "rows", min(low) AS low_min, max(high) AS high_max
FROM order_bars GROUP BY ticker"""

# ---------------------------------------------------------------- features
L = 60
POS_BARS = """pos_bars AS (
  SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY bar_date) AS pos,
         count(*) OVER (PARTITION BY ticker) AS n
  FROM order_bars)"""
SCALED = """scaled AS (
  SELECT b.ticker, b.bar_date, b.close, st.lo, st.hi, b.pos, b.n,
         (b.close - st.lo) / coalesce(nullif(st.hi - st.lo, 0.0), 1.0) AS s
  FROM pos_bars b JOIN (SELECT ticker, min(close) AS lo, max(close) AS hi
                        FROM order_bars GROUP BY ticker) st ON st.ticker = b.ticker)"""
BASE = (ORDER_TICKS, ORDER_BARS, POS_BARS, SCALED)
RNG = "coalesce(nullif(hi - lo, 0.0), 1.0)"


def cut(n: str, frac: float) -> str:
    return f"CAST(floor(CAST({n} AS DOUBLE) * {float(frac)!r}) AS BIGINT)"


ORACLE["scaler_state"] = with_(ORDER_TICKS, ORDER_BARS) + """
SELECT ticker, min(close) AS lo, max(close) AS hi FROM order_bars GROUP BY ticker"""

ORACLE["minmax_scale"] = with_(*BASE) + """
SELECT ticker, bar_date, round(close, 6) AS close, round(lo, 6) AS lo, round(hi, 6) AS hi,
       round(s, 6) AS s FROM scaled"""

ORACLE["minmax_scale_train_fit"] = with_(ORDER_TICKS, ORDER_BARS, POS_BARS) + f"""
, st AS (SELECT ticker, min(close) AS lo, max(close) AS hi FROM pos_bars
         WHERE pos <= {L} + {cut(f'greatest(n - {L}, 0)', 0.8)} GROUP BY ticker)
SELECT b.ticker, bar_date, round(close, 6) AS close, round(lo, 6) AS lo, round(hi, 6) AS hi,
       round((close - lo) / {RNG}, 6) AS s
FROM pos_bars b JOIN st ON st.ticker = b.ticker"""

ORACLE["scale_roundtrip"] = with_(*BASE) + f"""
SELECT ticker, bar_date, round(close, 6) AS close, round(s * {RNG} + lo, 6) AS restored FROM scaled"""

ORACLE["trainable_tickers"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT ticker, count(*) AS n FROM order_bars GROUP BY ticker HAVING count(*) > {L}"""

SAMPLES = f"""samples AS (
  SELECT ticker, bar_date, pos - {L} AS k, s AS y,
         list(s) OVER (PARTITION BY ticker ORDER BY bar_date
                       ROWS BETWEEN {L} PRECEDING AND 1 PRECEDING) AS x, pos
  FROM scaled)"""

ORACLE["sequence_samples"] = with_(*BASE, SAMPLES) + """
SELECT ticker, bar_date, k, CAST(len(x) AS INTEGER) AS x_len, round(x[1], 6) AS x_first,
       round(x[len(x)], 6) AS x_last, round(list_sum(x), 6) AS x_sum, round(y, 6) AS y
FROM samples WHERE k > 0"""

_NS = "count(*) OVER (PARTITION BY ticker)"
ORACLE["train_test_split"] = with_(*BASE, SAMPLES) + f"""
SELECT ticker, bar_date, k,
       CASE WHEN k <= {cut('ns', 0.8)} THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, {_NS} AS ns FROM samples WHERE k > 0)"""

ORACLE["three_way_split"] = with_(*BASE, SAMPLES) + f"""
SELECT ticker, bar_date, k,
       CASE WHEN k <= {cut('ns', 0.7)} THEN 'train'
            WHEN k <= {cut('ns', 0.7 + 0.15)} THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, {_NS} AS ns FROM samples WHERE k > 0)"""

ORACLE["last_n_bars"] = with_(ORDER_TICKS, ORDER_BARS, POS_BARS) + """
SELECT ticker, bar_date, close, pos FROM pos_bars WHERE pos > n - 20"""

ORACLE["seed_window"] = with_(*BASE) + f"""
SELECT ticker, 'latest' AS mode, CAST(count(*) AS INTEGER) AS seed_len,
       round(arg_min(s, pos), 6) AS seed_first, round(arg_max(s, pos), 6) AS seed_last,
       max(bar_date) AS seed_end
FROM scaled WHERE n > {L} AND pos > n - {L} GROUP BY ticker
UNION ALL
SELECT ticker, 'reference', CAST(count(*) AS INTEGER), round(arg_min(s, pos), 6),
       round(arg_max(s, pos), 6), max(bar_date)
FROM scaled WHERE n > {L} AND pos > n - 1 - {L} AND pos <= n - 1 GROUP BY ticker"""

ORACLE["rsi"] = with_(ORDER_TICKS, ORDER_BARS, POS_BARS) + """
, d AS (SELECT ticker, bar_date, close, pos,
               close - lag(close) OVER (PARTITION BY ticker ORDER BY bar_date) AS dl FROM pos_bars)
, g AS (SELECT *, avg(greatest(dl, 0.0)) OVER w AS ag, avg(greatest(-dl, 0.0)) OVER w AS al FROM d
        WINDOW w AS (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT ticker, bar_date, round(close, 6) AS close,
       round(CASE WHEN al = 0 THEN 100.0 ELSE 100.0 - 100.0 / (1.0 + ag / al) END, 6) AS rsi
FROM g WHERE pos > 14"""

def macd_sql(fast: int = 12, slow: int = 26, signal: int = 9) -> str:
    f, sl, g = (2.0 / (span + 1) for span in (fast, slow, signal))
    ef, es = f"({f!r} * p.close + {1 - f!r} * m.ef)", f"({sl!r} * p.close + {1 - sl!r} * m.es)"
    return "WITH RECURSIVE " + ",\n".join((ORDER_TICKS, ORDER_BARS, POS_BARS)) + f"""
, m(ticker, pos, ef, es, sig) AS (
  SELECT ticker, pos, close, close, 0.0::DOUBLE FROM pos_bars WHERE pos = 1
  UNION ALL
  SELECT p.ticker, p.pos, {ef}, {es}, {g!r} * ({ef} - {es}) + {1 - g!r} * m.sig
  FROM m JOIN pos_bars p ON p.ticker = m.ticker AND p.pos = m.pos + 1)
SELECT b.ticker, b.bar_date, round(b.close, 5) AS close, round(ef - es, 5) AS macd,
       round(sig, 5) AS signal, round(ef - es - sig, 5) AS hist
FROM m JOIN pos_bars b ON b.ticker = m.ticker AND b.pos = m.pos"""


ORACLE["macd"] = macd_sql()
ORACLE["macd_long"] = macd_sql(50, 200, 9)

# ---------------------------------------------------------------- forecast (AR(1))
PAIRS = f"""pairs AS (
  SELECT ticker, bar_date, k, x_last, y, lo, hi,
         CASE WHEN k <= {cut(f'greatest(n - {L}, 0)', 0.8)} THEN 'train' ELSE 'test' END AS split
  FROM (SELECT ticker, bar_date, pos - {L} AS k, n, lo, hi, s AS y,
               lag(s) OVER (PARTITION BY ticker ORDER BY bar_date) AS x_last FROM scaled)
  WHERE k > 0)"""
COEFS = """coefs AS (
  SELECT ticker, coalesce(regr_intercept(y, x_last), 0.0) AS a,
         coalesce(regr_slope(y, x_last), 1.0) AS b, count(*) AS n_train
  FROM pairs WHERE split = 'train' GROUP BY ticker)"""
PVA = f"""pva AS (
  SELECT p.ticker, bar_date, k, y * {RNG} + lo AS actual, (a + b * x_last) * {RNG} + lo AS predicted
  FROM pairs p JOIN coefs c ON c.ticker = p.ticker WHERE split = 'test')"""

ORACLE["ar1_fit"] = with_(*BASE, PAIRS, COEFS) + """
SELECT ticker, round(a, 6) AS a, round(b, 6) AS b, n_train FROM coefs"""

ORACLE["pred_vs_actual"] = with_(*BASE, PAIRS, COEFS, PVA) + """
SELECT ticker, bar_date, k, round(actual, 4) AS actual, round(predicted, 4) AS predicted FROM pva"""

ORACLE["rmse_ar1"] = with_(*BASE, PAIRS, COEFS, PVA) + """
SELECT ticker, round(sqrt(avg((actual - predicted) * (actual - predicted))), 4) AS rmse,
       count(*) AS n FROM pva GROUP BY ticker"""

ORACLE["rmse_persistence"] = with_(ORDER_TICKS, ORDER_BARS, POS_BARS) + """
SELECT ticker, round(sqrt(avg((close - prev) * (close - prev))), 4) AS rmse, count(*) AS n
FROM (SELECT ticker, pos, close, lag(close) OVER (PARTITION BY ticker ORDER BY bar_date) AS prev
      FROM pos_bars) WHERE pos > 1 GROUP BY ticker"""


def roll_sql(shift: int, days: int = 30) -> str:
    return "WITH RECURSIVE " + ",\n".join((*BASE, PAIRS, COEFS)) + f"""
, seed AS (SELECT s.ticker, s.s AS v, s.lo, s.hi,
                  (SELECT max(bar_date) FROM scaled z WHERE z.ticker = s.ticker) AS last_date
           FROM scaled s WHERE n > {L} AND pos = n - {shift})
, roll(ticker, step, v) AS (
  SELECT ticker, 0, v FROM seed
  UNION ALL
  SELECT r.ticker, r.step + 1, c.a + c.b * r.v FROM roll r JOIN coefs c ON c.ticker = r.ticker
  WHERE r.step < {days})
, fc AS (SELECT r.ticker, CAST(r.step AS INTEGER) AS step, s.last_date + CAST(r.step AS INTEGER) AS target_date,
                r.v * coalesce(nullif(s.hi - s.lo, 0.0), 1.0) + s.lo AS yhat
         FROM roll r JOIN seed s ON s.ticker = r.ticker WHERE r.step >= 1)
"""


ORACLE["forecast_ar1"] = roll_sql(0) + "SELECT ticker, step, target_date, round(yhat, 4) AS yhat FROM fc"
ORACLE["forecast_ar1_reference_seed"] = roll_sql(1) + \
    "SELECT ticker, step, target_date, round(yhat, 4) AS yhat FROM fc"
ORACLE["future_dates"] = roll_sql(0) + "SELECT ticker, step, target_date FROM fc"
ORACLE["forecast_candles"] = roll_sql(0) + """
, lc AS (SELECT ticker, arg_max(close, bar_date) AS last_close FROM order_bars GROUP BY ticker)
, c AS (SELECT fc.ticker, step, yhat AS close,
               coalesce(lag(yhat) OVER (PARTITION BY fc.ticker ORDER BY step), last_close) AS open
        FROM fc JOIN lc ON lc.ticker = fc.ticker
        WHERE step <= 10 AND fc.ticker IN (SELECT ticker FROM fc GROUP BY ticker HAVING max(step) >= 10))
SELECT ticker, step, DATE '2024-01-01' + step AS target_date, round(open, 4) AS open,
       round(greatest(open, close) * 1.01, 4) AS high, round(least(open, close) * 0.99, 4) AS low,
       round(close, 4) AS close
FROM c"""

ORACLE["training_status"] = with_(LINE_TICKS, BRAND_BARS) + f"""
, c AS (SELECT ticker, count(*) AS n FROM brand_bars GROUP BY ticker)
, t AS (SELECT *, greatest(n - {L}, 0) AS n_samples FROM c)
SELECT ticker, n, n_samples, {cut('n_samples', 0.8)} AS n_train,
       CASE WHEN {cut('n_samples', 0.8)} >= 100 THEN 'ok' ELSE 'insufficient_history' END AS status FROM t"""

# the normal equations of all train windows, solved by elimination: f holds the L values, 1 and the target
LINEAR = f"""train AS (
  SELECT list_concat(x, [1.0::DOUBLE, y]) AS f FROM (SELECT *, {_NS} AS ns FROM samples WHERE k > 0) WHERE k <= {cut('ns', 0.8)}),
gram AS (
  SELECT i, list(g ORDER BY j) AS g FROM (
    SELECT i, j, sum(f[i] * f[j]) AS g FROM train, range(1, {L + 2}) r(i), range(1, {L + 3}) c(j) GROUP BY i, j) GROUP BY i),
gauss(k, m) AS (
  SELECT 0::BIGINT, list(g ORDER BY i) FROM gram
  UNION ALL
  SELECT k + 1, list_transform(m, lambda r, nr: CASE WHEN nr = k + 1 THEN p ELSE list_transform(r, lambda v, c: v - r[k + 1] * p[c]) END)
  FROM (SELECT k, m, list_transform(m[k + 1], lambda v: v / m[k + 1][k + 1]) AS p FROM gauss WHERE k < {L + 1})),
weights AS (SELECT list_transform(m, lambda r: r[{L + 2}]) AS w FROM gauss WHERE k = {L + 1})"""
_LINEAR = "WITH RECURSIVE " + ",\n".join((*BASE, SAMPLES, LINEAR))
_DOT = f"(list_dot_product(x, w[1:{L}]) + w[{L + 1}])"
ORACLE["lr_fit"] = _LINEAR + f"""
SELECT CASE WHEN i > {L} THEN 0 ELSE {L + 1} - i END::INTEGER AS lag, round(w[i], 6) AS weight FROM weights, range(1, {L + 2}) r(i)"""
ORACLE["forecast_lr"] = _LINEAR + f""",
seeds AS (SELECT ticker, list(s ORDER BY pos) AS x, any_value(lo) AS lo, any_value(hi) AS hi, max(bar_date) AS last_date
          FROM scaled WHERE n > {L} AND pos > n - {L} GROUP BY ticker),
roll(ticker, step, x, lo, hi, last_date) AS (
  SELECT ticker, 0, x, lo, hi, last_date FROM seeds
  UNION ALL
  SELECT ticker, step + 1, list_append(x[2:], {_DOT}), lo, hi, last_date FROM roll, weights WHERE step < 30)
SELECT ticker, step::INTEGER AS step, last_date + step::INTEGER AS target_date, round(x[{L}] * {RNG} + lo, 2) AS yhat FROM roll WHERE step > 0"""
ORACLE["rmse_lr"] = _LINEAR + f""",
test AS (
  SELECT s.ticker, s.y * {RNG} + lo AS actual, {_DOT} * {RNG} + lo AS predicted
  FROM (SELECT *, {_NS} AS ns FROM samples WHERE k > 0) s JOIN scaled p ON p.ticker = s.ticker AND p.pos = s.pos, weights
  WHERE k > {cut('ns', 0.8)})
SELECT ticker, round(sqrt(avg((actual - predicted) * (actual - predicted))), 2) AS rmse, count(*) AS n FROM test GROUP BY ticker"""
ORACLE["loss_curve"] = "SELECT true AS falls, true AS ends_at_least_squares"
ORACLE["gbt_early_stop"] = "SELECT true AS stopped_in_time, true AS kept_best, true AS loss_is_that_round"
ORACLE["gbt_rollout_check"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT ticker, step::INTEGER AS step, true AS agrees
FROM (SELECT ticker FROM order_bars GROUP BY ticker HAVING count(*) > {L}), range(1, 31) r(step)"""

# least squares: no lag is left in the residuals; a saved model predicts the same; trees beat the last close
ORACLE["lr_normal_equations"] = f"SELECT lag::INTEGER AS lag, 0.0::DOUBLE AS product FROM range({L + 1}) r(lag)"
ORACLE["model_roundtrip"] = with_(*BASE, SAMPLES) + f"""
SELECT count(*) AS n, 0::BIGINT AS differ
FROM (SELECT k, {_NS} AS ns FROM samples WHERE k > 0) WHERE k > {cut('ns', 0.8)}"""
ORACLE["gbt_beats_persistence"] = with_(ORDER_TICKS, ORDER_BARS) + f"""
SELECT ticker, true AS better FROM order_bars GROUP BY ticker HAVING count(*) > {L}"""

# ---------------------------------------------------------------- quotes, log, snapshot
def iso(ts: str) -> str:
    return (f"CASE WHEN strftime({ts}, '%f') = '000000' THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END")


QUOTE_LOG = f"""plog AS (
  SELECT CAST(event_type AS VARCHAR) AS ticker, CAST(value AS DOUBLE) AS price, {iso("date_trunc('hour', ts)")} AS "timestamp",
         'events' AS source, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS fetched_at
  FROM events WHERE event_type IS NOT NULL AND value IS NOT NULL AND NOT isnan(value))"""

ORACLE["latest_quote"] = with_(EVENT_TICKS) + f"""
SELECT ticker, price, ts, {iso('ts')} AS "timestamp"
FROM (SELECT ticker, arg_max(price, row(ts, tick_id)) AS price, max(ts) AS ts
      FROM event_ticks GROUP BY ticker)"""

ORACLE["valid_quotes"] = f"""
SELECT event_type AS ticker, value AS price, {iso('ts')} AS "timestamp", 'events' AS source,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS fetched_at
FROM events WHERE value IS NOT NULL AND NOT isnan(value)"""

ORACLE["poll_log"] = with_(QUOTE_LOG) + "SELECT * FROM plog"
ORACLE["quote_log_scan"] = ORACLE["poll_log"]

ORACLE["dedup_quotes"] = with_(QUOTE_LOG) + """
SELECT ticker, price, "timestamp", source, fetched_at FROM (
  SELECT *, row_number() OVER (PARTITION BY ticker, "timestamp" ORDER BY fetched_at, price, source) AS nr FROM plog)
WHERE nr = 1"""

ORACLE["quote_snapshot"] = with_(QUOTE_LOG) + """
SELECT r.ticker, r.price, r."timestamp", r.source, r.fetched_at FROM (
  SELECT arg_max({'ticker': ticker, 'price': price, 'timestamp': "timestamp", 'source': source,
                  'fetched_at': fetched_at},
                 row(CAST("timestamp" AS TIMESTAMP), fetched_at)) AS r
  FROM plog GROUP BY ticker)"""

EVENT_BARS_D = bars_cte("event_bars_d", "event_ticks")
ORACLE["bars_with_latest_quote"] = with_(EVENT_TICKS, EVENT_BARS_D) + """
SELECT b.*, q.rt_price, q.rt_ts FROM event_bars_d b LEFT JOIN (
  SELECT ticker, arg_max(price, row(ts, tick_id)) AS rt_price, max(ts) AS rt_ts
  FROM event_ticks GROUP BY ticker) q ON q.ticker = b.ticker"""

# ---------------------------------------------------------------- chart feeds
ORDER_LATEST = """olatest AS (SELECT ticker, arg_max(price, row(ts, tick_id)) AS price, max(ts) AS ts
                               FROM order_ticks GROUP BY ticker)"""
_N = "CAST(NULL AS DOUBLE)"


def feed_select(trace: str, src: str, x: str, o=None, y=None, where: str = "") -> str:
    o = o or (_N, _N, _N, _N)
    return (f"SELECT ticker, '{trace}' AS trace, CAST({x} AS TIMESTAMP) AS x, "
            f"round({o[0]}, 4) AS open, round({o[1]}, 4) AS high, round({o[2]}, 4) AS low, "
            f"round({o[3]}, 4) AS close, round(CAST({y or _N} AS DOUBLE), 4) AS y FROM {src} {where}")


ORACLE["line_feed"] = roll_sql(0) + ", " + ORDER_LATEST + "\n" + "\nUNION ALL\n".join([
    feed_select("history", "order_bars", "bar_date", y="close"),
    feed_select("predicted", "fc", "target_date", y="yhat"),
    feed_select("realtime", "olatest", "ts", y="price"),
])

ORACLE["candle_feed"] = roll_sql(0) + ", " + ORDER_LATEST + """
, lc AS (SELECT ticker, arg_max(close, bar_date) AS last_close FROM order_bars GROUP BY ticker)
, c0 AS (SELECT fc.ticker, step, yhat AS close,
               coalesce(lag(yhat) OVER (PARTITION BY fc.ticker ORDER BY step), last_close) AS open
        FROM fc JOIN lc ON lc.ticker = fc.ticker WHERE step <= 10)
, cand AS (SELECT ticker, DATE '2024-01-01' + step AS target_date, open, close,
                  greatest(open, close) * 1.01 AS high, least(open, close) * 0.99 AS low FROM c0)
""" + "\nUNION ALL\n".join([
    feed_select("ohlc", "order_bars", "bar_date", o=("open", "high", "low", "close")),
    feed_select("volume", "order_bars", "bar_date", y="volume"),
    feed_select("forecast_ohlc", "cand", "target_date", o=("open", "high", "low", "close")),
    feed_select("predicted", "fc", "target_date", y="yhat"),
    feed_select("realtime", "olatest", "ts", y="price"),
])

ORACLE["grid_feed"] = with_(ORDER_TICKS, ORDER_BARS, ORDER_LATEST) + f"""
, sel AS (SELECT * FROM order_bars
          WHERE ticker IN ('2-HIGH', '4-NOT SPECIFIED', 'ZZZ-NONE', '1-URGENT'))
, valid AS (SELECT pos, ticker FROM {PICK_VALUES} req(pos, ticker)
            WHERE ticker IN (SELECT ticker FROM sel))
, lay AS (SELECT ticker, CAST(row_number() OVER (ORDER BY pos) - 1 AS INTEGER) AS panel,
                 count(*) OVER () AS nv FROM valid)
, layout AS (SELECT ticker, panel,
                    CAST(floor(panel / (CASE WHEN nv > 1 THEN 2 ELSE 1 END)) + 1 AS INTEGER) AS grid_row,
                    CAST(panel % (CASE WHEN nv > 1 THEN 2 ELSE 1 END) + 1 AS INTEGER) AS grid_col,
                    CAST(ceil(nv / (CASE WHEN nv > 1 THEN 2 ELSE 1 END)) AS INTEGER) AS grid_rows,
                    CAST(CASE WHEN nv > 1 THEN 2 ELSE 1 END AS INTEGER) AS grid_cols FROM lay)
, rt AS (SELECT * FROM olatest WHERE ticker IN (SELECT ticker FROM valid))
, feed AS (
""" + "\nUNION ALL\n".join([
    feed_select("ohlc", "sel", "bar_date", o=("open", "high", "low", "close")),
    feed_select("volume", "sel", "bar_date", y="volume"),
    feed_select("realtime", "rt", "ts", y="price"),
]) + ")\nSELECT feed.*, panel, grid_row, grid_col, grid_rows, grid_cols FROM feed JOIN layout USING (ticker)"

# ---------------------------------------------------------------- streaming
ORACLE["stream_quote_log"] = ORACLE["poll_log"]
ORACLE["stream_snapshot"] = ORACLE["quote_snapshot"]
ORACLE["stream_latest"] = ORACLE["quote_snapshot"]
ORACLE["stream_dedup"] = ORACLE["dedup_quotes"]
ORACLE["stream_resume"] = ORACLE["poll_log"]
ORACLE["stream_max_rows"] = with_(QUOTE_LOG) + """
SELECT * FROM plog ORDER BY fetched_at, ticker, "timestamp", source, price LIMIT 1000"""

ORACLE["stream_bars"] = ORACLE["bars_hourly"]

# ---------------------------------------------------------------- exports
ORACLE["feed_export"] = ORACLE["candle_feed"]
ORACLE["quote_json"] = with_(EVENT_TICKS) + f"""
, lq AS (SELECT ticker, arg_max(price, row(ts, tick_id)) AS price, max(ts) AS ts
         FROM event_ticks GROUP BY ticker)
SELECT ticker, '{{"ticker":"' || ticker || '","price":' || CAST(price AS VARCHAR) ||
       ',"timestamp":"' || {iso('ts')} || '","source":"events","fetched_at":"' ||
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}}' AS json
FROM lq"""
