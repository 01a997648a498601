"""Registered queries: one per operator of SURVEY §2.

Each takes ``(spark, sf_dir)`` and returns a DataFrame over the whole driver
tables.  Double results are rounded in the final projection only so that
they compare exactly with the DuckDB oracle (``candela.plans.oracle``);
the library functions themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.operators import aggregates as agg
from candela.plans import catalog as cat
from candela.sources import scans

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6, only=None) -> DataFrame:
    """Round every double column (or those in ``only``) in the last projection."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (only is None or f.name in only):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


# Query parameters (fixed so that Spark and the oracle agree).
RANGE = ("1996-01-01", "2000-01-01")          # P4 date window on the daily series
PICK = ["2-HIGH", "4-NOT SPECIFIED", "ZZZ-NONE", "1-URGENT"]   # requested list with a miss


def union_stocks(spark, sf_dir) -> DataFrame:
    """S4 + U1: the order tickers and the brand tickers as one stocks table."""
    return scans.union_frames([scans.stocks_view(cat.order_bars(spark, sf_dir)),
                               scans.stocks_view(cat.brand_bars(spark, sf_dir))])


# ---------------------------------------------------------------- slice 1
@query("bars_daily")
def q_bars_daily(spark, sf_dir):
    return cat.order_bars(spark, sf_dir)


@query("avg_close_sql")
def q_avg_close_sql(spark, sf_dir):
    stocks = scans.stocks_view(cat.order_bars(spark, sf_dir))
    return rounded(agg.avg_close_sql(spark, stocks))


# ---------------------------------------------------------------- scans, filters, unions
@query("bars_brand_daily")
def q_bars_brand_daily(spark, sf_dir):
    return cat.brand_bars(spark, sf_dir)


@query("bars_hourly")
def q_bars_hourly(spark, sf_dir):
    return cat.event_bars(spark, sf_dir, "hour")


@query("close_history")
def q_close_history(spark, sf_dir):
    return scans.close_history(cat.order_bars(spark, sf_dir), "1-URGENT", *RANGE)


@query("ohlcv_history")
def q_ohlcv_history(spark, sf_dir):
    return scans.ohlcv_history(cat.order_bars(spark, sf_dir), PICK, *RANGE,
                                       include_volume=True)


@query("date_range_filter")
def q_date_range_filter(spark, sf_dir):
    return scans.date_range_filter(cat.brand_bars(spark, sf_dir), *RANGE)


@query("ticker_filter")
def q_ticker_filter(spark, sf_dir):
    from candela.functions.expr import split_tickers
    return scans.ticker_filter(cat.brand_bars(spark, sf_dir),
                                       split_tickers(" Brand#12, ,Brand#45 ,Brand#99,"))


@query("wide_to_tidy")
def q_wide_to_tidy(spark, sf_dir):
    bars = cat.order_bars(spark, sf_dir, materialized=True)
    return scans.tidy_wide_bars(scans.widen_bars(bars, scans.all_tickers(bars)))


@query("multi_ticker_union")
def q_multi_ticker_union(spark, sf_dir):
    return union_stocks(spark, sf_dir)


@query("mean_close")
def q_mean_close(spark, sf_dir):
    return rounded(agg.mean_close(union_stocks(spark, sf_dir)))


@query("avg_close_union_sql")
def q_avg_close_union_sql(spark, sf_dir):
    return rounded(agg.avg_close_sql(spark, union_stocks(spark, sf_dir), view="stocks_all"))


@query("head_rows")
def q_head_rows(spark, sf_dir):
    return scans.head_rows(union_stocks(spark, sf_dir), PICK, 5)


@query("availability_report")
def q_availability(spark, sf_dir):
    return scans.availability(cat.order_bars(spark, sf_dir), PICK)


@query("tickers_with_data")
def q_tickers_with_data(spark, sf_dir):
    return scans.tickers_with_data(cat.order_bars(spark, sf_dir), PICK)


@query("tickers_without_data")
def q_tickers_without_data(spark, sf_dir):
    return scans.tickers_without_data(cat.order_bars(spark, sf_dir), PICK)


@query("candle_summary")
def q_candle_summary(spark, sf_dir):
    return agg.candle_summary(cat.order_bars(spark, sf_dir))


# ---------------------------------------------------------------- features
L = 60
FRAC = 0.8


def scaled_orders(spark, sf_dir, fit="all", bars=None):
    """Positioned and scaled daily bars with their series statistics, written once per query.

    The tick aggregation is done once for the bars, and the series that the
    forecast chain reads several times is a table, too.
    """
    from candela.operators.features import minmax_scale, scaled_series
    from candela.operators.position import with_position
    from candela.plans.materialize import materialize
    bars = bars if bars is not None else cat.order_bars(spark, sf_dir, materialized=True)
    if fit != "all":
        return minmax_scale(with_position(bars), fit=fit, L=L, frac=FRAC)
    return materialize(scaled_series(bars), "scaled")


@query("scaler_state")
def q_scaler_state(spark, sf_dir):
    return agg.scaler_state(cat.order_bars(spark, sf_dir))


@query("minmax_scale")
def q_minmax_scale(spark, sf_dir):
    return rounded(scaled_orders(spark, sf_dir).select("ticker", "bar_date", "close", "lo", "hi", "s"))


@query("minmax_scale_train_fit")
def q_minmax_scale_train(spark, sf_dir):
    return rounded(scaled_orders(spark, sf_dir, fit="train")
                   .select("ticker", "bar_date", "close", "lo", "hi", "s"))


@query("scale_roundtrip")
def q_scale_roundtrip(spark, sf_dir):
    from candela.operators.features import inverse_scale_expr
    d = scaled_orders(spark, sf_dir)
    return rounded(d.select("ticker", "bar_date", "close", inverse_scale_expr("s").alias("restored")))


@query("trainable_tickers")
def q_trainable(spark, sf_dir):
    from candela.operators.position import series_counts
    n = series_counts(cat.order_bars(spark, sf_dir))
    return n.where(F.col("n") > L).select("ticker", "n")


@query("training_status")
def q_training_status(spark, sf_dir):
    from candela.operators.features import training_status
    return training_status(cat.brand_bars(spark, sf_dir), L, FRAC, min_train=100)


def _sample_summary(samples):
    return samples.select("ticker", "bar_date", "k", F.size("x").alias("x_len"),
                          F.element_at("x", 1).alias("x_first"), F.element_at("x", -1).alias("x_last"),
                          F.aggregate("x", F.lit(0.0), lambda a, v: a + v).alias("x_sum"), "y")


@query("sequence_samples")
def q_sequence_samples(spark, sf_dir):
    from candela.operators.features import sequence_samples
    return rounded(_sample_summary(sequence_samples(scaled_orders(spark, sf_dir), L)))


@query("train_test_split")
def q_train_test_split(spark, sf_dir):
    from candela.operators.features import sequence_samples, chrono_split
    s = sequence_samples(scaled_orders(spark, sf_dir), L).select("ticker", "bar_date", "k", "n")
    return chrono_split(s, FRAC)


@query("three_way_split")
def q_three_way_split(spark, sf_dir):
    from candela.operators.features import sequence_samples, three_way_split
    s = sequence_samples(scaled_orders(spark, sf_dir), L).select("ticker", "bar_date", "k", "n")
    return three_way_split(s, 0.7, 0.15)


@query("last_n_bars")
def q_last_n_bars(spark, sf_dir):
    from candela.operators.features import last_n_bars
    return last_n_bars(cat.order_bars(spark, sf_dir, materialized=True), 20) \
        .select("ticker", "bar_date", "close", "pos")


@query("seed_window")
def q_seed_window(spark, sf_dir):
    from candela.operators.features import seed_window
    d = scaled_orders(spark, sf_dir)
    parts = []
    for mode in ("latest", "reference"):
        sw = seed_window(d, L, mode)
        parts.append(sw.select("ticker", F.lit(mode).alias("mode"), F.size("seed").alias("seed_len"),
                               F.element_at("seed", 1).alias("seed_first"),
                               F.element_at("seed", -1).alias("seed_last"), "seed_end"))
    return rounded(parts[0].unionByName(parts[1]))


@query("rsi")
def q_rsi(spark, sf_dir):
    from candela.operators.indicators import rsi
    return rounded(rsi(cat.order_bars(spark, sf_dir, materialized=True), 14))


@query("macd")
def q_macd(spark, sf_dir):
    from candela.operators.indicators import macd
    return rounded(macd(cat.order_bars(spark, sf_dir, materialized=True)), 5)


@query("macd_long")
def q_macd_long(spark, sf_dir):
    """Spans far longer than a chunk: the carry goes through several chunks."""
    from candela.operators.indicators import macd
    return rounded(macd(cat.order_bars(spark, sf_dir, materialized=True), 50, 200, 9), 5)


# ---------------------------------------------------------------- forecast (AR(1))
AS_OF = "2024-01-01"      # the reference dates forecast candles from "today"
N_CANDLES = 10
DAYS = 30


def ar1_parts(spark, sf_dir, bars=None):
    from candela.operators.forecast import ar1_fit, ar1_pairs
    d = scaled_orders(spark, sf_dir, bars=bars)
    pairs = ar1_pairs(d, L, FRAC)
    return d, pairs, ar1_fit(pairs)


@query("ar1_fit")
def q_ar1_fit(spark, sf_dir):
    _, _, coefs = ar1_parts(spark, sf_dir)
    return rounded(coefs)


@query("pred_vs_actual")
def q_pred_vs_actual(spark, sf_dir):
    from candela.operators.forecast import ar1_predict_test
    _, pairs, coefs = ar1_parts(spark, sf_dir)
    return rounded(ar1_predict_test(pairs, coefs), 4)


@query("rmse_ar1")
def q_rmse_ar1(spark, sf_dir):
    from candela.operators.forecast import ar1_predict_test
    _, pairs, coefs = ar1_parts(spark, sf_dir)
    return rounded(agg.rmse(ar1_predict_test(pairs, coefs)), 4)


@query("rmse_persistence")
def q_rmse_persistence(spark, sf_dir):
    from candela.operators.features import lagged
    from candela.operators.position import with_position
    d = lagged(with_position(cat.order_bars(spark, sf_dir, materialized=True)), "close", 1) \
        .where(F.col("pos") > 1)
    pred = d.select("ticker", F.col("close").alias("actual"), F.col("close_lag1").alias("predicted"))
    return rounded(agg.rmse(pred), 4)


@query("forecast_ar1")
def q_forecast_ar1(spark, sf_dir):
    from candela.operators.forecast import ar1_forecast
    d, _, coefs = ar1_parts(spark, sf_dir)
    return rounded(ar1_forecast(d, coefs, DAYS, "latest", L), 4)


@query("forecast_ar1_reference_seed")
def q_forecast_ar1_ref(spark, sf_dir):
    from candela.operators.forecast import ar1_forecast
    d, _, coefs = ar1_parts(spark, sf_dir)
    return rounded(ar1_forecast(d, coefs, DAYS, "reference", L), 4)


@query("future_dates")
def q_future_dates(spark, sf_dir):
    from candela.operators.forecast import ar1_forecast
    d, _, coefs = ar1_parts(spark, sf_dir)
    return ar1_forecast(d, coefs, DAYS, "latest", L).select("ticker", "step", "target_date")


def _last_rows(d):
    """Each ticker's last close, read off its last bar."""
    return d.where(F.col("pos") == F.col("n")).select("ticker", "last_close", "last_date")


@query("forecast_candles")
def q_forecast_candles(spark, sf_dir):
    from candela.operators.forecast import ar1_forecast, forecast_candles
    d, _, coefs = ar1_parts(spark, sf_dir)
    fc = ar1_forecast(d, coefs, DAYS, "latest", L)
    return rounded(forecast_candles(fc, _last_rows(d), N_CANDLES, AS_OF), 4)


# ---------------------------------------------------------------- quotes, log, snapshot
def quote_log(spark, sf_dir):
    """The log that the quote queries read: every valid event as a record."""
    from candela.sources.quotes import event_quote_log
    from candela.sources.tables import read_table
    return event_quote_log(read_table(spark, sf_dir, "events", ["event_type", "ts", "value"]))


@query("latest_quote")
def q_latest_quote(spark, sf_dir):
    from candela.sources.quotes import latest_quote
    from candela.sources.ticks import load_event_ticks
    return latest_quote(load_event_ticks(spark, sf_dir))


@query("valid_quotes")
def q_valid_quotes(spark, sf_dir):
    from candela.sources.quotes import quote_records, valid_quotes
    from candela.sources.tables import read_table
    ev = read_table(spark, sf_dir, "events", ["event_type", "ts", "value"])
    q = valid_quotes(ev.select(F.col("event_type").alias("ticker"), "ts",
                               F.col("value").alias("price")))
    return quote_records(q, "events")


@query("poll_log")
def q_poll_log(spark, sf_dir):
    return quote_log(spark, sf_dir)


@query("quote_log_scan")
def q_quote_log_scan(spark, sf_dir):
    from candela.session import scratch_path
    from candela.sinks.writers import append_quote_log
    from candela.sources.quotes import read_quote_log
    path = scratch_path(spark, "quote-log")
    append_quote_log(quote_log(spark, sf_dir), path)
    return read_quote_log(spark, path)


@query("dedup_quotes")
def q_dedup_quotes(spark, sf_dir):
    from candela.sources.quotes import dedup_quotes
    return dedup_quotes(quote_log(spark, sf_dir))


@query("quote_snapshot")
def q_quote_snapshot(spark, sf_dir):
    from candela.schemas import QUOTE
    from candela.session import scratch_path
    from candela.sinks.writers import read_snapshot, write_snapshot
    from candela.sources.quotes import snapshot_latest
    path = scratch_path(spark, "snapshot")
    write_snapshot(snapshot_latest(quote_log(spark, sf_dir)), path)
    return read_snapshot(spark, path, QUOTE)


@query("bars_with_latest_quote")
def q_bars_with_latest_quote(spark, sf_dir):
    from candela.operators.joins import bars_with_latest_quote
    from candela.sources.quotes import latest_from_bars
    bars = cat.event_bars(spark, sf_dir, "day", materialized=True)
    return bars_with_latest_quote(bars, latest_from_bars(bars)).drop("last_ts")


# ---------------------------------------------------------------- chart feeds
def _order_latest(bars):
    """Real-time point of each ticker, read off the materialised bars."""
    from candela.sources.quotes import latest_from_bars
    return latest_from_bars(bars)


@query("line_feed")
def q_line_feed(spark, sf_dir):
    from candela.operators.feeds import line_feed
    from candela.operators.forecast import ar1_forecast
    bars = cat.order_bars(spark, sf_dir, materialized=True)
    d, _, coefs = ar1_parts(spark, sf_dir, bars)
    fc = ar1_forecast(d, coefs, DAYS, "latest", L)
    return rounded(line_feed(bars, fc, _order_latest(bars)), 4)


@query("candle_feed")
def q_candle_feed(spark, sf_dir):
    from candela.operators.feeds import candle_feed
    from candela.operators.forecast import ar1_forecast, forecast_candles
    from candela.plans.materialize import materialize
    bars = cat.order_bars(spark, sf_dir, materialized=True)
    d, _, coefs = ar1_parts(spark, sf_dir, bars)
    fc = materialize(ar1_forecast(d, coefs, DAYS, "latest", L), "forecast")   # read by two traces
    candles = forecast_candles(fc, _last_rows(d), N_CANDLES, AS_OF)
    return rounded(candle_feed(bars, fc, _order_latest(bars), candles,
                               include_volume=True), 4)


@query("grid_feed")
def q_grid_feed(spark, sf_dir):
    from candela.operators.feeds import grid_feed
    bars = cat.order_bars(spark, sf_dir, materialized=True)
    return grid_feed(bars, PICK, _order_latest(bars), include_volume=True)


# ---------------------------------------------------------------- streaming (drained with availableNow)
def _quote_files(spark, sf_dir) -> str:
    """Write the log as JSON files in poll order: the input folder of the quote stream.

    As many files as the log has shuffle partitions, which follow its size.
    """
    from candela.session import scratch_path
    src = scratch_path(spark, "quote-src")
    quote_log(spark, sf_dir).repartitionByRange("fetched_at").write.json(src)
    return src


def _read_json_tree(spark, path):
    from candela.schemas import QUOTE
    return spark.read.schema(QUOTE).option("recursiveFileLookup", "true").json(path)


def _run_quote_stream(spark, sf_dir, **kw):
    from candela.session import scratch_path
    from candela.streaming.quotes import run_quote_stream
    src = _quote_files(spark, sf_dir)
    base = scratch_path(spark, "quote-stream")
    log, snap = f"{base}/log", f"{base}/snapshot"
    run_quote_stream(spark, src, log, snap, f"{base}/_checkpoint", **kw)
    return log, snap


@query("stream_quote_log")
def q_stream_quote_log(spark, sf_dir):
    log, _ = _run_quote_stream(spark, sf_dir, max_files_per_trigger=2)
    return _read_json_tree(spark, log)


@query("stream_snapshot")
def q_stream_snapshot(spark, sf_dir):
    from candela.streaming.quotes import latest_table
    _, snap = _run_quote_stream(spark, sf_dir, max_files_per_trigger=2)
    return latest_table(spark, snap).read()


MAX_ROWS = 1000   # rows after which the limited stream stops (the limit is the feature)


@query("stream_max_rows")
def q_stream_max_rows(spark, sf_dir):
    """The whole log as one batch, cut to exactly the first rows in log order."""
    log, _ = _run_quote_stream(spark, sf_dir, max_rows=MAX_ROWS)
    return _read_json_tree(spark, log)


@query("stream_resume")
def q_stream_resume(spark, sf_dir):
    """Stop at the limit, go on without it: the log is whole, nothing twice."""
    from candela.session import scratch_path
    from candela.streaming.quotes import run_quote_stream
    src, base = _quote_files(spark, sf_dir), scratch_path(spark, "quote-resume")
    for limit in (MAX_ROWS, 0):
        run_quote_stream(spark, src, f"{base}/log", f"{base}/snapshot", f"{base}/_checkpoint",
                         max_files_per_trigger=2, max_rows=limit)
    return _read_json_tree(spark, f"{base}/log")


@query("stream_latest")
def q_stream_latest(spark, sf_dir):
    from candela.session import scratch_path
    from candela.streaming.quotes import latest_table, run_live_latest
    src = _quote_files(spark, sf_dir)
    base = scratch_path(spark, "live-latest")
    run_live_latest(spark, src, f"{base}/out", f"{base}/_checkpoint", max_files_per_trigger=3)
    return latest_table(spark, f"{base}/out").read()


@query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    from candela.session import scratch_path
    from candela.streaming.quotes import first_polls_table, run_dedup
    src = _quote_files(spark, sf_dir)
    base = scratch_path(spark, "dedup")
    run_dedup(spark, src, f"{base}/out", f"{base}/_checkpoint", max_files_per_trigger=2)
    return first_polls_table(spark, f"{base}/out").read()


@query("stream_bars")
def q_stream_bars(spark, sf_dir):
    from candela.session import scratch_path
    from candela.sources.ticks import event_ticks
    from candela.streaming.bars import event_stream, read_bars, run_bars
    from candela.sources.tables import read_table
    base = scratch_path(spark, "stream-bars")
    # files in no order of time: every batch brings ticks of windows that earlier ones have filled
    read_table(spark, sf_dir, "events").repartition("event_id").write.parquet(f"{base}/in/events.parquet")
    run_bars(event_ticks(event_stream(spark, f"{base}/in", max_files_per_trigger=4)), f"{base}/out", f"{base}/_checkpoint")
    return read_bars(spark, f"{base}/out")


# ---------------------------------------------------------------- Spark ML models
def _ml_parts(spark, sf_dir):
    from candela.operators.features import chrono_split, sequence_samples
    d = scaled_orders(spark, sf_dir)
    samples = chrono_split(sequence_samples(d, L), FRAC)
    return d, samples


def _lr(spark, sf_dir):
    """The scaled series and the pooled linear model of its train samples, from lagged products."""
    from candela.operators.gram import fit_linear_gram
    d = scaled_orders(spark, sf_dir)
    return d, fit_linear_gram(d, L, FRAC)


def _split_samples(d):
    from candela.operators.features import chrono_split, sequence_samples
    return chrono_split(sequence_samples(d, L), FRAC)


def _model_forecast(d, seeds_path_df, days=DAYS):
    from candela.operators.features import inverse_scale_expr
    from candela.operators.forecast import explode_path, future_dates
    st = d.where(F.col("pos") == F.col("n")).select("ticker", "lo", "hi", "last_date")
    out = future_dates(explode_path(seeds_path_df).join(st, "ticker"))
    return out.select("ticker", "step", "target_date", inverse_scale_expr("yhat_s").alias("yhat"))


@query("lr_fit")
def q_lr_fit(spark, sf_dir):
    """M1: the weight of each lag (0: the constant)."""
    _, fit = _lr(spark, sf_dir)
    rows = [(0, fit.intercept), *((L - i, w) for i, w in enumerate(fit.coefficients))]
    return rounded(spark.createDataFrame(rows, "lag int, weight double"))


@query("forecast_lr")
def q_forecast_lr(spark, sf_dir):
    from candela.operators.features import seed_window
    from candela.operators.forecast import rollout_linear
    d, fit = _lr(spark, sf_dir)
    rolled = rollout_linear(seed_window(d, L, "latest"), fit.coefficients, fit.intercept, DAYS)
    return rounded(_model_forecast(d, rolled.select("ticker", "path")), 2)


@query("rmse_lr")
def q_rmse_lr(spark, sf_dir):
    from candela.operators.features import inverse_scale_expr
    from candela.operators.forecast import predict
    d, fit = _lr(spark, sf_dir)
    st = d.where(F.col("pos") == F.col("n")).select("ticker", "lo", "hi")
    pred = predict(fit, _split_samples(d).where(F.col("split") == "test")).join(st, "ticker")
    return rounded(agg.rmse(pred.select("ticker", inverse_scale_expr("y").alias("actual"),
                                        inverse_scale_expr("yhat_s").alias("predicted"))), 2)


@query("loss_curve")
def q_loss_curve(spark, sf_dir):
    """M3: every pass of the iterative solver lowers the loss, and the last is that of the least-squares fit."""
    from candela.operators.forecast import fit_linear, predict
    d, fit = _lr(spark, sf_dir)
    train = _split_samples(d).where(F.col("split") == "train")
    model = fit_linear(train, epochs=200, solver="l-bfgs", tol=1e-12)
    hist = [float(v) for v in model.summary.objectiveHistory]          # at most maxIter + 1 numbers
    falls = all(b <= a for a, b in zip(hist, hist[1:])) and hist[-1] < hist[0]
    loss = predict(model, train).agg(F.avg((F.col("y") - F.col("yhat_s")) ** 2).alias("loss"))
    return loss.select(F.lit(falls).alias("falls"), (F.abs(F.col("loss") / F.lit(fit.loss) - 1) < 1e-6).alias("ends_at_least_squares"))


@query("lr_normal_equations")
def q_lr_normal_equations(spark, sf_dir):
    """The fit in one row for each lag (0: the constant): least squares leaves residuals
    that are orthogonal to every lag, so each mean product is 0."""
    from candela.operators.forecast import predict
    d, fit = _lr(spark, sf_dir)
    r = predict(fit, _split_samples(d).where(F.col("split") == "train")).withColumn("e", F.col("y") - F.col("yhat_s"))
    sums = r.agg(F.avg("e").alias("m0"), *(F.avg(F.col("e") * F.element_at("x", i + 1)).alias(f"m{i + 1}") for i in range(L)))
    lags = F.array(*(F.struct(F.lit(i).alias("lag"), F.abs(F.round(F.col(f"m{i}"), 6)).alias("product")) for i in range(L + 1)))
    return sums.select(F.explode(lags).alias("l")).select("l.lag", "l.product")


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """K4: test predictions of the saved and the loaded model, and how many differ."""
    from candela.operators.forecast import fit_linear, predict
    from candela.session import scratch_path
    from candela.sinks.models import load_model, save_model
    _, samples = _ml_parts(spark, sf_dir)
    model = fit_linear(samples.where(F.col("split") == "train"), solver="normal")
    path = scratch_path(spark, "model")
    save_model(model, path)
    test = samples.where(F.col("split") == "test")
    a = predict(model, test).select("ticker", "k", F.col("yhat_s").alias("saved"))
    b = predict(load_model(spark, path), test).select("ticker", "k", F.col("yhat_s").alias("loaded"))
    return a.join(b, ["ticker", "k"]).agg(F.count("*").alias("n"), F.count_if(F.col("saved") != F.col("loaded")).alias("differ"))


EPOCHS, PATIENCE = 12, 3


def _gbt_samples(spark, sf_dir):
    """The scaled series, and its samples in three parts, written once: every tree reads them."""
    from candela.operators.features import sequence_samples, three_way_split
    from candela.plans.materialize import materialize
    d = scaled_orders(spark, sf_dir)
    return d, materialize(three_way_split(sequence_samples(d, L), 0.7, 0.15), "samples")


def _gbt(spark, sf_dir):
    from candela.operators.forecast import fit_gbt
    d, s = _gbt_samples(spark, sf_dir)
    return d, s, fit_gbt(s.where(F.col("split") == "train"), epochs=10)


@query("gbt_beats_persistence")
def q_gbt_beats_persistence(spark, sf_dir):
    """Per ticker: the trees' test error is below that of repeating the last close."""
    from candela.operators.forecast import predict
    _, s, model = _gbt(spark, sf_dir)
    pred = predict(model, s.where(F.col("split") == "test"))
    square = lambda c: F.avg((F.col("y") - c) * (F.col("y") - c))
    return pred.groupBy("ticker").agg((square(F.col("yhat_s")) < square(F.element_at("x", -1))).alias("better"))


def _gbt_rollout(spark, sf_dir):
    from candela.operators.features import seed_window
    from candela.operators.forecast import rollout_model
    d, _, model = _gbt(spark, sf_dir)
    return d, model, rollout_model(model, seed_window(d, L, "latest").select("ticker", "seed"), DAYS, L)


@query("forecast_gbt")
def q_forecast_gbt(spark, sf_dir):
    d, _, rolled = _gbt_rollout(spark, sf_dir)
    return _model_forecast(d, rolled.select("ticker", "path"))


@query("gbt_rollout_check")
def q_gbt_rollout_check(spark, sf_dir):
    """every day of the folded roll-out is what the fitted model itself predicts from the L values before."""
    from candela.operators.forecast import explode_path, predict
    d, model, rolled = _gbt_rollout(spark, sf_dir)
    whole = F.concat(F.col("seed").cast("array<double>"), F.col("path"))
    days = explode_path(rolled.withColumn("whole", whole), out="folded")
    windows = days.withColumn("x", F.slice("whole", F.size("whole") - DAYS + F.col("step") - L, F.lit(L)))
    pred = predict(model, windows.select("ticker", "step", "x", "folded"))
    return pred.select("ticker", "step", (F.abs(F.col("yhat_s") - F.col("folded")) < 1e-9).alias("agrees"))


def _gbt_patience(spark, sf_dir):
    from candela.operators.trees import grow_until
    d, s = _gbt_samples(spark, sf_dir)
    train, valid = (s.where(F.col("split") == x) for x in ("train", "valid"))
    return d, s, valid, *grow_until(train, valid, EPOCHS, PATIENCE)


@query("gbt_early_stop")
def q_gbt_early_stop(spark, sf_dir):
    """M4: the rounds grown after the best one are the patience (unless the epochs end first), and the trees kept
    have the lowest validation loss of all rounds, measured anew on the validation samples."""
    from candela.operators.forecast import predict
    _, _, valid, model, losses = _gbt_patience(spark, sf_dir)
    grown, best = len(losses), len(model.trees)
    error = predict(model, valid).agg(F.avg((F.col("y") - F.col("yhat_s")) ** 2).alias("loss"))
    return error.select(F.lit(grown - best == PATIENCE or grown == EPOCHS).alias("stopped_in_time"),
                        F.lit(losses[best - 1] == min(losses)).alias("kept_best"),
                        (F.abs(F.col("loss") - F.lit(losses[best - 1])) < 1e-12).alias("loss_is_that_round"))


@query("gbt_early_stop_rmse")
def q_gbt_early_stop_rmse(spark, sf_dir):
    from candela.operators.features import inverse_scale_expr
    from candela.operators.forecast import predict
    d, s, _, model, losses = _gbt_patience(spark, sf_dir)
    st = d.where(F.col("pos") == F.col("n")).select("ticker", "lo", "hi")
    pred = predict(model, s.where(F.col("split") == "test")).join(st, "ticker")
    out = agg.rmse(pred.select("ticker", inverse_scale_expr("y").alias("actual"),
                               inverse_scale_expr("yhat_s").alias("predicted")))
    return out.withColumn("n_trees", F.lit(len(model.trees))).withColumn("n_grown", F.lit(len(losses)))


# ---------------------------------------------------------------- exports
@query("feed_export")
def q_feed_export(spark, sf_dir):
    """K3: the candle feed written as a Parquet table partitioned by trace, read back."""
    from candela.session import scratch_path
    from candela.sinks.writers import write_feed
    path = scratch_path(spark, "feed")
    write_feed(QUERIES["candle_feed"](spark, sf_dir), path, partition_by=["trace"])
    return spark.read.parquet(path).select("ticker", "trace", "x", "open", "high", "low", "close", "y")


@query("quote_json")
def q_quote_json(spark, sf_dir):
    """One-shot fetch: the latest quote of each ticker as one JSON document."""
    from candela.sources.quotes import latest_quote, quote_records
    from candela.sources.ticks import load_event_ticks
    rec = quote_records(latest_quote(load_event_ticks(spark, sf_dir)), "events")
    return rec.select("ticker", F.to_json(F.struct(*rec.columns)).alias("json"))
