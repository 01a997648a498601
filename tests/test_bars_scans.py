import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from candela.functions.expr import split_tickers
from candela.operators import aggregates as agg
from candela.sources import scans
from candela.sources.bars import build_bars
from tests.conftest import SF001

TS = dt.datetime(2024, 1, 2, 9, 30)


def ticks(spark, rows):
    return spark.createDataFrame(rows, "ticker string, ts timestamp_ntz, price double, qty double, tick_id bigint")


def test_equal_timestamps_higher_id_is_close(spark):
    t = ticks(spark, [("A", TS, 10.0, 1.0, 2), ("A", TS, 11.0, 2.0, 1),
                      ("A", TS + dt.timedelta(hours=1), 9.0, 3.0, 0)])
    b = build_bars(t, "day").collect()[0]
    assert (b.open, b.high, b.low, b.close, b.volume, b.n_ticks) == (11.0, 11.0, 9.0, 9.0, 6, 3)
    h = {r.bar_ts: r for r in build_bars(t, "hour").collect()}
    hr = TS.replace(minute=0)
    assert h[hr].open == 11.0 and h[hr].close == 10.0


def test_unknown_period_raises(spark):
    with pytest.raises(ValueError):
        build_bars(ticks(spark, [("A", TS, 1.0, 1.0, 1)]), "fortnight")


def test_missing_column_raises_naming_it(spark):
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0, 2.0, 1.5)],
                                 "ticker string, bar_date date, open double, high double, close double")
    with pytest.raises(ValueError, match="low"):
        scans.ohlcv_history(bars, ["A"])


def test_empty_union_raises():
    with pytest.raises(ValueError):
        scans.union_frames([])


def test_split_tickers():
    assert split_tickers(" AAPL, ,MSFT ,") == ["AAPL", "MSFT"]
    assert split_tickers("") == []


def test_availability_and_semi_anti(spark):
    bars = spark.createDataFrame([("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5)],
                                 "ticker string, bar_date date, open double, high double, low double, close double")
    rep = {r.ticker: (r.pos, r.n_bars, r.status) for r in scans.availability(bars, ["Z", "A"]).collect()}
    assert rep == {"Z": (0, 0, "no_data"), "A": (1, 1, "ok")}
    assert [tuple(r) for r in scans.tickers_with_data(bars, ["Z", "A"]).collect()] == [(1, "A")]
    assert [tuple(r) for r in scans.tickers_without_data(bars, ["Z", "A"]).collect()] == [(0, "Z")]
    no_low = bars.drop("low")
    assert {r.status for r in scans.availability(no_low, ["A"]).collect()} == {"missing_columns"}


def test_mean_close_nan_and_null_key(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, "A"), (dt.date(2024, 1, 2), float("nan"), "A"),
                               (dt.date(2024, 1, 3), 3.0, "A"), (dt.date(2024, 1, 1), 5.0, None)],
                              "Date date, Close double, Ticker string")
    m = {r.Ticker: r.mean_close for r in agg.mean_close(s).collect()}
    assert m == {"A": 2.0}
    sq = {r.Ticker: r.avg_close for r in agg.avg_close_sql(spark, s, "stocks_t").collect()}
    assert math.isnan(sq["A"]) and sq[None] == 5.0


def test_wide_roundtrip(spark):
    bars = spark.createDataFrame(
        [("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 10), ("B", dt.date(2024, 1, 2), 3.0, 4.0, 2.5, 3.5, 20),
         ("A", dt.date(2024, 1, 3), 1.5, 2.5, 1.0, 2.0, 30)],
        "ticker string, bar_date date, open double, high double, low double, close double, volume bigint")
    wide = scans.widen_bars(bars, ["A", "B"])
    assert "Close|A" in wide.columns and "Volume|B" in wide.columns
    back = scans.tidy_wide_bars(wide)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, bars.collect()))


def test_tidy_missing_field_raises(spark):
    wide = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0, 2.0, 1.5)],
                                 "Date date, `Open|A` double, `High|A` double, `Close|A` double")
    with pytest.raises(ValueError, match="Low"):
        scans.tidy_wide_bars(wide)


def test_head_rows_keeps_request_order(spark):
    s = spark.createDataFrame([(dt.date(2024, 1, d), float(d), t) for t in "AB" for d in (1, 2, 3)],
                              "Date date, Close double, Ticker string")
    got = [(r.Ticker, r.Date.day) for r in scans.head_rows(s, ["B", "A"], 4).collect()]
    assert got == [("B", 1), ("B", 2), ("B", 3), ("A", 1)]


def test_head_rows_builds_only_the_bars_it_shows(spark):
    from candela.plans.queries import PICK, union_stocks
    stocks = union_stocks(spark, SF001)
    head = scans.head_rows(stocks, PICK, 5)
    want = [r for t in PICK for r in sorted(stocks.where(F.col("Ticker") == t).collect(), key=lambda r: r.Date)][:5]
    assert [tuple(r) for r in head.collect()] == [(r.Date, r.Close, r.Ticker) for r in want]
    plan = head._jdf.queryExecution().optimizedPlan().toString()
    prices = plan.index("max_by")          # the aggregate of the closes: the semi-join lies below it, over the ticks
    assert "Join LeftSemi" in plan[prices:]


def test_cli_end_to_end(spark, tmp_path):
    from candela.cli import parse, run
    out = str(tmp_path / "out")
    s = run(parse(["--sf-dir", "/root/testdata/sf0.001", "--out", out, "--candlestick",
                   "--include-volume", "--forecast-candles", "5", "--model", "ar1",
                   "--as-of", "2024-01-01"]))
    assert s["history_rows"] > 60 and s["rmse"] is not None
    feed = spark.read.parquet(f"{out}/feed")
    assert {r.trace for r in feed.select("trace").distinct().collect()} == \
        {"ohlc", "volume", "forecast_ohlc", "predicted", "realtime"}


@pytest.mark.parametrize("feed", [[], ["--candlestick", "--include-volume", "--forecast-candles", "5"]])
def test_cli_without_training_calls_no_model(spark, tmp_path, monkeypatch, feed):
    """M5: nothing is fitted, loaded or forecast; history and feed are written as they are with training."""
    from candela.cli import parse, run
    from candela.operators import forecast

    def called(*a, **k):
        raise AssertionError("a model was called")

    for name in ("ar1_fit", "fit_linear", "fit_gbt", "fit_gbt_patience", "rollout_linear", "rollout_model", "predict", "forecast_candles"):
        monkeypatch.setattr(forecast, name, called)
    out = str(tmp_path / "out")
    s = run(parse(["--sf-dir", SF001, "--out", out, "--no-train", "--model", "gbt", "--checkpoint", f"{out}/model", *feed]))
    assert s["history_rows"] > 60 and set(s) == {"history_rows"}
    assert not os.path.exists(f"{out}/forecast") and not os.path.exists(f"{out}/model")
    traces = {r.trace for r in spark.read.parquet(f"{out}/feed").select("trace").distinct().collect()}
    assert traces == ({"ohlc", "volume", "realtime"} if feed else {"history", "realtime"})
    with pytest.raises(AssertionError, match="a model was called"):
        run(parse(["--sf-dir", SF001, "--out", f"{out}2", "--model", "gbt"]))


def test_daily_bars_of_lines_need_no_sort(spark):
    """Ticks of one day in the order of their packed keys; the plan has hash aggregates alone."""
    import random
    from candela.sources.bars import build_bars
    from candela.sources.ticks import lineitem_ticks, packed_key
    rng = random.Random(2)
    big = [10**13 - 2, 998, 10**12 - 2, 10**10 - 2]
    rows = [[rng.choice([1, 7, big[0], None]), rng.choice([1, 2, big[1]]), rng.choice([1, 2, 3, big[2]]), rng.choice([1, 2, big[3], None]),
             1.0, float(rng.randrange(100)), dt.datetime(2024, 1, 1 + rng.randrange(3))] for _ in range(400)]
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
    lines = spark.createDataFrame(rows, schema).dropDuplicates(["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    part = spark.createDataFrame([(k, "B") for k in (1, 2, 3, big[2])], "p_partkey long, p_brand string")
    ticks = lineitem_ticks(lines, part)
    want = sorted(map(tuple, build_bars(ticks.drop("day_seq"), "day").collect()))
    bars = build_bars(ticks, "day")
    assert sorted(map(tuple, bars.collect())) == want and len(want) == 3
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    with pytest.raises(Exception, match="out of its range"):
        spark.range(2000).select(packed_key([("id", 3)])).collect()


def test_tidy_single_level_header(spark):
    wide = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5, 7)],
                                 "Date date, Open double, High double, Low double, Close double, Volume bigint")
    r = scans.tidy_wide_bars(wide).collect()
    assert len(r) == 1 and r[0].ticker is None and (r[0].open, r[0].close, r[0].volume) == (1.0, 1.5, 7)


def test_tidy_required_part_wins(spark):
    # the part that names a field is the field, whichever position it has
    wide = spark.createDataFrame([(dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5)],
                                 "Date date, `X|Open` double, `High|X` double, `X|Low` double, `Close|X` double")
    r = scans.tidy_wide_bars(wide, include_volume=False).collect()
    assert [(x.ticker, x.open, x.high, x.low, x.close) for x in r] == [("X", 1.0, 2.0, 0.5, 1.5)]


def test_one_ticker_as_a_string_is_one_ticker(spark):
    bars = spark.createDataFrame([("AAPL", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5)],
                                 "ticker string, bar_date date, open double, high double, low double, close double")
    assert [(r.ticker, r.n_bars, r.status) for r in scans.availability(bars, "AAPL").collect()] == [("AAPL", 1, "ok")]
    assert scans.tickers_with_data(bars, "AAPL").count() == 1 and scans.tickers_without_data(bars, "AAPL").count() == 0
    from candela.operators.feeds import grid_feed
    assert {r.ticker for r in grid_feed(bars, "AAPL").collect()} == {"AAPL"}


def test_availability_is_per_ticker(spark):
    rows = [("A", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5), ("B", dt.date(2024, 1, 2), 1.0, 2.0, None, 1.5)]
    bars = spark.createDataFrame(rows, "ticker string, bar_date date, open double, high double, low double, close double")
    assert {r.ticker: r.status for r in scans.availability(bars, ["A", "B", "C"]).collect()} == \
        {"A": "ok", "B": "missing_columns", "C": "no_data"}


def test_no_rows_is_an_error_where_asked(spark):
    bars = spark.createDataFrame([], "ticker string, bar_date date, open double, high double, low double, close double")
    assert scans.ohlcv_history(bars, ["A"]).count() == 0
    with pytest.raises(ValueError, match="A"):
        scans.ohlcv_history(bars, ["A"], must_exist=True)


def test_nan_counts_as_missing(spark):
    nan = float("nan")
    bars = spark.createDataFrame([("A", dt.date(2024, 1, d), 1.0, h, lo, c) for d, h, lo, c in
                                  [(1, 2.0, 0.5, 1.0), (2, nan, nan, nan), (3, 3.0, 0.25, 2.0)]],
                                 "ticker string, bar_date date, open double, high double, low double, close double")
    assert tuple(agg.candle_summary(bars).first())[1:] == (3, 0.25, 3.0)
    assert tuple(agg.scaler_state(bars).first())[1:] == (1.0, 2.0)


def test_volume_is_rounded_after_the_sum_and_null_ids_count(spark):
    b = build_bars(ticks(spark, [("A", TS, 1.0, 0.4, 1), ("A", TS, 1.0, 0.4, 2)])).first()
    assert b.volume == 1
    from candela.sources.ticks import with_seq
    rows = [("A", TS, 1.0, 1.0, None), ("A", TS, 2.0, 1.0, 7), ("A", TS + dt.timedelta(hours=1), 3.0, 1.0, None)]
    for t in (ticks(spark, rows), with_seq(ticks(spark, rows))):
        r = build_bars(t).first()
        assert (r.open, r.close) == (1.0, 3.0)


def test_wide_header_names_the_ticker_that_lacks_a_field(spark):
    cols = ", ".join(f"`{f}|{t}` double" for t in "AB" for f in ("Open", "High", "Low", "Close") if (f, t) != ("High", "B"))
    wide = spark.createDataFrame([(dt.date(2024, 1, 2), *[1.0] * 7)], f"Date date, {cols}")
    with pytest.raises(ValueError, match="High of B"):
        scans.tidy_wide_bars(wide)
