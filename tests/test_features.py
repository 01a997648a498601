import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela.operators import features as fe
from candela.operators.indicators import macd, rsi
from candela.operators.position import with_position
from candela.plans import catalog as cat
from tests.conftest import SF01

D0 = dt.date(2024, 1, 1)


def series(spark, closes, ticker="A"):
    rows = [(ticker, D0 + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, close double")


def test_constant_series_scales_to_zero_and_restores(spark):
    d = fe.minmax_scale(series(spark, [5.0] * 5))
    rows = d.select("s", fe.inverse_scale_expr("s").alias("back")).collect()
    assert all(r.s == 0.0 and r.back == 5.0 for r in rows)


def test_sample_counts_at_L_and_L_plus_1(spark):
    L = 60
    for n, expect in ((L, 0), (L + 1, 1)):
        d = fe.minmax_scale(series(spark, range(n)))
        s = fe.sequence_samples(d, L)
        assert s.count() == expect
        if expect:
            sp = fe.chrono_split(s, 0.8).collect()
            assert [r.split for r in sp] == ["test"]      # int(1 * 0.8) = 0 train rows


def test_samples_content(spark):
    d = fe.minmax_scale(series(spark, range(10)))
    s = {r.k: r for r in fe.sequence_samples(d, 3, chunk=3).collect()}
    assert len(s) == 7
    assert [round(v * 9) for v in s[1].x] == [0, 1, 2] and round(s[1].y * 9) == 3
    assert [round(v * 9) for v in s[7].x] == [6, 7, 8]


def test_halo_equals_plain_window(spark):
    d = with_position(fe.minmax_scale(cat.order_bars(spark, SF01)))
    halo = fe.sequence_samples(d, 60, chunk=64)          # many chunks per ticker
    plain = fe.sequence_samples_plain(d.drop("pos"), 60)
    assert halo.count() == plain.count() == 8323
    assert halo.exceptAll(plain).count() == 0 and plain.exceptAll(halo).count() == 0


def test_position_is_dense_and_ordered(spark):
    d = with_position(cat.order_bars(spark, SF01), bucket="week")
    bad = d.groupBy("ticker").agg(F.count("*").alias("n"), F.min("pos").alias("a"),
                                  F.max("pos").alias("b"), F.countDistinct("pos").alias("u")) \
        .where("a != 1 OR b != n OR u != n").count()
    assert bad == 0


def test_rsi_halo_matches_plain(spark):
    from pyspark.sql import Window
    b = cat.order_bars(spark, SF01)
    got = {(r.ticker, r.bar_date): r.rsi for r in rsi(b, 14, chunk=32).collect()}
    w = Window.partitionBy("ticker").orderBy("bar_date")
    d = b.withColumn("pos", F.row_number().over(w)).withColumn("dl", F.col("close") - F.lag("close").over(w))
    fr = w.rowsBetween(-13, 0)
    d = d.withColumn("g", F.avg(F.greatest("dl", F.lit(0.0))).over(fr)) \
        .withColumn("l", F.avg(F.greatest(-F.col("dl"), F.lit(0.0))).over(fr)).where("pos > 14")
    exp = {(r.ticker, r.bar_date): (100.0 if r.l == 0 else 100 - 100 / (1 + r.g / r.l)) for r in d.collect()}
    assert got.keys() == exp.keys()
    assert max(abs(got[k] - exp[k]) for k in exp) < 1e-9


@pytest.mark.parametrize("spans, chunk", [((12, 26, 9), 64), ((50, 200, 9), 64), ((400, 2000, 1), 100)])
def test_macd_matches_recursion(spark, spans, chunk):
    closes = [100 + ((i * 37) % 23) - 0.5 * (i % 7) for i in range(2000)]
    out = sorted(macd(series(spark, closes), *spans, chunk=chunk).collect(), key=lambda r: r.bar_date)
    a12, a26, a9 = (2 / (n + 1) for n in spans)
    e12 = e26 = closes[0]
    sig = 0.0
    for i, x in enumerate(closes):
        if i:
            e12 = a12 * x + (1 - a12) * e12
            e26 = a26 * x + (1 - a26) * e26
            sig = a9 * (e12 - e26) + (1 - a9) * sig
        r = out[i]
        assert abs(r.macd - (e12 - e26)) < 1e-9 and abs(r.signal - sig) < 1e-9


def test_three_way_and_last_n(spark):
    d = fe.minmax_scale(series(spark, range(100)))
    s = fe.sequence_samples(d, 10)                         # 90 samples
    c = {r.split: r.n for r in fe.three_way_split(s, 0.7, 0.15).groupBy("split")
         .agg(F.count("*").alias("n")).collect()}
    assert c == {"train": 62, "valid": 14, "test": 14}   # int(90 * 0.7) == 62 in floating point
    tail = fe.last_n_bars(series(spark, range(30)), 5).select("close").collect()
    assert sorted(r.close for r in tail) == [25.0, 26.0, 27.0, 28.0, 29.0]


def test_seed_window_modes(spark):
    d = fe.minmax_scale(series(spark, range(11)))
    latest = fe.seed_window(d, 3, "latest").collect()[0]
    ref = fe.seed_window(d, 3, "reference").collect()[0]
    assert [round(v * 10) for v in latest.seed] == [8, 9, 10]
    assert [round(v * 10) for v in ref.seed] == [7, 8, 9]


def test_missing_close_keeps_its_place(spark):
    """A window with a NULL or NaN is left out; the lags of the others stay aligned."""
    closes = [float(i) for i in range(12)]
    closes[3] = float("nan")
    d = series(spark, closes).withColumn("s", F.col("close")).union(
        series(spark, range(12), "B").withColumn("s", F.when(F.col("close") != 7, F.col("close"))))
    got = {(r.ticker, r.k): (r.x, r.y) for r in fe.sequence_samples(d, L=3).collect()}
    assert all(y == k + 2.0 and x == [k - 1.0, float(k), k + 1.0] for (_, k), (x, y) in got.items())
    assert sorted(k for t, k in got if t == "A") == [5, 6, 7, 8, 9]
    assert sorted(k for t, k in got if t == "B") == [1, 2, 3, 4, 9]


def test_scaled_series_carries_what_the_splits_need(spark):
    d = fe.scaled_series(series(spark, range(20)))
    first = d.orderBy("pos").first()
    assert (first.n, first.lo, first.hi, first.last_close, first.s) == (20, 0.0, 19.0, 19.0, 0.0)
    s = fe.chrono_split(fe.sequence_samples(d, L=5), 0.8)
    assert s.where("split = 'train'").count() == 12 and "n" not in s.columns


def test_training_status_reports_short_series(spark):
    bars = series(spark, range(5)).union(series(spark, range(6), "B")).union(series(spark, range(30), "C"))
    got = {r.ticker: (r.n_samples, r.n_train, r.status) for r in fe.training_status(bars, L=5, min_train=2).collect()}
    assert got == {"A": (0, 0, "insufficient_history"), "B": (1, 0, "insufficient_history"), "C": (25, 20, "ok")}
