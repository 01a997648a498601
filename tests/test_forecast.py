import datetime as dt

from pyspark.sql import functions as F

from candela.operators import aggregates as agg
from candela.operators import features as fe
from candela.operators import forecast as fc

D0 = dt.date(2024, 1, 1)


def series(spark, closes, ticker="A", start=D0):
    rows = [(ticker, start + dt.timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, close double")


def _forecast(spark, closes, days=30, L=5):
    d = fe.minmax_scale(series(spark, closes))
    pairs = fc.ar1_pairs(d, L, 0.8)
    coefs = fc.ar1_fit(pairs)
    return d, pairs, coefs, fc.ar1_forecast(d, coefs, days, "latest", L)


def test_ar1_rollout_matches_python_recursion(spark):
    closes = [10 + (i % 5) + 0.1 * i for i in range(40)]
    d, pairs, coefs, f = _forecast(spark, closes)
    c = coefs.collect()[0]
    lo, hi = min(closes), max(closes)
    v = (closes[-1] - lo) / (hi - lo)
    got = sorted(f.collect(), key=lambda r: r.step)
    assert len(got) == 30
    for r in got:
        v = c.a + c.b * v
        assert abs(r.yhat - (v * (hi - lo) + lo)) < 1e-9
        assert r.target_date == D0 + dt.timedelta(days=39 + r.step)


def test_forecast_candles_guard(spark):
    closes = [10 + (i % 5) for i in range(40)]
    d, _, coefs, f = _forecast(spark, closes)
    last = fc.last_close(series(spark, closes))
    counts = [fc.forecast_candles(f, last, n, "2024-06-01").count() for n in (0, 30, 31)]
    assert counts == [0, 30, 0]
    c = sorted(fc.forecast_candles(f, last, 3, "2024-06-01").collect(), key=lambda r: r.step)
    assert c[0].open == closes[-1] and c[1].open == c[0].close
    for r in c:
        assert abs(r.high - max(r.open, r.close) * 1.01) < 1e-12
        assert abs(r.low - min(r.open, r.close) * 0.99) < 1e-12
    assert c[0].target_date == dt.date(2024, 6, 2)


def test_future_dates_include_weekends(spark):
    friday = dt.date(2024, 1, 5)
    closes = [10 + (i % 3) for i in range(20)]
    d = fe.minmax_scale(series(spark, closes, start=friday - dt.timedelta(days=19)))
    coefs = fc.ar1_fit(fc.ar1_pairs(d, 5, 0.8))
    f = fc.ar1_forecast(d, coefs, 3, "latest", 5)
    days = sorted(r.target_date.weekday() for r in f.collect())
    assert days == [0, 5, 6]      # Saturday, Sunday and Monday follow the Friday


def test_rmse_price_is_scaled_rmse_times_range(spark):
    closes = [10 + (i % 7) * 1.5 + 0.05 * i for i in range(80)]
    d, pairs, coefs, _ = _forecast(spark, closes, L=5)
    pv = fc.ar1_predict_test(pairs, coefs)
    price = agg.rmse(pv).collect()[0].rmse
    te = pairs.where("split = 'test'").join(coefs, "ticker") \
        .select("ticker", F.col("y").alias("actual"), (F.col("a") + F.col("b") * F.col("x_last")).alias("predicted"))
    scaled = agg.rmse(te).collect()[0].rmse
    assert abs(price - scaled * (max(closes) - min(closes))) < 1e-9


def test_short_series_gets_no_forecast(spark):
    _, _, _, f = _forecast(spark, list(range(5)), L=5)
    assert f.count() == 0


def test_linear_rollout_generic_weights(spark):
    seeds = spark.createDataFrame([("A", [1.0, 2.0])], "ticker string, seed array<double>")
    out = fc.rollout_linear(seeds, [0.5, 0.5], 1.0, 3).collect()[0].path
    assert out == [2.5, 3.25, 3.875]


def test_pooled_linear_model_learns_linear_rule(spark):
    rows = []
    for i in range(40):
        x0, x1 = float(i % 7), float((i * 3) % 5)
        rows.append(("A", D0 + dt.timedelta(days=i), i + 1, [x0, x1], 0.2 + 0.3 * x0 + 0.7 * x1))
    s = spark.createDataFrame(rows, "ticker string, bar_date date, k int, x array<double>, y double")
    m = fc.fit_linear(s, solver="normal")
    assert abs(m.intercept - 0.2) < 1e-6
    assert abs(m.coefficients[0] - 0.3) < 1e-6 and abs(m.coefficients[1] - 0.7) < 1e-6
    # the iterative solver is as good as its epochs
    error = [abs(fc.fit_linear(s, epochs=n).coefficients[1] - 0.7) for n in (1, 50)]
    assert error[0] > 1e-3 > error[1]


def test_one_sample_and_nothing_to_train_on_forecasts_persistence(spark):
    _, _, coefs, f = _forecast(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 7.0], L=5)
    assert coefs.count() == 0
    assert {round(r.yhat, 9) for r in f.collect()} == {7.0}


def _samples(spark, n=160, noise=0.0):
    import random
    rng = random.Random(3)
    rows = [("A", D0 + dt.timedelta(days=i), i, [float(i % 7), float((i * 3) % 5)], float(i % 7 > 3) + noise * rng.random()) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, k int, x array<double>, y double")


def test_boosting_stops_where_it_should(spark, monkeypatch):
    """Trees are counted as they are fitted: the best round, and the patience after it, no more."""
    from pyspark.ml.regression import DecisionTreeRegressor
    from candela.operators.trees import grow_until
    fits = []
    fit = DecisionTreeRegressor.fit
    monkeypatch.setattr(DecisionTreeRegressor, "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    s = _samples(spark, noise=3.0)
    for patience in (1, 3):
        fits.clear()
        model, losses = grow_until(s.where("k < 110"), s.where("k >= 110"), epochs=40, patience=patience)
        best = losses.index(min(losses)) + 1
        assert len(fits) == len(losses) == best + patience < 40 and len(model.trees) == best
    fits.clear()
    _, losses = grow_until(s.where("k < 110"), s.where("k >= 110"), epochs=2, patience=9)
    assert len(fits) == len(losses) == 2


def test_trees_as_columns_predict_what_the_models_predict(spark):
    from candela.operators.trees import grow_until, model_column
    s = _samples(spark, noise=1.0)
    gbt = fc.fit_gbt(s, epochs=5)
    at = lambda i: F.element_at("x", i + 1)
    both = fc.predict(gbt, s).withColumn("column", model_column(gbt, at))
    assert both.where(F.abs(F.col("column") - F.col("yhat_s")) > 1e-12).count() == 0
    grown, losses = grow_until(s, s, epochs=4, patience=4)
    assert losses == sorted(losses, reverse=True)          # on its own training rows boosting only gets better
    error = fc.predict(grown, s).agg(F.avg((F.col("y") - F.col("yhat_s")) ** 2)).first()[0]
    assert abs(error - losses[-1]) < 1e-12


def test_tree_rollout_feeds_predictions_back(spark):
    s = _samples(spark, noise=1.0)
    gbt = fc.fit_gbt(s, epochs=4)
    seeds = spark.createDataFrame([("A", [9.0, 3.0, 1.0]), ("B", [0.0, 4.0, 4.5])], "ticker string, seed array<double>")
    paths = {r.ticker: r.path for r in fc.rollout_model(gbt, seeds, days=6, L=2).collect()}
    for ticker, window in (("A", [3.0, 1.0]), ("B", [4.0, 4.5])):
        for value in paths[ticker]:
            one = spark.createDataFrame([(window,)], "x array<double>")
            assert abs(fc.predict(gbt, one).first().yhat_s - value) < 1e-12
            window = [window[1], value]


def test_gram_matrix_equals_the_windows(spark):
    import numpy as np
    from candela.operators.features import chrono_split, scaled_series, sequence_samples
    from candela.operators.gram import fit_linear_gram, gram_matrix, solve, window_products
    rng = np.random.default_rng(2)
    v = rng.random(50)
    for a, b in ((4, 49), (4, 4), (10, 30), (5, 4)):
        w = np.array([[*v[t - 4:t + 1][::-1], 1.0] for t in range(a, b + 1)]).reshape(-1, 6)
        assert np.allclose(window_products(v, a, b, 4), w.T @ w, atol=1e-12)
    rows = [(t, D0 + dt.timedelta(days=i), float(p)) for t, n in (("A", 200), ("B", 90), ("C", 7), ("D", 5)) for i, p in enumerate(rng.random(n))]
    rows += [("E", D0 + dt.timedelta(days=i), None if i in (20, 41) else float(p)) for i, p in enumerate(rng.random(70))]
    scaled = scaled_series(spark.createDataFrame(rows, "ticker string, bar_date date, close double"))
    train = chrono_split(sequence_samples(scaled, 6), 0.8).where("split = 'train'")
    x = np.array([[r.y, *r.x[::-1], 1.0] for r in train.collect()])
    for chunk in (16, 4096):
        g = gram_matrix(scaled, 6, 0.8, chunk=chunk)
        assert np.allclose(g, x.T @ x, atol=1e-10)
    fit, ml = fit_linear_gram(scaled, 6), fc.fit_linear(train, solver="normal")
    assert np.allclose(fit.coefficients, ml.coefficients, atol=1e-9) and abs(fit.intercept - ml.intercept) < 1e-9
    pred = fc.predict(fit, train).agg(F.avg((F.col("y") - F.col("yhat_s")) ** 2)).first()[0]
    assert abs(pred - fit.loss) < 1e-12 and fit.n == len(x)
    assert [r.path for r in fc.rollout_linear(spark.createDataFrame([("A", [0.5] * 6)], "ticker string, seed array<double>"),
                                              fit.coefficients, fit.intercept, 2).collect()]
    import pytest
    with pytest.raises(ValueError, match="no sample"):
        solve(np.zeros((8, 8)))


def test_patience_keeps_the_best_round_and_models_are_saved(spark, tmp_path):
    from candela.sinks.models import load_model, save_model, saved_metric
    rows = [("A", D0, i, [float(i % 7), float((i * 3) % 5)], float(i % 7 > 3)) for i in range(80)]
    s = spark.createDataFrame(rows, "ticker string, bar_date date, k int, x array<double>, y double")
    model, stopped, best = fc.fit_gbt_patience(s.where("k < 60"), s.where("k >= 60"), epochs=6, patience=1)
    assert len(model.trees) == best <= stopped <= 6
    path = str(tmp_path / "m")
    assert save_model(model, path, 0.5) and not save_model(model, path, 0.7) and saved_metric(spark, path) == 0.5
    assert [r.yhat_s for r in fc.predict(load_model(spark, path), s).collect()] == [r.yhat_s for r in fc.predict(model, s).collect()]
