"""One-step forecasters and recursive roll-outs.

The reference trains a Keras LSTM on one ticker in the driver.  Here the
models are Spark ones:

* ``ar1`` — per-ticker AR(1) on the scaled series, fitted with the
  ``regr_slope``/``regr_intercept`` aggregates (a partial aggregate per
  ticker, nothing gathered).
* ``lr`` — one pooled linear model on the L lagged values of all tickers: from
  the sums of lagged products (:mod:`candela.operators.gram`) or, by epochs,
  ``LinearRegression``.
* ``gbt`` — pooled boosted trees for the non-linear case: ``GBTRegressor``, or
  trees grown until the validation loss stops falling (:mod:`candela.operators.trees`).

Only model coefficients and thresholds reach the driver.  A roll-out is a
higher-order ``aggregate`` over ``sequence(1, days)`` on one row per ticker,
with the model as a column expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.operators.features import chrono_split, inverse_scale_expr, lagged
from candela.operators.position import series_counts, with_position


def with_length(scaled: DataFrame) -> DataFrame:
    """Positions and the series length, computed only where the input lacks them."""
    d = scaled if "pos" in scaled.columns else with_position(scaled)
    return d if "n" in d.columns else d.join(series_counts(scaled), "ticker")


# ---------------------------------------------------------------- AR(1)
def ar1_pairs(scaled: DataFrame, L: int = 60, frac: float = 0.8, value: str = "s") -> DataFrame:
    """(x_last, y) of every sample k = pos - L, with its train/test split.

    Equal to ``(element_at(x, -1), y)`` of :func:`sequence_samples` without
    materialising the L-long arrays.
    """
    d = with_length(scaled)
    lg = lagged(d, value, 1).where(F.col("pos") > L)
    pairs = lg.select("ticker", "bar_date", (F.col("pos") - L).alias("k"),
                      F.col(f"{value}_lag1").alias("x_last"), F.col(value).alias("y"),
                      "lo", "hi", F.greatest(F.col("n") - L, F.lit(0)).alias("n"))
    return chrono_split(pairs, frac)


def ar1_fit(pairs: DataFrame) -> DataFrame:
    """M1 (AR(1)): ``y = a + b * x_last`` per ticker on the train part.

    A ticker whose fit is undefined (fewer than two points or constant
    input) falls back to persistence, a = 0 and b = 1.
    """
    tr = pairs.where(F.col("split") == "train")
    return tr.groupBy("ticker").agg(
        F.coalesce(F.regr_intercept("y", "x_last"), F.lit(0.0)).alias("a"),
        F.coalesce(F.regr_slope("y", "x_last"), F.lit(1.0)).alias("b"),
        F.count(F.lit(1)).alias("n_train"))


def ar1_predict_test(pairs: DataFrame, coefs: DataFrame) -> DataFrame:
    """M2 + J3: one-step predictions of the test samples next to the actuals."""
    te = pairs.where(F.col("split") == "test").join(coefs.select("ticker", "a", "b"), "ticker")
    yhat = F.col("a") + F.col("b") * F.col("x_last")
    return te.select("ticker", "bar_date", "k",
                     inverse_scale_expr("y").alias("actual"),
                     inverse_scale_expr(yhat).alias("predicted"))


# ---------------------------------------------------------------- roll-outs
def rollout_linear(seed: DataFrame, weights, intercept, days: int = 30,
                   seed_col: str = "seed") -> DataFrame:
    """F5 for a linear model: predict, drop the oldest value, append, repeat.

    ``weights``/``intercept`` are Columns (per-ticker models) or Python
    numbers (a pooled model); weights apply to the last ``len(weights)``
    values, oldest first.  Adds ``path array<double>`` of ``days`` values.
    """
    if isinstance(weights, (list, tuple)):
        w = F.array(*[F.lit(float(v)) for v in weights])
        p = len(weights)
    else:
        w, p = weights, None
    c = intercept if not isinstance(intercept, (int, float)) else F.lit(float(intercept))
    size = F.lit(p) if p is not None else F.size(w)

    def step(acc, _i):
        window = F.slice(acc, -size, size) if p is None else F.slice(acc, -p, p)
        dot = F.aggregate(F.zip_with(window, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return F.concat(acc, F.array(c + dot))

    start = F.col(seed_col).cast("array<double>")
    path = F.aggregate(F.sequence(F.lit(1), F.lit(days)), start, step)
    return seed.withColumn("path", F.slice(path, -days, days))


def explode_path(df: DataFrame, path: str = "path", out: str = "yhat_s") -> DataFrame:
    """One row per forecast step: ``step`` 1..days."""
    return df.select("*", F.posexplode(path).alias("_p", out)) \
        .withColumn("step", (F.col("_p") + 1).cast("int")).drop("_p", path)


def future_dates(fc: DataFrame, last_date: str = "last_date", step: str = "step",
                 out: str = "target_date") -> DataFrame:
    """last bar date + step calendar days (weekends included)."""
    return fc.withColumn(out, F.date_add(F.col(last_date), F.col(step)))


def ar1_forecast(scaled: DataFrame, coefs: DataFrame, days: int = 30, mode: str = "latest",
                 L: int = 60) -> DataFrame:
    """F5 + F6 + F9 for AR(1): ``(ticker, step, target_date, yhat)``.

    ``mode='latest'`` seeds with the last scaled close; ``'reference'`` with
    the last value of the last sample's window (one bar earlier), as
    ``X[-1]`` does in the reference.  Tickers with ``n <= L`` get no
    forecast; one without train samples (``n = L + 1``) gets persistence.
    """
    d = with_length(scaled)
    if "last_date" not in d.columns:
        d = d.join(scaled.groupBy("ticker").agg(F.max("bar_date").alias("last_date")), "ticker")
    shift = {"latest": 0, "reference": 1}[mode]
    seeds = (d.where((F.col("n") > L) & (F.col("pos") == F.col("n") - shift))
             .select("ticker", F.array(F.col("s")).alias("seed"), "lo", "hi", "last_date"))
    m = seeds.join(coefs.select("ticker", "a", "b"), "ticker", "left").select(
        "ticker", "seed", "lo", "hi", "last_date",
        F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(1.0)).alias("b"))
    rolled = rollout_linear(m, F.array(F.col("b")), F.col("a"), days)
    out = future_dates(explode_path(rolled))
    return out.select("ticker", "step", "target_date", inverse_scale_expr("yhat_s").alias("yhat"))


def last_close(bars: DataFrame) -> DataFrame:
    """The last close and date per ticker (``max_by``, no sort)."""
    return bars.groupBy("ticker").agg(F.max_by("close", "bar_date").alias("last_close"),
                                      F.max("bar_date").alias("last_date"))


def forecast_candles(fc: DataFrame, last: DataFrame, n: int, as_of) -> DataFrame:
    """synthetic candles for the first n forecast steps.

    open = previous close (the last real close for step 1), close = the
    prediction, high = max(open, close) * 1.01, low = min(open, close) *
    0.99, date = ``as_of + step`` (the reference uses today's UTC date).
    Zero rows unless ``0 < n <= number of predictions``.
    """
    from pyspark.sql import Window
    # one partition per ticker holds only its forecast steps (at most `days` rows);
    # the horizon check runs in the same window, so the forecast is read once
    w = Window.partitionBy("ticker").orderBy("step")
    whole = Window.partitionBy("ticker")
    x = (fc.join(last.select("ticker", "last_close"), "ticker")
         .withColumn("_h", F.max("step").over(whole))
         .withColumn("open", F.coalesce(F.lag("yhat").over(w), F.col("last_close")))
         .where((F.lit(n) > 0) & (F.col("_h") >= F.lit(n)) & (F.col("step") <= n))
         .withColumn("close", F.col("yhat")))
    return x.select("ticker", "step",
                    F.date_add(F.lit(as_of).cast("date"), F.col("step")).alias("target_date"),
                    "open",
                    (F.greatest("open", "close") * F.lit(1.01)).alias("high"),
                    (F.least("open", "close") * F.lit(0.99)).alias("low"),
                    "close")


# ---------------------------------------------------------------- Spark ML
def with_features(samples: DataFrame, x: str = "x", out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return samples.withColumn(out, array_to_vector(F.col(x)))


def fit_linear(train: DataFrame, epochs: int = 1, solver: str = "l-bfgs", reg: float = 0.0,
               tol: float = 1e-6):
    """M1/M3: pooled linear autoregression.

    ``epochs`` are the passes of the iterative solver; ``solver="normal"`` solves the
    normal equations in one pass, whatever the epochs.
    """
    from pyspark.ml.regression import LinearRegression
    lr = LinearRegression(featuresCol="features", labelCol="y", predictionCol="yhat_s",
                          maxIter=max(int(epochs), 1), solver=solver, regParam=reg, tol=tol,
                          standardization=False)
    return lr.fit(with_features(train))


def fit_gbt(train: DataFrame, epochs: int = 20, depth: int = 3, validation: str | None = None,
            tol: float = 0.01, seed: int = 7):
    """M1/M4: pooled gradient-boosted trees; with ``validation`` set, boosting
    stops when the validation loss stops improving (early stopping)."""
    from pyspark.ml.regression import GBTRegressor
    kw = dict(featuresCol="features", labelCol="y", predictionCol="yhat_s",
              maxIter=max(int(epochs), 1), maxDepth=depth, seed=seed)
    if validation:
        kw.update(validationIndicatorCol=validation, validationTol=tol)
    return GBTRegressor(**kw).fit(with_features(train))


def fit_gbt_patience(train: DataFrame, valid: DataFrame, epochs: int = 20, patience: int = 3, depth: int = 3,
                     seed: int = 7):
    """M4: boosting that ends when ``patience`` rounds in a row have not improved the
    validation loss, and keeps the best round's trees.

    Returns the model, the rounds grown and the best round (both from 1).
    """
    from candela.operators.trees import grow_until
    model, losses = grow_until(train, valid, epochs, patience, depth, seed=seed)
    return model, len(losses), len(model.trees)


def predict(model, samples: DataFrame) -> DataFrame:
    """M2: the model's prediction of the samples in ``yhat_s``."""
    if hasattr(model, "save_to"):
        return model.transform(samples)
    if not hasattr(model, "transform"):
        weights = F.array(*(F.lit(float(w)) for w in model.coefficients))
        dot = F.aggregate(F.zip_with("x", weights, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return samples.withColumn("yhat_s", F.lit(float(model.intercept)) + dot)
    return model.transform(with_features(samples)).drop("features")


def rollout_model(model, seeds: DataFrame, days: int = 30, L: int = 60) -> DataFrame:
    """F5 for a model of trees: predict, drop the oldest value, append, repeat.

    The trees are one column expression over the last L values, folded over the days on one row per
    ticker: no loop in the driver, no table between two days.  Adds ``path array<double>`` of ``days`` values.
    """
    from candela.operators.trees import model_column

    def step(acc, _day):
        return F.concat(acc, F.array(model_column(model, lambda i: F.element_at(acc, i - L))))

    start = F.slice(F.col("seed").cast("array<double>"), -L, L)
    path = F.aggregate(F.sequence(F.lit(1), F.lit(days)), start, step)
    return seeds.withColumn("path", F.slice(path, -days, days))
