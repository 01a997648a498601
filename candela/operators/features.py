"""Scaling, sliding samples, splits and seeds.

Per-ticker constants (scaler state, series length) are group-by results with
one row per ticker, joined back; the planner broadcasts them when AQE
measures them small and shuffles otherwise.  Order-dependent features run on
the halo chunks of :mod:`candela.operators.position`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.expr import nan_to_null
from candela.operators.aggregates import scaler_state
from candela.operators.position import (
    DEFAULT_CHUNK, chunk_window, owned, series_counts, with_halo, with_position,
)


def scale_expr(v, lo="lo", hi="hi"):
    """(v - lo) / range with a zero range treated as 1 (constant series → 0)."""
    rng = F.coalesce(F.nullif(F.col(hi) - F.col(lo), F.lit(0.0)), F.lit(1.0))
    return (F.col(v) - F.col(lo)) / rng


def inverse_scale_expr(s, lo="lo", hi="hi"):
    """scaled value back to price units."""
    s = F.col(s) if isinstance(s, str) else s
    rng = F.coalesce(F.nullif(F.col(hi) - F.col(lo), F.lit(0.0)), F.lit(1.0))
    return s * rng + F.col(lo)


def train_cut(n, frac: float):
    """``int(n * frac)`` — Python truncation of a non-negative double."""
    n = F.col(n) if isinstance(n, str) else n
    return F.floor(n.cast("double") * F.lit(float(frac))).cast("bigint")


def fit_scaler(bars: DataFrame, fit: str = "all", L: int = 60, frac: float = 0.8,
               value: str = "close") -> DataFrame:
    """Scaler state per ticker.  ``fit='all'`` is the reference (whole series,
    test data included); ``fit='train'`` uses only the bars of the train part."""
    if fit == "all":
        return scaler_state(bars, value)
    if fit != "train":
        raise ValueError("fit must be 'all' or 'train'")
    pos = bars if "pos" in bars.columns else with_position(bars)
    n = series_counts(bars)
    last_train = F.lit(L) + train_cut(F.greatest(F.col("n") - L, F.lit(0)), frac)
    return scaler_state(pos.join(n, "ticker").where(F.col("pos") <= last_train), value)


def series_stats(bars: DataFrame, value: str = "close") -> DataFrame:
    """Everything that is constant in a ticker's series, from one hash aggregate:
    rows, scaler state, last date and last value."""
    v = nan_to_null(value)
    return bars.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"),
        F.max("bar_date").alias("last_date"), F.max_by(value, "bar_date").alias("last_close"))


def scaled_series(bars: DataFrame, value: str = "close", out: str = "s") -> DataFrame:
    """Positions, the scaled value and the ticker's :func:`series_stats` on every bar.

    What follows (samples, splits, seeds, forecasts) reads these columns and
    aggregates or joins nothing per ticker again.
    """
    return with_position(bars).join(series_stats(bars, value), "ticker") \
        .withColumn(out, scale_expr(value))


def training_status(bars: DataFrame, L: int = 60, frac: float = 0.8, min_train: int = 1) -> DataFrame:
    """Samples and train samples of every ticker, and whether it can be trained.

    A ticker with fewer than ``min_train`` train samples is reported, not lost.
    """
    n = series_counts(bars).withColumn("n_samples", F.greatest(F.col("n") - L, F.lit(0)))
    n = n.withColumn("n_train", train_cut("n_samples", frac))
    return n.withColumn("status", F.when(F.col("n_train") >= min_train, "ok").otherwise("insufficient_history"))


def minmax_scale(bars: DataFrame, fit: str = "all", L: int = 60, frac: float = 0.8,
                 value: str = "close", out: str = "s") -> DataFrame:
    """add ``lo``, ``hi`` and the scaled value ``s`` in [0, 1]."""
    st = fit_scaler(bars, fit, L, frac, value)
    return bars.join(st, "ticker").withColumn(out, scale_expr(value))


def series_chunks(scaled: DataFrame, halo: int, value: str = "s", chunk: int = DEFAULT_CHUNK, extra: tuple = (),
                  label: str | None = None) -> DataFrame:
    """One row per chunk of a series: its values in order, with the last ``halo`` values of the chunk before.

    Output ``(ticker, first_pos, own_pos, values array<double>)`` — ``values`` begins at position ``first_pos`` and the chunk's own at
    ``own_pos`` — with the columns ``extra`` (constant in a ticker) and, if asked for, ``labels``, the column ``label`` of each value.
    A value travels once, and twice at a chunk's end; windows are cut out of the row.
    """
    d = scaled if "pos" in scaled.columns else with_position(scaled)
    h = with_halo(d.select("ticker", "pos", nan_to_null(value).alias("_v"), *([label] if label else []), *extra), halo=halo, chunk=max(chunk, halo))
    item = F.struct("pos", "_v", *([label] if label else []))
    rows = h.groupBy("ticker", "_chunk").agg(
        F.sort_array(F.collect_list(item)).alias("_c"), F.min(F.when(F.col("_own"), F.col("pos"))).alias("own_pos"),
        *(F.first(c).alias(c) for c in extra))
    rows = rows.where("own_pos is not null")         # a halo without a chunk after it
    return rows.select("ticker", F.col("_c")[0]["pos"].alias("first_pos"), "own_pos", F.col("_c")["_v"].alias("values"),
                       *([F.col("_c")[label].alias("labels")] if label else []), *extra)


def sequence_samples(scaled: DataFrame, L: int = 60, value: str = "s",
                     chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """x = the L previous values, y = the current one; max(0, n - L) per ticker.

    Output ``(ticker, bar_date, k, x array<double>, y)``, k = 1..n-L, and ``n``
    (the ticker's samples) where the input knows its series length.  A missing
    value keeps its place; a sample that contains one, or lacks ``y``, is left out.
    The series travels as chunks of values; a sample's x is a slice of its chunk, cut where it is used.
    """
    d = scaled if "pos" in scaled.columns else with_position(scaled)
    known = ("n",) if "n" in d.columns else ()
    c = series_chunks(d, L, value, chunk, known, label="bar_date")
    start = F.greatest(F.col("own_pos") - F.col("first_pos"), F.lit(L) - F.col("first_pos") + 1)      # place of the first target
    places = F.when(start < F.size("values"), F.sequence(start, F.size("values").cast("long") - 1))
    s = c.withColumn("_at", F.explode(places.cast("array<int>")))
    s = s.select("ticker", F.col("labels")[F.col("_at")].alias("bar_date"), (F.col("first_pos") + F.col("_at") - L).alias("k"),
                 F.slice("values", F.col("_at") - L + 1, F.lit(L)).alias("x"), F.col("values")[F.col("_at")].alias("y"),
                 *(F.greatest(F.col(x) - L, F.lit(0)).alias(x) for x in known))
    return s.where(F.col("y").isNotNull() & ~F.exists("x", lambda e: e.isNull()))


def sequence_samples_plain(scaled: DataFrame, L: int = 60, value: str = "s") -> DataFrame:
    """F3 with one plain window per ticker (reference for the halo equality test)."""
    w = Window.partitionBy("ticker").orderBy("bar_date")
    d = scaled.withColumn("pos", F.row_number().over(w))
    return (d.withColumn("x", F.collect_list(value).over(w.rowsBetween(-L, -1)))
            .where(F.col("pos") > L)
            .select("ticker", "bar_date", (F.col("pos") - L).cast("bigint").alias("k"), "x",
                    F.col(value).alias("y")))


def _with_counts(samples: DataFrame, counts: DataFrame | None) -> DataFrame:
    """``n``, the ticker's samples: carried by the samples, given, or counted."""
    if counts is None and "n" in samples.columns:
        return samples
    counts = counts if counts is not None else series_counts(samples.select("ticker"), name="n")
    return samples.drop("n").join(counts.select("ticker", "n"), "ticker")


def chrono_split(samples: DataFrame, frac: float = 0.8, k: str = "k",
                 counts: DataFrame | None = None) -> DataFrame:
    """first ``int(n * frac)`` samples of each ticker are train, the rest test."""
    return (_with_counts(samples, counts)
            .withColumn("split", F.when(F.col(k) <= train_cut("n", frac), "train").otherwise("test"))
            .drop("n"))


def three_way_split(samples: DataFrame, train: float = 0.7, valid: float = 0.15, k: str = "k",
                    counts: DataFrame | None = None) -> DataFrame:
    """train / validation / test cut by two chronological fractions."""
    upper = float(train + valid)
    return (_with_counts(samples, counts)
            .withColumn("split", F.when(F.col(k) <= train_cut("n", train), "train")
                        .when(F.col(k) <= train_cut("n", upper), "valid").otherwise("test"))
            .drop("n"))


def last_n_bars(bars: DataFrame, n: int) -> DataFrame:
    """F8: the last n bars of each ticker (tail alignment), without a per-ticker sort."""
    d = bars if "pos" in bars.columns else with_position(bars)
    cnt = series_counts(bars, name="_n")
    return d.join(cnt, "ticker").where(F.col("pos") > F.col("_n") - n).drop("_n")


def seed_window(scaled: DataFrame, L: int = 60, mode: str = "latest", value: str = "s") -> DataFrame:
    """the L-value window a recursive forecast starts from.

    ``latest``: the last L values (ends at the last close).  ``reference``:
    the window of the last sample, ``X[-1]``, which ends one bar earlier.
    Only L rows per ticker are gathered, so the group is bounded by L.
    """
    d = scaled if "pos" in scaled.columns else with_position(scaled)
    if "n" not in d.columns:
        d = d.join(series_counts(scaled, name="n"), "ticker")
    shift = 0 if mode == "latest" else 1 if mode == "reference" else None
    if shift is None:
        raise ValueError("mode must be 'latest' or 'reference'")
    hi = F.col("n") - shift
    sel = d.where((F.col("n") > L) & (F.col("pos") > hi - L) & (F.col("pos") <= hi))
    return (sel.groupBy("ticker")
            .agg(F.sort_array(F.collect_list(F.struct("pos", value))).alias("_w"),
                 F.max("bar_date").alias("seed_end"))
            .select("ticker", F.transform("_w", lambda e: e[value]).alias("seed"), "seed_end"))


def lagged(df: DataFrame, value: str, lags: int = 1, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Previous ``lags`` values as columns ``{value}_lag1..`` using halo chunks."""
    d = df if "pos" in df.columns else with_position(df)
    h = with_halo(d, halo=lags, chunk=max(chunk, lags))
    w = chunk_window()
    for i in range(1, lags + 1):
        h = h.withColumn(f"{value}_lag{i}", F.lag(value, i).over(w))
    return owned(h)
