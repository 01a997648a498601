"""RSI and MACD.

Definitions used here:

* RSI(p) with simple means: delta = close - previous close; RSI = 100 -
  100 / (1 + mean(gain) / mean(loss)) over the last p deltas, 100 when the
  mean loss is 0; defined from the (p+1)-th bar.
* MACD(12, 26, 9): exponential means with alpha = 2 / (span + 1), seeded
  with the first value (``ema_1 = x_1``, pandas ``adjust=False``); macd =
  ema12 - ema26, signal = ema9 of macd, hist = macd - signal.

RSI has a finite memory and runs on halo chunks.  An exponential mean has an
infinite one, so it is carried.  A chunk is one row with its values in order,
and its part of the mean, folded from zero, goes into the small table
``(ticker, chunk)``; there the recursion ``E_c = L_c + r^m E_(c-1)`` tells
what each chunk inherits, and the plain recursion runs inside the chunk from
there.  That is exact for any span.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.operators.position import chunk_window, owned, with_halo, with_position


def rsi(bars: DataFrame, period: int = 14, value: str = "close", chunk: int = 4096) -> DataFrame:
    d = bars if "pos" in bars.columns else with_position(bars)
    h = with_halo(d.select("ticker", "bar_date", "pos", value), halo=period, chunk=max(chunk, period))
    w = chunk_window()
    delta = F.col(value) - F.lag(value, 1).over(w)
    h = h.withColumn("_d", delta)
    fr = w.rowsBetween(-(period - 1), 0)
    h = (h.withColumn("_g", F.avg(F.greatest(F.col("_d"), F.lit(0.0))).over(fr))
         .withColumn("_l", F.avg(F.greatest(-F.col("_d"), F.lit(0.0))).over(fr)))
    val = F.when(F.col("_l") == 0, F.lit(100.0)) \
        .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + F.col("_g") / F.col("_l")))
    return (owned(h).where(F.col("pos") > period)
            .select("ticker", "bar_date", value, val.alias("rsi")))


def _ema(df: DataFrame, means: dict, chunk: int) -> DataFrame:
    """Adds exponential means: ``means`` is ``{name: (value, alpha)}``.

    ``df`` has ``ticker`` and ``pos`` (1, 2, ... in each ticker).  A group holds ``chunk`` rows.
    """
    rest = [c for c in df.columns if c not in ("ticker", "pos")]
    d = df.withColumn("_chunk", F.floor((F.col("pos") - 1) / chunk)).groupBy("ticker", "_chunk").agg(
        F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("_rows"))

    def follow(value: str, alpha: float, mean, row):
        return F.when(row["pos"] == 1, row[value]).otherwise(F.lit(alpha) * row[value] + F.lit(1 - alpha) * mean)

    for name, (value, alpha) in means.items():
        own = F.aggregate("_rows", F.lit(0.0), lambda e, r: follow(value, alpha, e, r))
        d = d.withColumn(f"_own_{name}", own)
    for name, (_, alpha) in means.items():
        d = d.withColumn(f"_old_{name}", _inherited(f"_own_{name}", alpha, chunk))
    for name, (value, alpha) in means.items():
        start = F.struct(F.col(f"_old_{name}").alias("e"), F.array().cast("array<double>").alias("all"))
        d = d.withColumn(f"_all_{name}", F.aggregate("_rows", start, lambda s, r: F.struct(
            follow(value, alpha, s["e"], r).alias("e"),
            F.concat(s["all"], F.array(follow(value, alpha, s["e"], r))).alias("all")), lambda s: s["all"]))
    out = d.select("ticker", F.explode(F.arrays_zip("_rows", *(f"_all_{n}" for n in means))).alias("_z"))
    return out.select("ticker", "_z._rows.*", *(F.col(f"_z._all_{n}").alias(n) for n in means))


def _inherited(own: str, alpha: float, chunk: int):
    """The mean at the end of the chunk before, folded from the chunks' own parts.

    Parts from so far back that their weight underflows add nothing in double precision.
    """
    weight = (1.0 - alpha) ** chunk
    back = 1 if weight == 0.0 else math.ceil(745 / -math.log(weight))
    before = Window.partitionBy("ticker").orderBy("_chunk").rowsBetween(-back, -1)
    return F.aggregate(F.collect_list(own).over(before), F.lit(0.0), lambda e, x: e * F.lit(weight) + x)


def macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9,
         value: str = "close", chunk: int = 128) -> DataFrame:
    a_f, a_s, a_g = 2.0 / (fast + 1), 2.0 / (slow + 1), 2.0 / (signal + 1)
    d = bars if "pos" in bars.columns else with_position(bars)
    d = _ema(d.select("ticker", "bar_date", "pos", value), {"_fast": (value, a_f), "_slow": (value, a_s)}, chunk)
    d = d.select("ticker", "bar_date", "pos", value, (F.col("_fast") - F.col("_slow")).alias("macd"))
    d = _ema(d, {"signal": ("macd", a_g)}, chunk)
    return d.select("ticker", "bar_date", value, "macd", "signal", (F.col("macd") - F.col("signal")).alias("hist"))
