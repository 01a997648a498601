"""V1–V4: the data behind each chart, as long tables (drawing is not built).

A feed row is ``(ticker, trace, x, open, high, low, close, y)``; line traces
fill ``y``, candle traces fill the four prices, the volume trace puts volume
in ``y``.  Traces are projections of existing tables combined with
``unionByName`` — no trace requires a shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.sources.scans import requested, union_frames

FEED_COLS = ["ticker", "trace", "x", "open", "high", "low", "close", "y"]


def _null():
    return F.lit(None).cast("double")


def _trace(df: DataFrame, name: str, x, y=None, ohlc=None) -> DataFrame:
    o = ohlc or (None, None, None, None)
    cols = [F.col("ticker"), F.lit(name).alias("trace"), x.cast("timestamp_ntz").alias("x")]
    for nm, c in zip(("open", "high", "low", "close"), o):
        cols.append((F.col(c) if c else _null()).alias(nm))
    cols.append((y.cast("double") if y is not None else _null()).alias("y"))
    return df.select(*cols)


def history_trace(bars: DataFrame) -> DataFrame:
    return _trace(bars, "history", F.col("bar_date"), y=F.col("close"))


def predicted_trace(fc: DataFrame) -> DataFrame:
    return _trace(fc, "predicted", F.col("target_date"), y=F.col("yhat"))


def realtime_trace(latest: DataFrame) -> DataFrame:
    return _trace(latest.where(F.col("price").isNotNull() & F.col("ts").isNotNull()),
                  "realtime", F.col("ts"), y=F.col("price"))


def ohlc_trace(bars: DataFrame, name: str = "ohlc", date: str = "bar_date") -> DataFrame:
    return _trace(bars, name, F.col(date), ohlc=("open", "high", "low", "close"))


def volume_trace(bars: DataFrame) -> DataFrame:
    return _trace(bars, "volume", F.col("bar_date"), y=F.col("volume"))


def line_feed(bars: DataFrame, forecast: DataFrame | None = None,
              latest: DataFrame | None = None) -> DataFrame:
    """V1: historical line, predicted line, real-time point."""
    parts = [history_trace(bars)]
    if forecast is not None:
        parts.append(predicted_trace(forecast))
    if latest is not None:
        parts.append(realtime_trace(latest))
    return union_frames(parts)


def candle_feed(bars: DataFrame, forecast: DataFrame | None = None,
                latest: DataFrame | None = None, candles: DataFrame | None = None,
                include_volume: bool = False, hide_realtime: bool = False) -> DataFrame:
    """V2: candles, volume (if asked and present), forecast candles, predicted
    line and the real-time point unless hidden."""
    parts = [ohlc_trace(bars)]
    if include_volume and "volume" in bars.columns:
        parts.append(volume_trace(bars))
    if candles is not None:
        parts.append(ohlc_trace(candles, "forecast_ohlc", "target_date"))
    if forecast is not None:
        parts.append(predicted_trace(forecast))
    if latest is not None and not hide_realtime:
        parts.append(realtime_trace(latest))
    return union_frames(parts)


def grid_layout(valid: DataFrame) -> DataFrame:
    """V3 layout from the valid tickers ``(pos, ticker)`` in request order.

    2 columns (1 when a single ticker is valid), ``rows = ceil(n / cols)``;
    panel i (0-based) sits at row ``i // cols + 1``, column ``i % cols + 1``.
    The input is the request list, so its size is bounded by the request.
    """
    from pyspark.sql import Window
    w = Window.orderBy("pos")
    v = valid.withColumn("panel", (F.row_number().over(w) - 1).cast("int")) \
        .withColumn("n_valid", F.count(F.lit(1)).over(Window.partitionBy()))
    cols = F.when(F.col("n_valid") > 1, F.lit(2)).otherwise(F.lit(1))
    return v.select("ticker", "panel",
                    (F.floor(F.col("panel") / cols) + 1).cast("int").alias("grid_row"),
                    (F.col("panel") % cols + 1).cast("int").alias("grid_col"),
                    F.ceil(F.col("n_valid") / cols).cast("int").alias("grid_rows"),
                    cols.cast("int").alias("grid_cols"))


def grid_feed(bars: DataFrame, tickers, latest: DataFrame | None = None,
              include_volume: bool = False, hide_realtime: bool = False) -> DataFrame:
    """V3: per valid ticker a panel with candles, volume and the real-time point."""
    from candela.sources.scans import ticker_filter
    sel = ticker_filter(bars, tickers)
    valid = requested(bars.sparkSession, tickers).join(sel.select("ticker").distinct(), "ticker", "left_semi")
    layout = grid_layout(valid)
    # only the requested tickers' quotes are computed: the filter reaches the latest-quote scan
    if latest is not None:
        latest = ticker_filter(latest, tickers).join(valid, "ticker", "left_semi")
    feed = candle_feed(sel, latest=latest,
                       include_volume=include_volume, hide_realtime=hide_realtime)
    return feed.join(layout, "ticker")
