"""Bars from ticks.

open = first price, high = max, low = min, close = last price, volume = sum
of quantities, per ticker and period.  ``min_by``/``max_by`` over
``struct(ts, tick_id)`` are declarative aggregates, so Spark runs them as a
partial (map-side) aggregate before the shuffle on ``(ticker, period)``: a
ticker holding a third of all ticks is still spread over all its periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PERIODS = ("day", "hour", "minute", "week", "month")


def period_column(period: str, ts: str = "ts"):
    if period == "day":
        return F.to_date(ts).alias("bar_date"), "bar_date"
    if period in ("hour", "minute", "week", "month"):
        # date_trunc returns a zone-aware timestamp; cast back so the bar key
        # stays the wall-clock value whatever the session time zone
        return F.date_trunc(period, F.col(ts)).cast("timestamp_ntz").alias("bar_ts"), "bar_ts"
    raise ValueError(f"unknown period {period!r}; expected one of {PERIODS}")


def tick_order(ticks: DataFrame):
    """The ordering of ticks: the packed ``seq`` key when present (hash
    aggregate), else ``struct(ts, tick_id)`` (sort aggregate)."""
    return F.col("seq") if "seq" in ticks.columns else F.struct("ts", "tick_id")


def volume_sum():
    """Traded quantity of a bar: a whole number, rounded once after the sum."""
    return F.round(F.sum("qty")).cast("bigint")


def build_bars(ticks: DataFrame, period: str = "day", last_ts: bool = False) -> DataFrame:
    """OHLCV per ticker and period; ``last_ts=True`` adds the time of the
    period's last tick, so the latest quote can later be read off the bars
    (:func:`candela.sources.quotes.latest_from_bars`) without a second pass
    over the ticks."""
    pcol, pname = period_column(period)
    # ticks that know their order within a day need no time in the key of daily bars
    order = F.col("day_seq") if period == "day" and "day_seq" in ticks.columns else tick_order(ticks)
    return (ticks
            .select("ticker", pcol, "price", "qty", "ts", order.alias("_o"))
            .groupBy("ticker", pname)
            .agg(F.min_by("price", "_o").alias("open"),
                 F.max("price").alias("high"),
                 F.min("price").alias("low"),
                 F.max_by("price", "_o").alias("close"),
                 volume_sum().alias("volume"),
                 F.count(F.lit(1)).alias("n_ticks"),
                 *([F.max("ts").alias("last_ts")] if last_ts else [])))
