"""Derived tables every registered query starts from.

Each loader is lazy: it returns a plan over the driver's Parquet files, so a
query that needs two columns reads two columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from candela.sources.bars import build_bars
from candela.sources.ticks import load_event_ticks, load_lineitem_ticks, load_order_ticks


def order_bars(spark: SparkSession, sf_dir: str, materialized: bool = False) -> DataFrame:
    """Daily bars of the five order-priority tickers.

    ``materialized=True`` computes them once into a Parquet table; queries
    with several branches over the bars use that form.
    """
    bars = build_bars(load_order_ticks(spark, sf_dir), "day", last_ts=materialized)
    if materialized:
        from candela.plans.materialize import materialize
        return materialize(bars, "order-bars")
    return bars


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the 25 part brands (trades with volume)."""
    return build_bars(load_lineitem_ticks(spark, sf_dir), "day")


def event_bars(spark: SparkSession, sf_dir: str, period: str = "hour",
               materialized: bool = False) -> DataFrame:
    """Bars of the event-type quote stream (with ``last_ts`` when materialised)."""
    bars = build_bars(load_event_ticks(spark, sf_dir), period, last_ts=materialized)
    if materialized:
        from candela.plans.materialize import materialize
        return materialize(bars, f"event-bars-{period}")
    return bars
