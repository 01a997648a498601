"""Tick tables derived from the driver tables.

A tick is ``(ticker, ts, price, qty, tick_id)``.  ``tick_id`` orders ticks
that share a timestamp; together with ``ts`` it makes open/close exact.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.expr import valid_price
from candela.sources.tables import read_table


_D38 = "decimal(38,0)"


def seq_key(ts: str = "ts", tick_id: str = "tick_id") -> Column:
    """One ``decimal(38,0)`` that orders like ``(ts, tick_id)``.

    ``(epoch µs + 10^16) * 10^20 + tick_id`` for timestamps after 1653 and
    ids in ``[0, 10^20)``; a tick without an id comes first of its time, as a
    NULL does in the struct order.  A decimal aggregation buffer is fixed-width, so
    ``min_by``/``max_by`` over it stay in a hash aggregate; a struct ordering
    would force a sort-based aggregate over every tick.
    """
    us = F.unix_micros(F.col(ts).cast("timestamp")).cast(_D38)
    return ((us + F.lit(Decimal(10 ** 16)).cast(_D38)) * F.lit(Decimal(10 ** 20)).cast(_D38)
            + F.coalesce(F.col(tick_id).cast(_D38), F.lit(Decimal(-1)).cast(_D38))).cast(_D38)


def packed_key(parts: list[tuple[str, int]]) -> Column:
    """One ``decimal(38,0)`` that orders like the tuple of whole numbers ``parts`` (name, digits; NULL first).

    A number that does not fit its digits is an error, not another order.
    """
    key, fits = F.lit(Decimal(0)).cast(_D38), F.lit(True)
    for name, digits in parts:
        value = F.coalesce(F.col(name).cast("long") + 1, F.lit(0))
        fits = fits & ((F.col(name).isNull()) | ((F.col(name) >= 0) & (value < 10 ** digits)))
        key = (key * F.lit(Decimal(10 ** digits)).cast(_D38) + value.cast(_D38)).cast(_D38)
    return F.when(fits, key).otherwise(F.raise_error(F.lit(f"a key of {', '.join(n for n, _ in parts)} is out of its range")).cast(_D38))


def with_seq(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("seq", seq_key())


def order_ticks(orders: DataFrame) -> DataFrame:
    """orders → daily ticks: ticker = order priority, price = total price."""
    return (orders
            .select(F.col("o_orderpriority").alias("ticker"),
                    F.col("o_orderdate").alias("ts"),
                    F.col("o_totalprice").cast("double").alias("price"),
                    F.lit(1.0).alias("qty"),
                    F.col("o_orderkey").alias("tick_id"))
            .where(F.col("ticker").isNotNull() & valid_price("price"))
            .transform(with_seq))


def lineitem_ticks(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """lineitem ⨝ part → trades: ticker = brand, price = unit price, qty = quantity.

    ``(l_orderkey, l_linenumber)`` is not unique, so the tie-break id is the
    struct of the four line keys.  A ship date is a day (its time of day, if any, is cut off), so the
    four keys alone order the ticks of a day: ``day_seq`` packs them into one 38-digit key, and daily bars stay in
    a hash aggregate.  The join is left to the planner: AQE turns
    it into a broadcast only when the measured part side is small.
    """
    keys = [("l_orderkey", 13), ("l_linenumber", 3), ("l_partkey", 12), ("l_suppkey", 10)]
    kind = lineitem.schema["l_shipdate"].dataType
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         "l_quantity", "l_extendedprice", "l_shipdate")
    p = part.select("p_partkey", "p_brand")
    return (li.join(p, li.l_partkey == p.p_partkey)
            .select(F.col("p_brand").alias("ticker"),
                    F.date_trunc("day", F.col("l_shipdate")).cast(kind).alias("ts"),
                    F.try_divide("l_extendedprice", "l_quantity").alias("price"),
                    F.col("l_quantity").alias("qty"),
                    F.struct(*(k for k, _ in keys)).alias("tick_id"), packed_key(keys).alias("day_seq"))
            .where(F.col("ticker").isNotNull() & valid_price("price")))


def event_ticks(events: DataFrame, ticker_col: str = "event_type") -> DataFrame:
    """events → intraday quotes: ticker = event type, price = value."""
    return (events
            .select(F.col(ticker_col).cast("string").alias("ticker"),
                    F.col("ts"),
                    F.col("value").cast("double").alias("price"),
                    F.lit(1.0).alias("qty"),
                    F.col("event_id").alias("tick_id"))
            .where(F.col("ticker").isNotNull() & valid_price("price"))
            .transform(with_seq))


def load_order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_ticks(read_table(spark, sf_dir, "orders",
                                  ["o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice"]))


def load_lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem_ticks(read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "part"))


def load_event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_ticks(read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"]))
