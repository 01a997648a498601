"""Quotes, the quote log and its reduction.

A quote record has five flat fields ``(ticker, price,
timestamp, source, fetched_at)``: ``timestamp`` is the exchange time as
Python ``isoformat()`` text, ``fetched_at`` the poll instant in UTC with six
fraction digits and a ``Z``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.functions.expr import iso_utc, py_isoformat, valid_price
from candela.schemas import QUOTE

_D38 = "decimal(38,0)"


def latest_quote(ticks: DataFrame) -> DataFrame:
    """Last tick per ticker by ``(ts, tick_id)`` — ``max_by``, no sort.

    Output ``(ticker, price, ts, timestamp)``; a ticker without ticks has no row.
    """
    from candela.sources.bars import tick_order
    order = tick_order(ticks)
    last = (ticks.where(valid_price("price"))
            .groupBy("ticker")
            .agg(F.max_by("price", order).alias("price"), F.max("ts").alias("ts")))
    return last.select("ticker", "price", "ts", py_isoformat(F.col("ts")).alias("timestamp"))


def latest_from_bars(bars: DataFrame, date: str = "bar_date") -> DataFrame:
    """S5 from bars that carry ``last_ts``: the close of each ticker's last
    bar is the price of its latest tick.  A hash aggregate over the bars."""
    last = bars.groupBy("ticker").agg(F.max_by("close", date).alias("price"),
                                      F.max("last_ts").alias("ts"))
    return last.select("ticker", "price", "ts", py_isoformat(F.col("ts")).alias("timestamp"))


def quote_records(df: DataFrame, source: str, fetched_at="ts", price="price", ts="ts") -> DataFrame:
    """Format rows as daemon records (``to_json`` of this gives one log line)."""
    fa = F.col(fetched_at) if isinstance(fetched_at, str) else fetched_at
    return df.select("ticker", F.col(price).cast("double").alias("price"),
                     py_isoformat(F.col(ts)).alias("timestamp"), F.lit(source).alias("source"),
                     iso_utc(fa).alias("fetched_at"))


def valid_quotes(df: DataFrame, price: str = "price") -> DataFrame:
    """A missing quote (NULL or NaN price) produces no record."""
    return df.where(valid_price(price))


def read_quote_log(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON quote log, read with the fixed schema (no inference)."""
    return spark.read.schema(QUOTE).json(path)


def quote_instant(ts_text="timestamp"):
    """Exchange timestamp text → instant (offsets honoured, session zone
    otherwise); NULL for text that is no timestamp."""
    return F.try_to_timestamp(F.col(ts_text))


def well_formed(df: DataFrame) -> DataFrame:
    """Records whose exchange timestamp can be read."""
    return df.where(quote_instant().isNotNull())


def malformed(df: DataFrame) -> DataFrame:
    """The other records, to be kept apart and counted."""
    return df.where(quote_instant().isNull())


def fetched_ntz(col: str = "fetched_at"):
    """``...Z`` poll text → timestamp_ntz (UTC wall clock), exact to the microsecond."""
    return F.to_timestamp_ntz(F.regexp_replace(F.col(col), "Z$", ""))


def dedup_quotes(log: DataFrame) -> DataFrame:
    """T5 (batch): one record per ``(ticker, timestamp)``, the earliest poll.

    First a hash aggregate with map-side combine folds the polls of one quote
    (all fields but the poll time); ``min_by`` then picks the earliest on that
    reduced table.  Of polls at the same instant the smaller price, then source wins.
    """
    polls = log.groupBy("ticker", "timestamp", "source", "price").agg(F.min(fetched_ntz()).alias("fa"))
    first = polls.groupBy("ticker", "timestamp").agg(F.min(F.struct("fa", "price", "source")).alias("r"))
    return first.select("ticker", "r.price", "timestamp", "r.source", iso_utc("r.fa").alias("fetched_at"))


def snapshot_latest(records: DataFrame) -> DataFrame:
    """K1 content: latest record per ticker by exchange time, then poll time (then price and source, so that
    any order of merging gives the same).

    Both instants go into one fixed-width key, so the pass over all records is a hash aggregate; the other
    fields are only compared among the records that carry their ticker's key.
    """
    polled = F.coalesce(F.unix_micros(F.try_to_timestamp("fetched_at")), F.lit(-1)).cast(_D38)
    traded = F.coalesce(F.unix_micros(quote_instant()), F.lit(-1)).cast(_D38)
    keyed = records.withColumn("_key", (traded * F.lit(Decimal(10 ** 18)).cast(_D38) + polled).cast(_D38))
    last = keyed.groupBy(F.col("ticker").alias("_t")).agg(F.max("_key").alias("_last"))
    top = keyed.join(last, F.col("ticker").eqNullSafe(F.col("_t")) & (F.col("_key") == F.col("_last"))) \
        .select(*records.columns).distinct()
    fields = [c for c in records.columns if c != "ticker"]
    order = [c for c in ("fetched_at", "price", "source", "timestamp") if c in fields]
    nr = F.row_number().over(Window.partitionBy("ticker").orderBy(*(F.col(c).desc() for c in order)))
    return top.withColumn("_nr", nr).where("_nr = 1").select(*records.columns)


def event_quote_log(events: DataFrame, source: str = "events") -> DataFrame:
    """Quote records of the events table: each valid event is one logged poll.

    The exchange stamps its quotes by the hour, so the polls of one ticker
    within an hour repeat a timestamp; ``fetched_at`` is the event's own time.
    """
    polled = events.select(F.col("event_type").cast("string").alias("ticker"),
                           F.col("value").cast("double").alias("price"),
                           F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz").alias("stamp"), "ts")
    return quote_records(valid_quotes(polled).where(F.col("ticker").isNotNull()), source,
                         fetched_at="ts", ts="stamp")
