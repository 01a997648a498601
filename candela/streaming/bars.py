"""T4: streaming bars (streaming form of S9), in two forms.

:func:`run_bars` amends: a batch's ticks become partial bars (first and last
key with their prices, high, low, sums), which merge with those of any other
batch.  Every window can be read at any time and a late tick amends its bar,
however late; the stream holds no state.

:func:`stream_bars` closes: a window is emitted once, in append mode, when the
watermark (max event time seen − delay) passes its end, and ticks older than
the watermark are dropped.  The aggregate is the same ``min_by`` / ``max_by``
set as the batch bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.sinks.merged import MergedTable
from candela.sinks.writers import _fs
from candela.sources.bars import period_column, tick_order, volume_sum
from candela.sources.ticks import event_ticks

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, name: str = "events.parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table of a folder as a stream (explicit schema).

    The table is a folder of part files or a single file; a file source reads
    folders, so a single file is picked out of its folder by name.
    """
    r = spark.readStream.schema(EVENTS_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    path = f"{folder.rstrip('/')}/{name}"
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isDirectory():
        return r.parquet(path)
    return r.option("pathGlobFilter", name).parquet(folder)


def stream_bars(ticks: DataFrame, period: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Windowed OHLCV per ticker.  Watermarks need TIMESTAMP (not NTZ): the
    session zone is UTC, so the cast keeps the wall-clock value."""
    t = ticks.withColumn("ts", F.col("ts").cast("timestamp"))
    order = tick_order(t)
    return (t.withWatermark("ts", delay)
            .groupBy(F.window("ts", period).alias("w"), "ticker")
            .agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"),
                 F.min("price").alias("low"), F.max_by("price", order).alias("close"),
                 volume_sum().alias("volume"), F.count(F.lit(1)).alias("n_ticks"))
            .select("ticker", F.col("w.start").cast("timestamp_ntz").alias("bar_ts"),
                    "open", "high", "low", "close", "volume", "n_ticks"))


def event_bar_stream(spark: SparkSession, folder: str, period: str = "1 hour",
                     delay: str = "1 hour") -> DataFrame:
    return stream_bars(event_ticks(event_stream(spark, folder)), period, delay)


#: A partial bar: prices with the packed keys of their ticks, and sums.
PARTIAL_BAR = T.StructType([
    T.StructField("ticker", T.StringType()), T.StructField("bar_ts", T.TimestampNTZType()),
    T.StructField("first_key", T.DecimalType(38, 0)), T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
    T.StructField("last_key", T.DecimalType(38, 0)), T.StructField("close", T.DoubleType()),
    T.StructField("qty", T.DoubleType()), T.StructField("n_ticks", T.LongType())])


def partial_bars(ticks: DataFrame, period: str = "hour") -> DataFrame:
    """Each tick (with its packed key ``seq``) as a bar of its own."""
    if period == "day":
        raise ValueError("streamed bars start at a timestamp: hour, minute, week or month")
    pcol, _ = period_column(period)
    price = F.col("price")
    return ticks.select("ticker", pcol.alias("bar_ts"), F.col("seq").alias("first_key"), price.alias("open"), price.alias("high"),
                        price.alias("low"), F.col("seq").alias("last_key"), price.alias("close"), F.col("qty").cast("double").alias("qty"),
                        F.lit(1).cast("long").alias("n_ticks"))


def merge_bars(bars: DataFrame) -> DataFrame:
    """One partial bar for each ticker and start, out of several: all buffers are of fixed width, so a hash aggregate."""
    return bars.groupBy("ticker", "bar_ts").agg(
        F.min("first_key").alias("first_key"), F.min_by("open", "first_key").alias("open"), F.max("high").alias("high"),
        F.min("low").alias("low"), F.max("last_key").alias("last_key"), F.max_by("close", "last_key").alias("close"),
        F.sum("qty").alias("qty"), F.sum("n_ticks").alias("n_ticks"))


def bars_table(spark: SparkSession, path: str) -> MergedTable:
    return MergedTable(spark, path, PARTIAL_BAR, ["ticker", "bar_ts"], merge_bars)


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    """The bars as they stand now, of all ticks so far."""
    return bars_table(spark, path).read().select(
        "ticker", "bar_ts", "open", "high", "low", "close", F.round("qty").cast("bigint").alias("volume"), "n_ticks")


def run_bars(ticks: DataFrame, path: str, checkpoint: str, period: str = "hour", available_now: bool = True,
             interval_s: int = 60) -> None:
    """Drains (or follows) a stream of ticks into a table of mergeable bars."""
    table = bars_table(ticks.sparkSession, path)
    w = partial_bars(ticks, period).writeStream.foreachBatch(table.amend).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=f"{int(interval_s)} seconds")
    w.start().awaitTermination()
