"""A1–A5: per-ticker aggregates.

All are single group-bys on ``ticker`` with built-in aggregate functions, so
Spark plans partial aggregate → hash exchange → final aggregate; a hot
ticker is pre-aggregated in every map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.expr import nan_to_null

# The view's column names are part of the interface; {view} is the view to read.
AVG_CLOSE_SQL = "SELECT s.Ticker, mean(s.Close) AS avg_close FROM {view} AS s GROUP BY s.Ticker"


def mean_close(stocks: DataFrame) -> DataFrame:
    """A1: the Dask form — NaN skipped, NULL ticker dropped."""
    return (stocks.where(F.col("Ticker").isNotNull())
            .groupBy("Ticker").agg(F.avg(nan_to_null("Close")).alias("mean_close")))


def avg_close_sql(spark: SparkSession, stocks: DataFrame, view: str = "stocks") -> DataFrame:
    """A2: register the view and average the closes of each ticker in SQL."""
    stocks.createOrReplaceTempView(view)
    return spark.sql(AVG_CLOSE_SQL.format(view=view))


def candle_summary(ohlc: DataFrame) -> DataFrame:
    """A3: rows, lowest low and highest high of each ticker's candles; NaN counts as missing."""
    return ohlc.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(nan_to_null("low")).alias("low_min"),
        F.max(nan_to_null("high")).alias("high_max"))


def scaler_state(bars: DataFrame, value: str = "close") -> DataFrame:
    """A4: min and max of the series — the state of a [0, 1] min-max scaler; NaN counts as missing."""
    v = nan_to_null(value)
    return bars.groupBy("ticker").agg(F.min(v).alias("lo"), F.max(v).alias("hi"))


def rmse(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
         by=("ticker",)) -> DataFrame:
    """A5: root mean squared error per group."""
    err = F.col(actual) - F.col(predicted)
    return pred.groupBy(*by).agg(F.sqrt(F.avg(err * err)).alias("rmse"),
                                 F.count(F.lit(1)).alias("n"))
