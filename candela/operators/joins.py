"""Attach the latest quote to each ticker's bars.

The quote table has one row per ticker.  The join is left to the planner;
AQE broadcasts it when its measured size is under the broadcast threshold
and keeps a shuffle join otherwise (many tickers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bars_with_latest_quote(bars: DataFrame, latest: DataFrame) -> DataFrame:
    q = latest.select("ticker", F.col("price").alias("rt_price"), F.col("ts").alias("rt_ts"))
    return bars.join(q, "ticker", "left")
