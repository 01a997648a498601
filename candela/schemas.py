"""Schemas of the engine's tables and the schema-on-read check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# one quote record as the daemon writes it: five flat fields
QUOTE = T.StructType([
    T.StructField("ticker", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("fetched_at", T.StringType()),
])

# The vendor's bar field names.
OHLC_FIELDS = ["Open", "High", "Low", "Close"]
VOLUME_FIELD = "Volume"


def require_columns(df: DataFrame, required) -> DataFrame:
    """Raise ``ValueError`` naming every required column that is missing."""
    have = set(df.columns)
    missing = [c for c in required if c not in have]
    if missing:
        raise ValueError(f"Missing columns: {missing}; columns={list(df.columns)}")
    return df
