"""Row positions and halo chunks for long per-key series.

A window ``PARTITION BY ticker`` puts a whole ticker in one task; with one
ticker holding a third of the data that task is the job.  Instead:

* :func:`with_position` numbers rows 1..n inside each key from per
  ``(key, bucket)`` counts: the counts table (keys × buckets) is cumulated
  by a window over that small table and joined back, and ``row_number`` runs
  only inside ``(key, bucket)``.
* :func:`with_halo` cuts each series into chunks of ``chunk`` positions and
  copies the last ``halo`` rows of every chunk into the next one
  (``_own = false``).  A window whose frame reaches at most ``halo`` rows back
  then runs ``PARTITION BY key, _chunk`` and is exact on the own rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_CHUNK = 4096


def with_position(df: DataFrame, key: str = "ticker", order: str = "bar_date",
                  bucket: str = "month", pos: str = "pos", tiebreak=()) -> DataFrame:
    """Add ``pos`` = 1-based rank of ``order`` within ``key`` (order must be unique per key)."""
    b = F.date_trunc(bucket, F.col(order).cast("timestamp"))
    d = df.withColumn("_b", b)
    counts = d.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    before = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(key, "_b", F.coalesce(F.sum("_nb").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy(key, "_b").orderBy(order, *tiebreak)
    return (d.withColumn("_rn", F.row_number().over(inner))
            .join(offs, [key, "_b"])
            .withColumn(pos, (F.col("_off") + F.col("_rn")).cast("bigint"))
            .drop("_b", "_off", "_rn"))


def series_counts(df: DataFrame, key: str = "ticker", name: str = "n") -> DataFrame:
    """Rows per key: one row per key, aggregated map-side before the shuffle."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def with_halo(df: DataFrame, halo: int, chunk: int = DEFAULT_CHUNK, pos: str = "pos") -> DataFrame:
    """Add ``_chunk`` and ``_own``; rows near a chunk end also appear in the next chunk."""
    if halo < 0 or chunk < max(halo, 1):
        raise ValueError(f"need chunk >= halo >= 0, got chunk={chunk}, halo={halo}")
    p = F.col(pos) - 1
    dup = F.when(F.pmod(p, F.lit(chunk)) >= chunk - halo, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0))) if halo > 0 else F.array(F.lit(0))
    return (df.withColumn("_d", F.explode(dup))
            .withColumn("_chunk", F.floor(p / chunk) + F.col("_d"))
            .withColumn("_own", F.col("_d") == 0)
            .drop("_d"))


def chunk_window(key: str = "ticker", pos: str = "pos"):
    """Window spec to use on the output of :func:`with_halo`."""
    return Window.partitionBy(key, "_chunk").orderBy(pos)


def owned(df: DataFrame) -> DataFrame:
    return df.where(F.col("_own")).drop("_chunk", "_own")
