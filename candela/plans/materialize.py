"""Write a derived table once and read it back.

A plan used by several branches of one query (bars feeding the scaler, the
sample windows, the forecast seeds and the feeds) would otherwise be
recomputed from the ticks in every branch: column pruning gives each branch
a different aggregate list, so Spark cannot reuse the exchange.  Writing the
table as Parquet in the shared checkpoint folder computes it once, cuts the
lineage (an executor loss re-reads files instead of replaying the tick
aggregation) and gives the planner real file sizes for its join choices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from candela.session import scratch_path


def materialize(df: DataFrame, name: str, partition_by=None) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    if partition_by:
        return spark.read.parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # known schema: no footer inference
