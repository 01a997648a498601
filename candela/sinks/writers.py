"""K1–K4: writers.  Paths are folders on the shared file system.

Writes that a retried task or a replayed stream batch may repeat are made
idempotent: every batch goes to its own ``batch_id=`` folder in overwrite
mode, and a snapshot is written as a new version folder, never over the
folder that is being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete snapshot versions (their job has left ``_SUCCESS``), ascending."""
    out = []
    for name in list_dirs(spark, path):
        if name.startswith("v="):
            fs, p = _fs(spark, f"{path.rstrip('/')}/{name}/_SUCCESS")
            if fs.exists(p):
                out.append(int(name[2:]))
    return sorted(out)


#: Snapshot versions that stay; readers of a version that is older may find it gone.
KEEP_VERSIONS = 3


def write_snapshot(df: DataFrame, path: str, version: int | None = None, keep: int = KEEP_VERSIONS) -> str:
    """K1: write the snapshot (one JSON object per ticker) as a new version folder.

    The final aggregate keeps its partitions (AQE merges small ones).  After a
    complete write all but the last ``keep`` versions are removed.
    """
    spark = df.sparkSession
    done = versions(spark, path)
    if version is None:
        version = done[-1] + 1 if done else 0
    out = f"{path.rstrip('/')}/v={version}"
    df.write.mode("overwrite").json(out)
    older = [v for v in done if v < version]
    for old in older[:max(0, len(older) - keep + 1)]:
        fs, p = _fs(spark, f"{path.rstrip('/')}/v={old}")
        fs.delete(p, True)
    return out


def read_snapshot(spark: SparkSession, path: str, schema, before: int | None = None) -> DataFrame | None:
    """Latest complete snapshot version (only versions < ``before`` when given, so a
    replayed stream batch re-reads the state it started from)."""
    done = [v for v in versions(spark, path) if before is None or v < before]
    return spark.read.schema(schema).json(f"{path.rstrip('/')}/v={done[-1]}") if done else None


def append_quote_log(df: DataFrame, path: str, batch_id: int | None = None) -> None:
    """K2: append records as JSON lines; with a batch id the append is replay-safe."""
    if batch_id is None:
        df.write.mode("append").json(path)
    else:
        df.write.mode("overwrite").json(f"{path.rstrip('/')}/batch_id={batch_id}")


def enter_rows(spark: SparkSession, log_path: str, batch_id: int, total: int) -> None:
    """Enters in the log's ledger how many records the log has up to and with a batch (one small file for each batch)."""
    fs, p = _fs(spark, f"{log_path.rstrip('/')}-ledger/{batch_id}")
    out = fs.create(p, True)
    out.write(bytearray(str(total).encode()))
    out.close()


def ledger_rows(spark: SparkSession, log_path: str, but_batch: int | None = None) -> int | None:
    """Records of the log by its ledger, without ``but_batch`` and what came after it; None without a ledger."""
    fs, p = _fs(spark, f"{log_path.rstrip('/')}-ledger")
    if not fs.exists(p):
        return None
    batches = [int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()]
    batches = [n for n in batches if but_batch is None or n < but_batch]
    if not batches:
        return 0
    return int(spark.read.text(f"{log_path.rstrip('/')}-ledger/{max(batches)}").first()[0])


def write_feed(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None) -> None:
    """K3: a chart feed as a table (the drawing itself is not built)."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
