"""Structured Streaming over a folder of newline-JSON quote files.

A file-source stream plays the poll loop: each trigger is one micro-batch
handled by ``foreachBatch``:

1. drop missing quotes (P6),
2. append the batch to the log in its own ``batch_id=<id>`` folder with
   overwrite mode — a replayed batch rewrites the same folder (K2) — and enter
   its records in the log's ledger,
3. amend the snapshot with the batch's latest record per ticker (K1), a
   :class:`candela.sinks.merged.MergedTable`: a batch writes what it brings and
   rewrites nothing.

Offsets and progress live in the checkpoint folder: a restart resumes where
it stopped.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candela.schemas import QUOTE
from candela.sinks.merged import MergedTable
from candela.sinks.writers import append_quote_log, enter_rows, ledger_rows, list_dirs, write_snapshot
from candela.sources.quotes import dedup_quotes, malformed, quote_instant, snapshot_latest, valid_quotes, well_formed
from candela.sources.scans import ticker_filter


def latest_table(spark: SparkSession, path: str) -> MergedTable:
    """The latest record of each ticker."""
    return MergedTable(spark, path, QUOTE, ["ticker"], snapshot_latest)


def first_polls_table(spark: SparkSession, path: str) -> MergedTable:
    """T5: the earliest poll of each ``(ticker, timestamp)``."""
    return MergedTable(spark, path, QUOTE, ["ticker", "timestamp"], dedup_quotes)


def quote_stream(spark: SparkSession, src: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S6 streaming: the quote log folder as an unbounded table (fixed schema)."""
    r = spark.readStream.schema(QUOTE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.json(src)


def _trigger(writer, interval_s, available_now):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{int(interval_s)} seconds")


class RowLimit(Exception):
    """Ends a query whose log has all the rows asked for; its batch stays uncommitted."""


#: Batches between two exports of the snapshot.
EXPORT_EVERY = 8
#: What the query's error must say to be a reached limit and no failure.
LIMIT_REACHED = "row limit of the quote log reached"
#: Order in which a limit takes the records of a batch.
LOG_ORDER = ("fetched_at", "ticker", "timestamp", "source", "price")


def logged_rows(spark: SparkSession, log_path: str, but_batch: int | None = None) -> int:
    """Records in the log, without the batch that is about to be written (again): the ledger's last entry,
    or a count of the log where it has none."""
    known = ledger_rows(spark, log_path, but_batch)
    if known is not None:
        return known
    if not list_dirs(spark, log_path):
        return 0
    log = spark.read.schema(T.StructType([*QUOTE.fields, T.StructField("batch_id", T.LongType())])).json(log_path)
    return log.where(F.col("batch_id") != but_batch).count() if but_batch is not None else log.count()


def run_quote_stream(spark: SparkSession, src: str, log_path: str, snapshot_path: str,
                     checkpoint: str, interval_s: int = 60, available_now: bool = True,
                     max_rows: int = 0, max_files_per_trigger: int | None = None,
                     timeout_s: float | None = None, tickers=None, export: str | None = None):
    """T1 + T2: run the poll loop; returns the number of records written by this run.

    ``snapshot_path`` holds the latest record of each ticker as a :func:`latest_table`; ``export`` also
    writes it as JSON lines (K1) every ``EXPORT_EVERY`` batches and when the run ends.

    ``max_rows`` > 0 stops once the log holds that many records, counted in the
    log itself, so that a restart goes on counting.  The batch that crosses
    the limit is cut in ``LOG_ORDER`` and ends the query before its offsets
    are committed: a later run without the limit, or with a higher one,
    replays it, overwrites its folder and loses nothing.  Records whose
    timestamp cannot be read go to ``<log>-rejects``.  ``tickers`` binds the
    loop to these names.
    """
    state = {"before": None, "written": 0}
    snapshot = latest_table(spark, snapshot_path)

    def handle(batch: DataFrame, batch_id: int):
        if state["before"] is None:
            state["before"] = logged_rows(spark, log_path, batch_id)
        left = max_rows - state["before"] - state["written"] if max_rows else None
        if left is not None and left <= 0:
            raise RowLimit(LIMIT_REACHED)
        valid = ticker_filter(valid_quotes(batch), tickers).persist()
        try:
            good, bad = well_formed(valid), malformed(valid)
            n, wrong = valid.agg(F.count_if(quote_instant().isNotNull()), F.count_if(quote_instant().isNull())).first()
            if wrong:
                append_quote_log(bad, f"{log_path.rstrip('/')}-rejects", batch_id)
            cut = left is not None and n > left
            if cut:
                good, n = good.orderBy(*LOG_ORDER).limit(left), left
            if n:
                append_quote_log(good, log_path, batch_id)
                enter_rows(spark, log_path, batch_id, state["before"] + state["written"] + n)
                snapshot.amend(good, batch_id)
                state["written"] += n
                if export and (batch_id + 1) % EXPORT_EVERY == 0:
                    write_snapshot(snapshot.read(), export)
            if cut:
                raise RowLimit(LIMIT_REACHED)
        finally:
            valid.unpersist()

    w = (quote_stream(spark, src, max_files_per_trigger).writeStream
         .foreachBatch(handle).option("checkpointLocation", checkpoint))
    q = _trigger(w, interval_s, available_now).start()
    t0 = time.time()
    try:
        while q.isActive:
            q.awaitTermination(0.5)
            full = max_rows and state["before"] is not None and state["before"] + state["written"] >= max_rows
            late = timeout_s and time.time() - t0 > timeout_s
            if (full or late) and q.isActive and not q.status.get("isTriggerActive", False):
                q.stop()
        if q.exception():
            raise RuntimeError(str(q.exception()))
    except Exception as e:
        if LIMIT_REACHED not in str(e):
            raise
    if export and state["written"]:
        write_snapshot(snapshot.read(), export)
    return state["written"]


def _run_amending(stream: DataFrame, table: MergedTable, checkpoint: str, available_now: bool, interval_s: int) -> None:
    w = stream.writeStream.foreachBatch(table.amend).option("checkpointLocation", checkpoint)
    _trigger(w, interval_s, available_now).start().awaitTermination()


def run_live_latest(spark: SparkSession, src: str, out_path: str, checkpoint: str,
                    max_files_per_trigger: int | None = None, available_now: bool = True,
                    interval_s: int = 5) -> None:
    """T3 driver: each trigger amends the tickers that it brings; read it with ``latest_table(...).read()``."""
    _run_amending(valid_quotes(quote_stream(spark, src, max_files_per_trigger)), latest_table(spark, out_path),
                  checkpoint, available_now, interval_s)


def run_dedup(spark: SparkSession, src: str, out_path: str, checkpoint: str, max_files_per_trigger: int | None = None,
              available_now: bool = True, interval_s: int = 5) -> None:
    """T5 streaming: one record per ``(ticker, timestamp)``, the earliest poll of all batches.

    A batch is reduced by a hash aggregate and amends the table of first polls.  No quote is late: one that is
    older than all others gets its record, and an earlier poll that arrives later replaces the one before.
    Read it with ``first_polls_table(...).read()``: the same as the batch form :func:`dedup_quotes`.
    """
    _run_amending(quote_stream(spark, src, max_files_per_trigger), first_polls_table(spark, out_path),
                  checkpoint, available_now, interval_s)


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Drain a streaming DataFrame into a Parquet folder (file sink, exactly once)."""
    q = (df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", checkpoint).option("path", out)
         .trigger(availableNow=True).start())
    q.awaitTermination()
