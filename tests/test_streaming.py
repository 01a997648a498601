import datetime as dt
import json
import os

from candela.schemas import QUOTE
from candela.session import scratch_path
from candela.sinks.merged import MergedTable
from candela.sinks.writers import ledger_rows, list_dirs
from candela.sources.quotes import dedup_quotes, snapshot_latest
from candela.streaming.bars import stream_bars
from candela.streaming.quotes import first_polls_table, latest_table, logged_rows, run_dedup, run_quote_stream, run_to_parquet


def _rec(t, p, ts, fa):
    return {"ticker": t, "price": p, "timestamp": ts, "source": "t", "fetched_at": fa}


def _files(base, batches):
    os.makedirs(base, exist_ok=True)
    for i, recs in enumerate(batches):
        with open(f"{base}/f{i:03d}.json", "w") as f:
            for r in recs:
                f.write(json.dumps(r) + "\n")
        os.utime(f"{base}/f{i:03d}.json", (1_700_000_000 + i, 1_700_000_000 + i))


BATCHES = [
    [_rec("A", 1.0, "2024-01-01T10:00:00", "2024-01-01T10:00:01.000000Z"),
     _rec("B", 5.0, "2024-01-01T10:00:00", "2024-01-01T10:00:01.000000Z")],
    [_rec("A", None, "2024-01-01T10:01:00", "2024-01-01T10:01:01.000000Z"),
     _rec("A", 2.0, "2024-01-01T10:02:00", "2024-01-01T10:02:01.000000Z")],
    [_rec("B", 6.0, "2024-01-01T09:00:00", "2024-01-01T10:03:01.000000Z")],   # older exchange time
]


def test_quote_stream_log_and_snapshot(spark):
    base = scratch_path(spark, "qs").replace("file:", "")
    _files(f"{base}/src", BATCHES)
    n = run_quote_stream(spark, f"{base}/src", f"{base}/log", f"{base}/snap", f"{base}/ck",
                         max_files_per_trigger=1)
    assert n == 4                                  # the NULL price is not written
    log = spark.read.schema(QUOTE).option("recursiveFileLookup", "true").json(f"{base}/log")
    assert log.count() == 4
    snap = {r.ticker: r.price for r in latest_table(spark, f"{base}/snap").read().collect()}
    assert snap == {"A": 2.0, "B": 5.0}            # B's late batch holds an older quote
    # a restart with the same checkpoint does not append again
    assert run_quote_stream(spark, f"{base}/src", f"{base}/log", f"{base}/snap", f"{base}/ck") == 0
    assert spark.read.schema(QUOTE).option("recursiveFileLookup", "true").json(f"{base}/log").count() == 4


def _log(spark, base):
    return sorted(map(tuple, spark.read.schema(QUOTE).option("recursiveFileLookup", "true").json(f"{base}/log").collect()))


def test_row_limit_is_exact_and_resumable(spark):
    """20 records in 5 files; limits that cut a batch, end one, and are raised; then no limit."""
    base = scratch_path(spark, "qsmax").replace("file:", "")
    recs = [[_rec("A", float(4 * f + i), f"2024-01-01T10:{f:02d}:{i:02d}", f"2024-01-01T11:{f:02d}:{i:02d}.000000Z")
             for i in range(4)] for f in range(5)]
    _files(f"{base}/src", recs)
    want = sorted(tuple(r[c] for c in QUOTE.names) for b in recs for r in b)

    def run(limit):
        return run_quote_stream(spark, f"{base}/src", f"{base}/log", f"{base}/snap", f"{base}/ck",
                                max_files_per_trigger=1, max_rows=limit)

    for limit in (1, 1, 6, 8, 11):
        run(limit)
        assert _log(spark, base) == want[:limit]
    run(0)
    assert _log(spark, base) == want
    assert run(0) == 0
    assert latest_table(spark, f"{base}/snap").read().first().price == 19.0


def test_stream_keeps_rejects_apart_and_binds_to_tickers(spark):
    base = scratch_path(spark, "qsrej").replace("file:", "")
    bad = _rec("A", 3.0, "yesterday", "2024-01-01T10:04:01.000000Z")
    _files(f"{base}/src", [*BATCHES, [bad]])
    n = run_quote_stream(spark, f"{base}/src", f"{base}/log", f"{base}/snap", f"{base}/ck", tickers="A")
    assert n == 2 and {r[0] for r in _log(spark, base)} == {"A"}
    rejects = spark.read.schema(QUOTE).option("recursiveFileLookup", "true").json(f"{base}/log-rejects").collect()
    assert [r.timestamp for r in rejects] == ["yesterday"]


def test_the_snapshot_is_exported_as_json(spark, monkeypatch):
    from candela.sinks.writers import read_snapshot, versions
    from candela.streaming import quotes
    monkeypatch.setattr(quotes, "EXPORT_EVERY", 2)
    base = scratch_path(spark, "export").replace("file:", "")
    _files(f"{base}/src", BATCHES)
    run_quote_stream(spark, f"{base}/src", f"{base}/log", f"{base}/table", f"{base}/ck", max_files_per_trigger=1, export=f"{base}/snap")
    assert versions(spark, f"{base}/snap") == [0, 1]             # after the second batch, and at the end
    assert sorted(map(tuple, read_snapshot(spark, f"{base}/snap", QUOTE).collect())) == \
        sorted(map(tuple, latest_table(spark, f"{base}/table").read().collect()))


def test_dedup_takes_late_quotes_and_earlier_polls(spark):
    """A quote far behind its ticker's newest, and a poll that is earlier than one seen before: as in the batch form."""
    base = scratch_path(spark, "dedup").replace("file:", "")
    a = _rec("A", 1.0, "2024-01-10T10:00:00", "2024-01-10T10:00:05.000000Z")
    earlier = dict(a, fetched_at="2024-01-10T10:00:01.000000Z", price=0.5)
    again = dict(a, fetched_at="2024-01-10T10:01:01.000000Z", price=2.0)
    late = _rec("A", 5.0, "2023-06-05T10:00:00", "2024-01-10T10:02:01.000000Z")
    batches = [[again, a], [late, dict(a, timestamp="2024-01-10T11:00:00")], [earlier, again, dict(late, ticker="B"), dict(a, timestamp=None)]]
    _files(f"{base}/src", batches)
    run_dedup(spark, f"{base}/src", f"{base}/out", f"{base}/ck", max_files_per_trigger=1)
    got = sorted(map(tuple, first_polls_table(spark, f"{base}/out").read().collect()), key=str)
    whole = spark.createDataFrame([tuple(r[c] for c in QUOTE.names) for b in batches for r in b], QUOTE)
    assert got == sorted(map(tuple, dedup_quotes(whole).collect()), key=str)
    assert ("A", 0.5, "2024-01-10T10:00:00", "t", earlier["fetched_at"]) in got and len(got) == 5


def _quotes(spark, *rows):
    return spark.createDataFrame([tuple(_rec(*r)[c] for c in QUOTE.names) for r in rows], QUOTE)


def _quote_row(t, i):
    return t, float(i), f"2024-01-01T10:{i:02d}:00", f"2024-01-01T11:{i:02d}:00.000000Z"


def test_a_batch_of_one_ticker_rewrites_one_bucket(spark):
    table = MergedTable(spark, scratch_path(spark, "merged"), QUOTE, ["ticker"], snapshot_latest, buckets=16, fold_after=2)
    names = [f"T{i}" for i in range(40)]
    for batch in range(3):
        table.amend(_quotes(spark, *(_quote_row(t, batch) for t in names)), batch)
    before = table._manifest()
    assert before["through"] == 1 and len(before["buckets"]) > 8
    table.amend(_quotes(spark, _quote_row("T7", 3)), 3)
    table.amend(_quotes(spark, _quote_row("T7", 4)), 4)          # folds 2 and 3
    table.amend(_quotes(spark, _quote_row("T7", 5)), 5)
    table.amend(_quotes(spark, _quote_row("T7", 6)), 6)          # folds 4 and 5: both hold T7 alone
    after = table._manifest()
    assert after["through"] == 5 and after["version"] == 3
    touched = [b for b, v in after["buckets"].items() if v == 3]
    assert len(touched) == 1 and list_dirs(spark, f"{table.path}/base/v=3") == [f"bucket={touched[0]}"]
    got = {r.ticker: r.price for r in table.read().collect()}
    assert got == {t: 2.0 for t in names} | {"T7": 6.0}


def test_replays_crashes_and_old_batches_change_nothing(spark, monkeypatch):
    table = MergedTable(spark, scratch_path(spark, "merged"), QUOTE, ["ticker"], snapshot_latest, buckets=4, fold_after=2)
    for batch in range(4):
        table.amend(_quotes(spark, _quote_row("A", batch), _quote_row(f"B{batch}", 9)), batch)
    want = sorted(map(tuple, table.read().collect()))
    table.amend(_quotes(spark, _quote_row("A", 3), _quote_row("B3", 9)), 3)          # the last batch again
    table.amend(_quotes(spark, _quote_row("A", 50)), 0)                              # a batch that is in the base
    assert sorted(map(tuple, table.read().collect())) == want
    with monkeypatch.context() as m:                                                  # ends between buckets and manifest
        m.setattr(table, "_put_manifest", lambda manifest: 1 / 0)
        try:
            table.amend(_quotes(spark, _quote_row("A", 4)), 4)
            raise AssertionError("no crash")
        except ZeroDivisionError:
            pass
    assert sorted(map(tuple, table.read().collect())) == want
    table.amend(_quotes(spark, _quote_row("A", 4)), 4)
    got = {r.ticker: r.price for r in table.read().collect()}
    assert got == {"A": 4.0, "B0": 9.0, "B1": 9.0, "B2": 9.0, "B3": 9.0}
    for batch in range(5, 16):                                                        # old versions and runs go
        table.amend(_quotes(spark, _quote_row("A", batch)), batch)
    assert table.read().where("ticker = 'A'").first().price == 15.0
    assert len(table._manifests()) <= 4 and len(list_dirs(spark, f"{table.path}/runs")) <= 6


def test_an_empty_table_and_an_empty_batch(spark):
    table = MergedTable(spark, scratch_path(spark, "merged"), QUOTE, ["ticker"], snapshot_latest)
    assert table.read().count() == 0
    table.amend(_quotes(spark, _quote_row("A", 1)).limit(0), 0)
    assert table.read().count() == 0
    table.amend(_quotes(spark, (None, 1.0, "2024-01-01T10:00:00", "2024-01-01T11:00:00.000000Z")), 1)
    assert table.read().first().price == 1.0


def test_the_ledger_counts_without_reading_the_log(spark):
    base = scratch_path(spark, "ledger").replace("file:", "")
    _files(f"{base}/src", BATCHES)
    run_quote_stream(spark, f"{base}/src", f"{base}/log", f"{base}/snap", f"{base}/ck", max_files_per_trigger=1)
    assert ledger_rows(spark, f"{base}/log") == 4 and ledger_rows(spark, f"{base}/log", 1) == 2
    os.rename(f"{base}/log", f"{base}/log-elsewhere")
    assert logged_rows(spark, f"{base}/log") == 4 and logged_rows(spark, f"{base}/log-elsewhere") == 4   # the latter counted


def test_event_stream_reads_a_folder_and_a_file_alike(spark):
    from candela.streaming.bars import event_bar_stream
    base = scratch_path(spark, "multi").replace("file:", "")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(3).write.parquet(f"{base}/in/events.parquet")
    out = []
    for i, folder in enumerate((f"{base}/in", "/root/testdata/sf0.001")):
        run_to_parquet(event_bar_stream(spark, folder), f"{base}/out{i}", f"{base}/ck{i}")
        out.append(sorted(map(tuple, spark.read.parquet(f"{base}/out{i}").collect())))
    assert out[0] == out[1] and len(out[0]) > 100


def test_stream_bars_drop_late_tick(spark):
    base = scratch_path(spark, "sb").replace("file:", "")
    os.makedirs(f"{base}/src", exist_ok=True)
    t = dt.datetime(2024, 1, 1, 10, 0)
    # late rows are filtered with the watermark of the previous batch, so the
    # watermark must have passed 11:00 one batch before the late tick arrives
    batches = [[(t, 1.0, 1), (t + dt.timedelta(minutes=30), 3.0, 2)],
               [(t + dt.timedelta(hours=3), 2.0, 3)],
               [(t + dt.timedelta(hours=3, minutes=5), 2.5, 6)],
               [(t + dt.timedelta(minutes=10), 9.0, 4),            # late: watermark is 12:00
                (t + dt.timedelta(hours=4, minutes=5), 4.0, 5)]]
    for i, b in enumerate(batches):
        df = spark.createDataFrame([("A", ts, p, 1.0, k) for ts, p, k in b],
                                   "ticker string, ts timestamp_ntz, price double, qty double, tick_id bigint")
        df.coalesce(1).write.parquet(f"{base}/src/b{i}")
    schema = "ticker string, ts timestamp_ntz, price double, qty double, tick_id bigint"
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(f"{base}/src")
    run_to_parquet(stream_bars(src, "1 hour", "1 hour"), f"{base}/out", f"{base}/ck")
    out = {r.bar_ts: r for r in spark.read.parquet(f"{base}/out").collect()}
    first = out[t]
    assert (first.open, first.high, first.close, first.n_ticks) == (1.0, 3.0, 3.0, 2)   # 9.0 dropped


def test_a_late_tick_amends_its_bar(spark):
    """The same ticks in batches of any order give the bars of the batch form; no tick is late."""
    from candela.sources.bars import build_bars
    from candela.sources.ticks import with_seq
    from candela.streaming.bars import read_bars, run_bars
    base = scratch_path(spark, "amend").replace("file:", "")
    t, schema = dt.datetime(2024, 1, 1, 10, 0), "ticker string, ts timestamp_ntz, price double, qty double, tick_id bigint"
    minutes = [[(0, 1.0), (30, 3.0)], [(180, 2.0)], [(185, 2.5), (60 * 24 * 400, 7.0)], [(10, 9.0), (59, 0.5), (245, 4.0)], [(0, 8.0)]]
    rows, k = [], 0
    for i, b in enumerate(minutes):
        batch = [("A", t + dt.timedelta(minutes=m), p, 1.0, k + j) for j, (m, p) in enumerate(b)]
        k += len(batch)
        rows += batch
        spark.createDataFrame(batch, schema).coalesce(1).write.parquet(f"{base}/src/b{i}")
    src = with_seq(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{base}/src"))
    run_bars(src, f"{base}/out", f"{base}/ck")
    want = build_bars(with_seq(spark.createDataFrame(rows, schema)), "hour").select("ticker", "bar_ts", "open", "high", "low", "close", "volume", "n_ticks")
    got = sorted(map(tuple, read_bars(spark, f"{base}/out").collect()))
    assert got == sorted(map(tuple, want.collect()))
    assert got[0][2:] == (1.0, 9.0, 0.5, 0.5, 5, 5)
