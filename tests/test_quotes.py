import datetime as dt
import json

from pyspark.sql import functions as F

from candela.schemas import QUOTE
from candela.session import scratch_path
from candela.sinks.writers import read_snapshot, versions, write_snapshot
from candela.sources import quotes as qt

# Three polls of one quote; the exchange stamp carries an offset.
POLLS = [{"ticker": "ZZB", "price": 41.25, "timestamp": "2031-03-04T16:00:00+02:00", "source": "unit",
          "fetched_at": f"2031-03-04T15:0{i}:30.500000Z"} for i in (1, 2, 3)]


def _write_lines(path, records):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/part-0.json", "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")


def test_log_scan_and_dedup(spark):
    path = scratch_path(spark, "polls").replace("file:", "")
    _write_lines(path, POLLS)
    log = qt.read_quote_log(spark, path)
    assert log.count() == 3
    d = qt.dedup_quotes(log).collect()
    assert len(d) == 1 and d[0].fetched_at == POLLS[0]["fetched_at"] and d[0].price == 41.25


def test_dedup_keeps_the_earliest_poll_of_a_timestamp(spark):
    later = dict(POLLS[0], price=2.0, fetched_at="2031-03-04T15:00:00.000000Z")
    tie = dict(later, price=1.0)
    d = qt.dedup_quotes(spark.createDataFrame(POLLS + [later, tie], QUOTE)).collect()
    assert [(r.price, r.fetched_at) for r in d] == [(1.0, later["fetched_at"])]


def test_snapshot_roundtrip_five_fields(spark):
    path = scratch_path(spark, "snap")
    log = spark.createDataFrame(POLLS, QUOTE)
    write_snapshot(qt.snapshot_latest(log), path)
    snap = read_snapshot(spark, path, QUOTE).collect()
    assert len(snap) == 1 and snap[0].fetched_at == POLLS[2]["fetched_at"]
    assert snap[0].asDict().keys() == {"ticker", "price", "timestamp", "source", "fetched_at"}
    # an offset timestamp is read as an instant
    inst = spark.createDataFrame(POLLS[:1], QUOTE).select(qt.quote_instant().alias("i")).collect()[0].i
    assert inst.replace(tzinfo=None) == dt.datetime(2031, 3, 4, 14, 0)


def test_snapshot_versions(spark):
    """Old versions go, an unfinished one is not read."""
    import os
    path = scratch_path(spark, "versions")
    for v in range(5):
        write_snapshot(spark.createDataFrame([dict(POLLS[0], price=float(v))], QUOTE), path)
    assert versions(spark, path) == [2, 3, 4]
    os.makedirs(path.replace("file:", "") + "/v=9")
    assert read_snapshot(spark, path, QUOTE).first().price == 4.0
    assert read_snapshot(spark, path, QUOTE, before=4).first().price == 3.0


def test_malformed_timestamps_are_kept_apart(spark):
    log = spark.createDataFrame(POLLS[:1] + [dict(POLLS[0], timestamp=t) for t in ("soon", None)], QUOTE)
    assert qt.well_formed(log).count() == 1 and qt.malformed(log).count() == 2


def test_scratch_needs_a_shared_folder_off_local_mode():
    import pytest
    from candela.session import checkpoint_root

    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(Conf)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_null_price_gives_no_record(spark):
    df = spark.createDataFrame([("A", None, dt.datetime(2024, 1, 1)), ("A", float("nan"), dt.datetime(2024, 1, 1)),
                                ("A", 1.5, dt.datetime(2024, 1, 1, 0, 0, 0, 5))],
                               "ticker string, price double, ts timestamp_ntz")
    r = qt.quote_records(qt.valid_quotes(df), "t").collect()
    assert len(r) == 1 and r[0].timestamp == "2024-01-01T00:00:00.000005"
    assert r[0].fetched_at == "2024-01-01T00:00:00.000005Z"


def test_isoformat_drops_zero_microseconds(spark):
    df = spark.createDataFrame([("A", 1.0, dt.datetime(2024, 1, 1, 12, 0))],
                               "ticker string, price double, ts timestamp_ntz")
    assert qt.quote_records(df, "t").collect()[0].timestamp == "2024-01-01T12:00:00"


def test_event_log_has_a_record_for_each_valid_event(spark):
    t = dt.datetime(2024, 1, 1, 9, 59, 1, 5)
    ev = spark.createDataFrame([("A", t, 1.0), ("A", t, None), ("A", t, float("nan")), (None, t, 2.0)],
                               "event_type string, ts timestamp_ntz, value double")
    r = qt.event_quote_log(ev).collect()
    assert [tuple(x) for x in r] == [("A", 1.0, "2024-01-01T09:00:00", "events", "2024-01-01T09:59:01.000005Z")]
