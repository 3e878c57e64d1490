import base64
import json
from datetime import datetime

import pytest

from tidewell.operators.store import SnapshotStore
from tidewell.sources import streams
from tidewell.sources.avro import Codec
from tidewell.sources.registry import FixedRegistry
from tidewell.streaming import change_batches as cb
from tidewell.streaming import landing, signals

_ROW = {
    "type": "record", "name": "Row",
    "fields": [
        {"name": "id", "type": "int"}, {"name": "d", "type": {"type": "int", "connect.name": "io.debezium.time.Date"}},
        {"name": "t", "type": [{"type": "long", "connect.name": "io.debezium.time.Timestamp", "default": 0}, "null"]},
        {"name": "m", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 8}]},
    ],
}
SCHEMA = {
    "type": "record", "name": "Change",
    "fields": [{"name": "before", "type": ["null", _ROW]}, {"name": "after", "type": ["null", "Row"]}, {"name": "op", "type": "string"}, {"name": "ts_ms", "type": ["null", "long"]}],
}
KEY = {"type": "record", "name": "Key", "fields": [{"name": "id", "type": "int"}]}
WIDER = json.loads(json.dumps(SCHEMA))
WIDER["fields"][0]["type"][1]["fields"].insert(1, {"name": "extra", "type": ["null", "string"]})
REGISTRY = FixedRegistry({1: KEY, 9: SCHEMA, 10: WIDER})
TOPIC = "p.Store.T"
MIRROR = "id int, d date, t timestamp, m decimal(12,8), last_applied_date timestamp, id_iceberg string"


def record(offset, id_, op, d=1, version=9, tombstone=False, partition=0):
    row = {"id": id_, "d": d, "t": 0, "m": None, "extra": "x"}
    value = {"before": row if op == "d" else None, "after": None if op == "d" else row, "op": op, "ts_ms": 1000}
    frame = lambda v, data: b"\0" + v.to_bytes(4, "big") + data
    body = None if tombstone else frame(version, Codec(WIDER if version == 10 else SCHEMA).writer()(value))
    return (frame(1, Codec(KEY).writer()({"id": id_})), body, TOPIC, partition, offset, datetime(2024, 1, 2, 3))


@pytest.fixture
def sink(spark, tmp_path):
    s = cb.ChangeSink(spark, SnapshotStore(spark, f"file://{tmp_path}/wh"), REGISTRY, "dag", "local")
    s.maintainer.ensure_ledgers()
    return s


def put(spark, path, *records):
    spark.createDataFrame(list(records), streams.RECORD).coalesce(1).write.mode("append").parquet(path)


def state(sink):
    return {(r.id, r.d.day) for r in sink.store.table("local_store.t").read().collect()}


def test_drain_applies_versions_in_offset_order_and_restarts(spark, sink, tmp_path):
    path, ck = f"file://{tmp_path}/in", f"file://{tmp_path}/ck"
    sink.store.table("local_store.t").replace(spark.createDataFrame([], MIRROR))
    put(spark, path, record(1, 1, "c"), record(2, 2, "r", version=10), record(3, 1, "u", d=4, version=10), record(4, 1, "u", d=6), record(5, 3, "c"), record(6, 3, "d"), record(7, 3, "d", tombstone=True))
    stream = lambda: streams.file_stream(spark, path)
    assert cb.drain_topics(sink, {TOPIC: stream}, ck, 2) == {}
    assert state(sink) == {(1, 7), (2, 2)}
    put(spark, path, record(8, 2, "d"), record(9, 4, "c", d=9))
    assert cb.drain_topics(sink, {TOPIC: stream}, ck) == {}
    assert state(sink) == {(1, 7), (4, 10)}
    assert cb.drain_topics(sink, {TOPIC: stream}, ck) == {}  # nothing new: a heartbeat
    rows = sink.maintainer.changes.read().orderBy("processed_at").collect()
    assert [(r.event_count, r.min_offset, r.max_offset, r.batch_id) for r in rows] == [(7, 1, 7, 0), (2, 8, 9, 1), (0, None, None, -1)]
    assert sink.modified.take() == {"local_store.t"}


def test_a_replayed_batch_changes_nothing(spark, sink):
    sink.store.table("local_store.t").replace(spark.createDataFrame([], MIRROR))
    batch = spark.createDataFrame([record(1, 1, "c"), record(2, 2, "c")], streams.RECORD)
    for _ in range(2):
        cb.process_changes(sink, TOPIC, batch, 5)
    assert state(sink) == {(1, 2), (2, 2)} and sink.maintainer.changes.read().count() == 1


def test_without_a_mirror_the_ledger_says_so(spark, sink):
    cb.process_changes(sink, TOPIC, spark.createDataFrame([record(1, 1, "c")], streams.RECORD), 0)
    row = sink.maintainer.changes.read().first()
    assert row.event_count == 0 and row.max_offset == 1 and sink.modified.take() == set()


def test_failed_topics_are_reported(spark, sink, tmp_path):
    path = f"file://{tmp_path}/in"
    sink.store.table("local_store.t").replace(spark.createDataFrame([], MIRROR))
    bad = list(record(1, 1, "c"))
    bad[1] = bad[1][:-1]
    put(spark, path, tuple(bad))
    errors = cb.drain_topics(sink, {TOPIC: lambda: streams.file_stream(spark, path)}, f"file://{tmp_path}/ck")
    assert list(errors) == [TOPIC] and state(sink) == set()


def test_rounds():
    outcomes, log = iter([{}, {"t": 1}, {"t": 1}, {}, {"t": 1}, {"t": 1}, {"t": 1}]), []
    code = cb.run_rounds(lambda: next(outcomes), lambda: log.append("after"), lambda: False, lambda s: log.append("sleep"), failed=lambda: log.append("failed"))
    assert code == 1 and log.count("after") == 2 and log.count("failed") == 4
    assert cb.run_rounds(dict, lambda: None, iter([False, True]).__next__, lambda s: None) == 0


def test_landing(spark, tmp_path):
    path, out = f"file://{tmp_path}/in", f"file://{tmp_path}/wh"
    put(spark, path, record(1, 1, "c"), record(2, 2, "c", version=10), record(3, 3, "d", tombstone=True))
    landing.start_landing(spark, REGISTRY, TOPIC, streams.file_stream(spark, path), out, f"file://{tmp_path}/ck", every=None).awaitTermination()
    got = spark.read.option("mergeSchema", True).parquet(f"{out}/{TOPIC}")
    assert got.count() == 2 and {(r.year, r.month, r.day) for r in got.collect()} == {(2024, 1, 2)} and "timestamp" not in got.columns


def test_signals(spark, tmp_path):
    s = signals.StopSignal(spark, f"file://{tmp_path}", "dag")
    assert not s.given()
    assert not signals.interruptible_sleep(0.01, s.given)
    s.give()
    assert s.given() and signals.interruptible_sleep(60, s.given)
    s.clear()
    assert not s.given()


def test_start_offsets():
    pack = lambda x: base64.b64encode(json.dumps(x).encode()).decode()
    want = {"t": {"0": 100}}
    assert json.loads(streams.start_offsets(pack({"t": {"0": 100}}), "t")) == want
    assert json.loads(streams.start_offsets(pack({"t": '{"t": {"0": 100}}'}), "t")) == want
    assert streams.start_offsets(pack({"t": "latest"}), "t") == "latest"
    assert streams.start_offsets(pack({}), "t") is None and streams.start_offsets(None, "t") is None


def test_listener_stops_queries(spark, tmp_path):
    signal = signals.StopSignal(spark, f"file://{tmp_path}/signal", "dag")
    listener = signals.StopListener(spark, signal)
    spark.streams.addListener(listener)
    try:
        query = spark.readStream.format("rate").load().writeStream.format("noop").trigger(processingTime="200 milliseconds").start()
        assert not query.awaitTermination(2)
        signal.give()
        assert query.awaitTermination(60)
    finally:
        spark.streams.removeListener(listener)
    assert listener.progress
