"""Change streams into mirror tables: what a micro-batch does, draining topics, rounds of drains."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import change_values, cleansing
from tidewell.functions.naming import topic_target
from tidewell.operators import changes, ledger
from tidewell.operators.iceberg import IcebergStore
from tidewell.operators.maintenance import Maintainer, ModifiedTables
from tidewell.operators.store import SnapshotStore
from tidewell.sources import avro
from tidewell.sources.registry import SchemaRegistry

log = logging.getLogger(__name__)


@dataclass
class ChangeSink:
    """What a topic's batches need: where tables are, who knows schemas, which service and zone the source has."""

    spark: SparkSession
    store: SnapshotStore | IcebergStore
    registry: SchemaRegistry
    dag_id: str
    service: str
    ops: str = "di_ops"
    source_zone: str = "Asia/Seoul"
    modified: ModifiedTables = field(default_factory=ModifiedTables)

    def __post_init__(self) -> None:
        self.maintainer = Maintainer(self.spark, self.store, self.dag_id, self.ops)
        self.ledger_lock = threading.Lock()

    def record(self, target, scheduled: datetime, stats: Mapping, seconds: float, batch_id: int) -> None:
        row = {
            "dag_id": self.dag_id, "iceberg_schema": target.namespace, "table_name": target.table, "scheduled_at": scheduled, "processed_at": datetime.now(UTC),
            "processing_duration_sec": seconds, "batch_id": batch_id, **stats,
        }
        rows = ledger.ledger_rows(self.spark, ledger.CHANGE_LEDGER, [row])
        with self.ledger_lock:
            if batch_id >= 0 and stats["event_count"]:  # a stream replays its last batch alone; that has its row already
                self.maintainer.changes.append_once(rows, f"last_batch.{self.dag_id}.{target.name}", str(batch_id))
            else:
                self.maintainer.changes.append(rows)


def framed(batch: DataFrame) -> DataFrame:
    """A batch with headers split off: key and value payloads and their schema ids; tombstones go."""
    ids = {f"{c}_schema_id": change_values.schema_id(F.col(c)) for c in ("key", "value")}
    out = batch.where("value is not null").withColumns(ids)
    return out.withColumns({c: change_values.payload(F.col(c)) for c in ("key", "value")})


def one_version(rows: DataFrame, key_schema: str, value_schema: str, mirror: T.StructType, zone: str) -> DataFrame:
    """Records of one key and one value schema as rows of the mirror, with op, partition and offset."""
    kinds = change_values.logical_types(value_schema)
    keys = [f["name"] for f in avro.schema_of(key_schema)["fields"]]
    plain = rows.select("key", "value", *[c for c in ("partition", "offset") if c in rows.columns])
    opened = avro.decoded(avro.decoded(plain, "key", key_schema, "k"), "value", value_schema, "v")
    cast = {f.name: f.dataType for f in mirror.fields}

    def value(column: str, at: str):
        return change_values.logical_value(F.col(f"{at}.`{column}`"), kinds.get(column, ""), zone)

    identity = cleansing.surrogate_key([value(k, "k").cast(cast[k]) if k in cast else value(k, "k") for k in keys])
    made = {cleansing.KEY: identity, cleansing.AUDIT: F.timestamp_millis("v.ts_ms")}
    columns = [(made[f.name] if f.name in made else value(f.name, "v.after")).cast(f.dataType).alias(f.name) for f in mirror.fields]
    technical = [F.col("v.op").alias("_op"), (F.col("partition") if "partition" in plain.columns else F.lit(0)).alias("_partition"), F.col("offset").alias("_offset")]
    return opened.select(*columns, *technical)


def process_changes(sink: ChangeSink, topic: str, batch: DataFrame, batch_id: int) -> None:
    """Apply a micro-batch to the topic's mirror and write its ledger row.

    All schema versions of the batch are brought to the mirror's columns first, and a key's last change by offset wins
    over all of them.  Upserts and deletes are one commit, so a replay applies the same rows to the same effect.  Where
    there is no mirror the rows aren't applied, and the ledger row says so by an event count of 0.
    """
    began, scheduled = time.monotonic(), datetime.now(UTC)
    target = topic_target(sink.service, topic)
    table = sink.store.table(target.name)
    batch = batch.persist()
    try:
        if batch.isEmpty():
            return
        stats = batch.agg(F.count("*").alias("event_count"), F.max("timestamp").alias("max_event_ts"), F.min("offset").alias("min_offset"), F.max("offset").alias("max_offset")).first().asDict()
        if not table.exists():
            log.warning("no mirror %s for %s", target.name, topic)
            stats["event_count"] = 0
        else:
            rows = framed(batch)
            pairs = sorted((r[0], r[1]) for r in rows.select("value_schema_id", "key_schema_id").distinct().collect() if None not in tuple(r))
            mirror = table.schema()
            parts = [
                one_version(rows.where((F.col("value_schema_id") == v) & (F.col("key_schema_id") == k)), sink.registry.schema(k), sink.registry.schema(v), mirror, sink.source_zone)
                for v, k in pairs
            ]
            if parts:
                latest = changes.latest_per_key(reduce(DataFrame.unionByName, parts), cleansing.KEY, "_partition", "_offset")
                table.apply_changes(latest.withColumnRenamed("_op", "op").drop("_partition", "_offset"), cleansing.KEY)
                sink.modified.mark(target.name)
        sink.record(target, scheduled, stats, time.monotonic() - began, batch_id)
    finally:
        batch.unpersist()


def drain_topic(sink: ChangeSink, topic: str, stream: DataFrame, checkpoint: str) -> bool:
    """Process what a topic has and stop; a heartbeat row if that was nothing.  True if there were batches."""
    ran = threading.Event()
    spark = sink.spark

    def each(batch: DataFrame, batch_id: int) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", topic)  # here: this is the stream's thread
        if not batch.isEmpty():
            ran.set()
        process_changes(sink, topic, batch, batch_id)

    query = stream.writeStream.foreachBatch(each).queryName(topic).option("checkpointLocation", f"{checkpoint.rstrip('/')}/{topic}").trigger(availableNow=True).start()
    query.awaitTermination()
    if not ran.is_set():
        sink.record(topic_target(sink.service, topic), datetime.now(UTC), {"event_count": 0}, 0.0, -1)
    return ran.is_set()


def drain_topics(sink: ChangeSink, streams: Mapping[str, Callable[[], DataFrame]], checkpoint: str, concurrency: int = 3) -> dict[str, Exception]:
    """Drain topics, ``concurrency`` at a time; the errors by topic."""
    errors: dict[str, Exception] = {}

    def run(topic: str) -> None:
        try:
            drain_topic(sink, topic, streams[topic](), checkpoint)
        except Exception as e:
            log.exception("topic %s failed", topic)
            errors[topic] = e

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        for f in [pool.submit(inheritable_thread_target(sink.spark)(run), t) for t in streams]:
            f.result()
    return errors


def run_rounds(
    drain: Callable[[], Mapping[str, Exception]],
    after: Callable[[], object],
    stopped: Callable[[], bool],
    sleep: Callable[[float], object],
    interval_s: float = 300.0,
    budget: int = 3,
    back_off_s: float = 5.0,
    failed: Callable[[], object] = lambda: None,
) -> int:
    """Drain in rounds until stopped: 0, or 1 after ``budget`` failed rounds in a row.

    A failed round calls ``failed`` and waits a little longer each time before the next; a good one calls ``after`` and
    sleeps for the rest of the interval.
    """
    in_a_row = 0
    while not stopped():
        began = time.monotonic()
        if drain():
            in_a_row += 1
            if in_a_row >= budget:
                return 1
            failed()
            sleep(back_off_s * in_a_row)
            continue
        in_a_row = 0
        after()
        sleep(max(0.0, interval_s - (time.monotonic() - began)))
    return 0


def compact_modified(sink: ChangeSink, interval_s: int = ledger.COMPACTION_INTERVAL) -> Sequence[str]:
    return sink.maintainer.compact_due(sink.modified.take(), interval_s)
