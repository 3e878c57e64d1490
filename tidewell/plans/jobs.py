"""The jobs: snapshots from databases, staging and loading of Parquet, change streams, landing, validation, maintenance.

Each is a function of sources and a store; ``main`` reads arguments and settings.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tidewell.functions import cleansing
from tidewell.functions.naming import source_target
from tidewell.operators import validation
from tidewell.operators.iceberg import IcebergStore
from tidewell.operators.maintenance import Maintainer
from tidewell.operators.store import SnapshotStore
from tidewell.session import STREAMING, catalog_options, create_session
from tidewell.settings import Settings
from tidewell.sources import jdbc, streams, tables
from tidewell.sources.files import Files
from tidewell.sources.registry import HttpRegistry
from tidewell.streaming import change_batches, landing, signals


def table_store(spark: SparkSession, settings: Settings) -> SnapshotStore | IcebergStore:
    """Where tables are kept: the session's catalog, or, without one, the engine's own store below the warehouse."""
    if catalog_options(settings):
        return IcebergStore(spark, settings.catalog, settings.warehouse)
    return SnapshotStore(spark, settings.warehouse)


def snapshot_rows(source: DataFrame, key: Sequence[str]) -> DataFrame:
    """A source table's rows as a mirror has them: trimmed, audited, with the surrogate key where there is one."""
    return cleansing.with_key(cleansing.with_audit(cleansing.trim_strings(source)), key)


def snapshot(db: jdbc.Database, store: SnapshotStore | IcebergStore, service: str, table: str, partitions: int = 1) -> str:
    """Replace a mirror by all of its source; returns the mirror's name."""
    target = source_target(service, table)
    key = db.primary_key(table)
    store.table(target.name).replace(snapshot_rows(db.read(table, partitions), key), {"key": ",".join(key)} if key else {})
    return target.name


def stage(db: jdbc.Database, warehouse: str, table: str, partitions: int = 1) -> str:
    """A source table as Parquet, audited under the staging name; returns the folder, which keeps the names' case."""
    parts = db.parts(table)
    path = f"{warehouse.rstrip('/')}/{parts[0]}/{parts[-1]}"
    rows = cleansing.with_audit(cleansing.trim_strings(db.read(table, partitions)), name=cleansing.AUDIT_BEFORE)
    rows.write.mode("overwrite").parquet(path)
    return path


def load(spark: SparkSession, store: SnapshotStore | IcebergStore, service: str, table: str, path: str, key: Sequence[str]) -> str:
    """Replace a mirror by staged Parquet."""
    target = source_target(service, table)
    rows = cleansing.renamed_audit(cleansing.timestamps_to_utc(cleansing.trim_strings(tables.parquet(spark, path))))
    store.table(target.name).replace(cleansing.with_key(rows, key), {"key": ",".join(key)} if key else {})
    return target.name


def validate(db: jdbc.Database, store: SnapshotStore | IcebergStore, service: str, names: Sequence[str]) -> DataFrame:
    """Findings on each table and its mirror; the mirrors' comments are brought in line with the sources'."""
    rows: list[tuple] = []
    for name in names:
        target = source_target(service, name)
        mirror = store.table(target.name)
        schema = mirror.schema()
        rows += validation.findings(target.name, db.kind, db.columns(name), db.nullable(name), db.primary_key(name), schema)
        if changed := validation.comment_changes(schema, db.column_comments(name)):
            mirror.with_column_comments(changed)
        if comment := db.table_comment(name):
            mirror.with_comment(comment)
    return validation.findings_frame(store.spark, rows)


def _arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewell")
    p.add_argument("job", choices=("snapshot", "stage", "load", "changes", "rounds", "land", "validate", "maintain"))
    p.add_argument("--env-file", default=".env")
    p.add_argument("--dag-id", default="tidewell")
    p.add_argument("--service", default="local", type=str.lower)
    p.add_argument("--tables", default="", help="comma-separated source tables")
    p.add_argument("--topics", default="", help="comma-separated topics")
    p.add_argument("--partitions", default=1, type=int)
    p.add_argument("--concurrency", default=3, type=int)
    p.add_argument("--interval", default=300.0, type=float, help="seconds from round to round")
    p.add_argument("--compaction-interval", default=14_400, type=int)
    p.add_argument("--starting-offsets", default=None, help="base64 JSON by topic")
    p.add_argument("--partition-columns", default="year,month,day")
    p.add_argument("--retention-days", default=7, type=int)
    p.add_argument("--orphan-older-than-days", default=3, type=int)
    p.add_argument("--schemas", default="", help="comma-separated namespaces")
    p.add_argument("--signal-root", default=None)
    p.add_argument("--checkpoint-root", default=None)
    return p


def _listed(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


def main(argv: Sequence[str] | None = None) -> int:
    a = _arguments().parse_args(argv)
    settings = Settings.load(a.env_file)
    spark = create_session(f"tidewell-{a.job}", settings, STREAMING if a.job in ("changes", "rounds", "land") else None)
    store = table_store(spark, settings)
    root = f"s3a://{settings.storage['bucket']}"
    if a.job in ("snapshot", "stage", "load", "validate"):
        d = settings.database
        kind = jdbc.DATABASES[d.get("type", "mysql")]
        db = kind.connect(spark, jdbc.Connection(d["host"], int(d["port"]), d["user"], d["password"]), d.get("name", ""))
        names = _listed(a.tables)
        if a.job == "validate":
            validate(db, store, a.service, names).show(1000, truncate=False)
            return 0
        for name in names:
            if a.job == "snapshot":
                snapshot(db, store, a.service, name, a.partitions)
            elif a.job == "stage":
                stage(db, settings.warehouse, name, a.partitions)
            else:
                parts = db.parts(name)
                load(spark, store, a.service, name, f"{settings.warehouse}/{parts[0]}/{parts[-1]}", db.primary_key(name))
        return 0
    if a.job == "maintain":
        m = Maintainer(spark, store, a.dag_id)
        m.ensure_ledgers()
        m.run_job(_listed(a.schemas), a.retention_days, a.orphan_older_than_days)
        return 0
    k = settings.kafka
    checkpoint = a.checkpoint_root or f"{root}/iceberg/checkpoint/{a.dag_id}"
    start = lambda t: streams.start_offsets(a.starting_offsets, t) or k.get("starting_offsets", "earliest")
    sources = {t: partial(lambda t: streams.kafka_stream(spark, k["bootstrap_servers"], t, int(k["max_offsets_per_trigger"]), start(t)), t) for t in _listed(a.topics)}
    registry = HttpRegistry(k["schema_registry"])
    signal = signals.StopSignal(spark, a.signal_root or f"{root}/spark/signal", a.dag_id)
    spark.streams.addListener(signals.StopListener(spark, signal))
    if a.job == "land":
        for t in sources:
            landing.start_landing(spark, registry, t, sources[t](), settings.warehouse, checkpoint, _listed(a.partition_columns))
        spark.streams.awaitAnyTermination()
        signal.clear()
        return 0
    sink = change_batches.ChangeSink(spark, store, registry, a.dag_id, a.service)
    sink.maintainer.ensure_ledgers()
    drain = lambda: change_batches.drain_topics(sink, sources, checkpoint, a.concurrency)
    compact = lambda: change_batches.compact_modified(sink, a.compaction_interval)
    if a.job == "changes":
        errors = drain()
        compact()
        code = 1 if errors else 0
    else:
        code = change_batches.run_rounds(
            drain, compact, signal.given, lambda s: signals.interruptible_sleep(s, signal.given), a.interval, failed=lambda: Files(spark, settings.warehouse).close_all()
        )
    signal.clear()
    return code


if __name__ == "__main__":
    sys.exit(main())
