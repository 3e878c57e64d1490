"""Statements for tables of a catalog with row-level DML (Apache Iceberg's Spark extensions).

``IcebergStore`` and ``IcebergTable`` have the methods of :class:`tidewell.operators.store.SnapshotStore` and its tables that
sinks, maintenance and jobs use, so these take either.  Running the statements needs the extension's jar, which this
repository doesn't ship; tests record which statements run, and in what order.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewell.functions.naming import checked
from tidewell.sources.tables import discover

# Table properties; the last three go with tables that changes are applied to.
PROPERTIES = {"format-version": "2", "write.spark.accept-any-schema": "false"}
KEYED_PROPERTIES = {
    "write.metadata.delete-after-commit.enabled": "true",
    "write.metadata.previous-versions-max": "5",
    "history.expire.max-snapshot-age-ms": "86400000",
}
#: Ledgers are appended to by many writers at once.
SHARED_PROPERTIES = {"commit.retry.num-retries": "20", "commit.retry.min-wait-ms": "200"}


def qualified(name: str) -> str:
    return ".".join(f"`{checked(p)}`" for p in name.split("."))


def merge_sql(target: str, source: str, key: list[str]) -> str:
    on = " AND ".join(f"t.`{checked(k)}` = s.`{k}`" for k in key)
    return f"MERGE INTO {qualified(target)} t USING {source} s ON {on} WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"


def delete_sql(target: str, source: str, key: list[str]) -> str:
    on = " AND ".join(f"t.`{checked(k)}` = s.`{k}`" for k in key)
    return f"DELETE FROM {qualified(target)} t WHERE EXISTS (SELECT 1 FROM {source} s WHERE {on})"


def purge_sql(ledger: str, group: list[str], time: str, days: int) -> str:
    names = ", ".join(checked(g) for g in group)
    t = checked(time)
    return (
        f"DELETE FROM {qualified(ledger)} WHERE {t} < current_timestamp() - INTERVAL {int(days)} DAYS "
        f"AND ({names}, {t}) NOT IN (SELECT {names}, max({t}) FROM {qualified(ledger)} GROUP BY {names})"
    )


def procedure_sql(catalog: str, procedure: str, table: str, **arguments: str) -> str:
    given = "".join(f", {checked(k)} => {v}" for k, v in arguments.items())
    return f"CALL {checked(catalog)}.system.{checked(procedure)}(table => '{table}'{given})"


def timestamp_sql(at: datetime) -> str:
    return f"TIMESTAMP '{at.astimezone(UTC):%Y-%m-%d %H:%M:%S}'"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


class IcebergTable:
    """A table reached by SQL; a change batch is two commits, upserts and then deletes."""

    def __init__(self, spark: SparkSession, catalog: str, name: str, location: str | None = None) -> None:
        self.spark, self.catalog, self.name, self.location = spark, catalog, name, location
        self.full = f"{catalog}.{name}"

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.full)

    def read(self) -> DataFrame:
        return self.spark.table(self.full)

    def metadata(self, kind: str) -> DataFrame:
        """The ``history``, ``snapshots``, ``manifests`` or ``files`` of the table."""
        return self.spark.table(f"{self.full}.{checked(kind)}")

    def stream(self, from_ms: int = 0, max_rows: int = 100) -> DataFrame:
        """Rows appended since a time, as a stream."""
        options = {
            "stream-from-timestamp": str(from_ms), "streaming-skip-overwrite-snapshots": "true", "streaming-skip-delete-snapshots": "true",
            "streaming-max-rows-per-micro-batch": str(max_rows),
        }
        return self.spark.readStream.format("iceberg").options(**options).load(self.full)

    def schema(self) -> T.StructType:
        return self.read().schema

    def properties(self) -> dict[str, str]:
        return {r[0]: r[1] for r in self.spark.sql(f"SHOW TBLPROPERTIES {qualified(self.full)}").collect()}

    def _namespace(self) -> None:
        namespace = self.name.split(".")[0]
        where = f" LOCATION '{self.location}/{namespace}'" if self.location else ""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified(f'{self.catalog}.{namespace}')}{where}")

    def replace(self, df: DataFrame, properties: Mapping[str, str] | None = None) -> None:
        """Create the table or replace all of it; one with a ``key`` property is one that changes are applied to."""
        self._namespace()
        writer = df.writeTo(self.full).using("iceberg")
        own = dict(properties or {})
        for k, v in (PROPERTIES | (KEYED_PROPERTIES if own.get("key") else {}) | own).items():
            writer = writer.tableProperty(k, v)
        writer.createOrReplace()

    def create(self, schema: T.StructType, properties: Mapping[str, str] | None = None) -> None:
        """An empty table, if there is none."""
        self._namespace()
        columns = ", ".join(f"`{checked(f.name)}` {f.dataType.simpleString()}" for f in schema.fields)
        given = ", ".join(f"'{k}' = '{v}'" for k, v in (PROPERTIES | SHARED_PROPERTIES | dict(properties or {})).items())
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {qualified(self.full)} ({columns}) USING iceberg TBLPROPERTIES ({given})")

    def append(self, df: DataFrame) -> None:
        df.writeTo(self.full).append()

    def append_once(self, df: DataFrame, name: str, token: str) -> bool:
        """:func:`append`, unless the last such append under ``name`` had the same ``token``.  The token is a property of the
        table, set after the rows: a failure in between can repeat them."""
        if self.properties().get(name) == token:
            return False
        self.append(df)
        self.spark.sql(f"ALTER TABLE {qualified(self.full)} SET TBLPROPERTIES ({_quoted(name)} = {_quoted(token)})")
        return True

    def purge(self, group: Sequence[str], time_: str, days: int) -> None:
        """Drop rows older than ``days``, but for each group's newest."""
        self.spark.sql(purge_sql(self.full, list(group), time_, days))

    def with_column_comments(self, comments: Mapping[str, str]) -> None:
        for c, text in comments.items():
            self.spark.sql(f"ALTER TABLE {qualified(self.full)} ALTER COLUMN `{checked(c)}` COMMENT {_quoted(text)}")

    def with_comment(self, comment: str) -> None:
        if self.properties().get("comment") != comment:
            self.spark.sql(f"ALTER TABLE {qualified(self.full)} SET TBLPROPERTIES ('comment' = {_quoted(comment)})")

    def apply_changes(self, latest: DataFrame, key: str, op: str = "op") -> None:
        """Upserts, then deletes: two commits, each left out where it has no rows.  The views are global, since a stream's
        batches live in a session of their own."""
        view = f"changes_{uuid.uuid4().hex}"
        latest = latest.persist()
        try:
            for rows, statement in ((latest.where(f"{op} <> 'd'").drop(op), merge_sql), (latest.where(f"{op} = 'd'").select(key), delete_sql)):
                if not rows.isEmpty():
                    rows.createOrReplaceGlobalTempView(view)
                    self.spark.sql(statement(self.full, f"global_temp.{view}", [key]))
        finally:
            latest.unpersist()
            self.spark.catalog.dropGlobalTempView(view)

    def _counts(self, statement: str, rewritten: str, added: str) -> tuple[int, int]:
        row = self.spark.sql(statement).first()
        return (row[rewritten], row[added]) if row else (0, 0)

    def compact(self) -> tuple[int, int]:
        return self._counts(procedure_sql(self.catalog, "rewrite_data_files", self.name), "rewritten_data_files_count", "added_data_files_count")

    def compact_deletes(self) -> tuple[int, int]:
        sql = procedure_sql(self.catalog, "rewrite_position_delete_files", self.name)
        return self._counts(sql, "rewritten_delete_files_count", "added_delete_files_count")

    def rewrite_manifests(self) -> None:
        self.spark.sql(procedure_sql(self.catalog, "rewrite_manifests", self.name))

    def expire(self, older_than_ms: int | None = None, keep: int | None = None) -> int:
        """Drop old snapshots; the files deleted."""
        at = {"older_than": timestamp_sql(datetime.fromtimestamp(older_than_ms / 1000, UTC))} if older_than_ms else {}
        last = {"retain_last": str(int(keep))} if keep else {}
        row = self.spark.sql(procedure_sql(self.catalog, "expire_snapshots", self.name, **at, **last)).first()
        return row["deleted_data_files_count"] if row else 0

    def remove_orphans(self, older_than_ms: int | None = None, days: int = 3) -> list[str]:
        at = datetime.fromtimestamp(older_than_ms / 1000, UTC) if older_than_ms else datetime.now(UTC) - timedelta(days=days)
        rows = self.spark.sql(procedure_sql(self.catalog, "remove_orphan_files", self.name, older_than=timestamp_sql(at))).collect()
        return [r[0] for r in rows]


class IcebergStore:
    """Tables ``namespace.table`` of a catalog, with new namespaces below ``location``."""

    def __init__(self, spark: SparkSession, catalog: str, location: str | None = None) -> None:
        self.spark, self.catalog, self.location = spark, checked(catalog), location

    def table(self, name: str) -> IcebergTable:
        return IcebergTable(self.spark, self.catalog, name, self.location)

    def tables(self, namespaces: list[str]) -> list[str]:
        """Names of the tables in ``namespaces`` (trimmed, lower-cased); one that can't be listed has none."""
        return discover(self.spark, namespaces, self.catalog)
