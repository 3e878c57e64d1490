"""A snapshot store: mirror tables as versioned Parquet with atomic commits, where no table format with row-level DML is.

A table is a folder.  Data folders are immutable; a version is a small manifest that lists those it consists of, and the
newest manifest is the table.  A commit creates the next manifest, which fails if another writer was faster: rewrites then
raise, appends try again.  Readers of a version aren't disturbed by later ones until it is expired.

A batch of changes is written as a delta beside the data and merged by who reads, so a batch costs what it holds and not
what the table does.  Deltas are folded into the data by compaction, by any rewrite, and by the batch that finds too many.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import changes as change_ops
from tidewell.operators import ledger
from tidewell.sources.files import Files, switched

RETRIES, WAIT_S = 20, 0.2
#: Deltas, and bytes of deltas that outweigh the data, from which on a batch of changes folds them.
MAX_DELTAS, FOLD_BYTES = 16, 256 << 20


class CommitConflict(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Version:
    number: int
    parts: tuple[str, ...]
    schema: T.StructType
    committed_ms: int
    operation: str
    properties: dict
    deltas: tuple[str, ...] = ()
    key: str | None = None

    @property
    def folders(self) -> tuple[str, ...]:
        return (*self.parts, *self.deltas)


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)

    def _manifests(self) -> list[int]:
        names = (e.path.rsplit("/", 1)[-1] for e in self.files.entries(f"{self.path}/_versions"))
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def exists(self) -> bool:
        return bool(self._manifests())

    def version(self, number: int | None = None) -> Version:
        if number is None:
            known = self._manifests()
            if not known:
                raise LookupError(f"no table at {self.path}")
            number = known[-1]
        m = json.loads(self.files.read(f"{self.path}/_versions/v{number:012d}.json"))
        return Version(number, tuple(m["parts"]), T.StructType.fromJson(m["schema"]), m["committed_ms"], m["operation"], m["properties"], tuple(m.get("deltas", ())), m.get("key"))

    def history(self) -> list[Version]:
        return [self.version(n) for n in self._manifests()]

    def schema(self) -> T.StructType:
        return self.version().schema

    def properties(self) -> dict:
        return self.version().properties

    def _data(self, parts: tuple[str, ...], schema: T.StructType) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/data/{p}" for p in parts])

    def read(self, number: int | None = None) -> DataFrame:
        v = self.version(number)
        rows = self._data(v.parts, v.schema)
        if not v.deltas:
            return rows
        delta = self._data(v.deltas, T.StructType([*v.schema.fields, T.StructField("_op", T.StringType()), T.StructField("_seq", T.LongType())]))
        # deltas are small beside the data: the join is of their keys, and where these fit a broadcast no row of data moves
        latest = delta if len(v.deltas) == 1 else change_ops.latest_per_key(delta.where(F.col(v.key).isNotNull()), v.key, "_seq").unionByName(delta.where(F.col(v.key).isNull()))
        return change_ops.deleted(rows, latest, v.key).unionByName(change_ops.upserts(latest, "_op").select(*v.schema.fieldNames()))

    def _write(self, df: DataFrame) -> str:
        part = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{part}")
        return part

    def _commit(
        self, number: int, parts: tuple[str, ...], schema: T.StructType, operation: str, properties: dict, deltas: tuple[str, ...] = (), key: str | None = None
    ) -> Version:
        committed = int(time.time() * 1000)
        held = {"parts": parts, "schema": schema.jsonValue(), "committed_ms": committed, "operation": operation, "properties": properties, "deltas": deltas, "key": key}
        if not self.files.create(f"{self.path}/_versions/v{number:012d}.json", json.dumps(held)):
            raise CommitConflict(f"version {number} of {self.path} was committed by another writer")
        return Version(number, parts, schema, committed, operation, properties, deltas, key)

    def replace(self, df: DataFrame, properties: dict | None = None) -> Version:
        """Create the table or replace all of it, schema included."""
        known = self._manifests()
        schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema.fields])
        return self._commit((known[-1] if known else 0) + 1, (self._write(df),), schema, "replace", properties or {})

    def create(self, schema: T.StructType, properties: dict | None = None) -> None:
        """An empty table, if there is none."""
        if not self.exists():
            try:
                self._commit(1, (), schema, "create", properties or {})
            except CommitConflict:
                pass

    def append(self, df: DataFrame, **properties: str) -> Version:
        """Add rows, and set properties with them.  Rows may not be older than a delta, so deltas are folded first."""
        v = self.version()
        if v.deltas:
            self.rewrite(lambda t: t, "fold")
        part = self._write(df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in v.schema.fields]))
        for attempt in range(RETRIES):
            v = self.version()
            try:
                return self._commit(v.number + 1, (*v.parts, part), v.schema, "append", {**v.properties, **properties})
            except CommitConflict:
                if attempt == RETRIES - 1:
                    raise
                time.sleep(WAIT_S * (attempt + 1))
        raise AssertionError

    def append_once(self, df: DataFrame, name: str, token: str) -> bool:
        """:func:`append`, unless ``token`` is what the last such append under ``name`` had; the token is part of the commit."""
        if self.properties().get(name) == token:
            return False
        self.append(df, **{name: token})
        return True

    def rewrite(self, change: Callable[[DataFrame], DataFrame], operation: str) -> Version:
        """Replace the rows by a function of them, in one commit against the version that was read."""
        v = self.version()
        return self._commit(v.number + 1, (self._write(change(self.read(v.number))),), v.schema, operation, v.properties)

    def apply_changes(self, latest: DataFrame, key: str, op: str = "op") -> Version:
        """Upserts and deletes of ``latest`` (a row for each key) in one commit, as a delta; rows without ``op`` are neither."""
        v = self.version()
        sizes = [sum(self._data_files(p)) for p in (v.parts, v.deltas)]
        if v.key not in (None, key) or len(v.deltas) + 1 >= MAX_DELTAS or sizes[1] > max(sizes[0], FOLD_BYTES):
            return self.rewrite(lambda t: change_ops.applied(t, latest, key, op), "apply")
        columns = [latest[f.name].cast(f.dataType).alias(f.name) for f in v.schema.fields]
        delta = latest.where(F.col(op).isNotNull()).select(*columns, latest[op].alias("_op"), F.lit(v.number + 1).cast("long").alias("_seq"))
        return self._commit(v.number + 1, v.parts, v.schema, "apply", v.properties, (*v.deltas, self._write(delta)), key)

    def purge(self, group: Sequence[str], time_: str, days: int) -> Version:
        """Drop rows older than ``days``, but for each group's newest."""
        cutoff = F.current_timestamp() - F.expr(f"INTERVAL {int(days)} DAYS")
        return self.rewrite(lambda t: ledger.kept_rows(t, group, time_, cutoff), "purge")

    def upsert(self, source: DataFrame, *key: str) -> Version:
        return self.rewrite(lambda t: change_ops.upserted(t, source, *key), "upsert")

    def delete(self, gone: DataFrame, *key: str) -> Version:
        return self.rewrite(lambda t: change_ops.deleted(t, gone, *key), "delete")

    def update(self, condition: Column, **values: Column) -> Version:
        """Set columns where ``condition`` holds (a null condition doesn't)."""
        hit = F.coalesce(condition, F.lit(False))
        return self.rewrite(lambda t: t.select(*[F.when(hit, values[c]).otherwise(t[c]).alias(c) if c in values else t[c] for c in t.columns]), "update")

    def with_properties(self, **properties: str) -> Version:
        v = self.version()
        return self._commit(v.number + 1, v.parts, v.schema, "properties", {**v.properties, **properties}, v.deltas, v.key)

    def with_column_comments(self, comments: dict[str, str]) -> Version:
        v = self.version()
        fields = [T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, **({"comment": comments[f.name]} if f.name in comments else {})}) for f in v.schema.fields]
        return self._commit(v.number + 1, v.parts, T.StructType(fields), "comments", v.properties, v.deltas, v.key)

    def with_comment(self, comment: str) -> None:
        if self.properties().get("comment") != comment:
            self.with_properties(comment=comment)

    # maintenance
    def _data_files(self, parts: tuple[str, ...]) -> list[int]:
        return [e.size for p in parts for e in self.files.entries(f"{self.path}/data/{p}") if "/part-" in e.path]

    def compact(self, target_bytes: int = 128 << 20) -> tuple[int, int]:
        """Fold deltas and gather small files: (files rewritten, files written); (0, 0) if there is nothing to gain."""
        v = self.version()
        sizes = self._data_files(v.folders)
        wanted = max(1, -(-sum(sizes) // target_bytes))
        if len(sizes) <= wanted and not v.deltas:
            return 0, 0
        part = self._write(self.read(v.number).coalesce(wanted))
        self._commit(v.number + 1, (part,), v.schema, "compact", v.properties)
        return len(sizes), len(self._data_files((part,)))

    def expire(self, older_than_ms: int, keep: int = 1) -> int:
        """Forget versions committed before ``older_than_ms``, but for the newest ``keep``, and delete data no other lists."""
        history = self.history()
        gone = [v for v in history[:-keep] if v.committed_ms < older_than_ms]
        held = {p for v in history if v not in gone for p in v.folders}
        for v in gone:
            self.files.delete(f"{self.path}/_versions/v{v.number:012d}.json")
        for p in {p for v in gone for p in v.folders} - held:
            self.files.delete(f"{self.path}/data/{p}")
        return len(gone)

    def compact_deletes(self) -> tuple[int, int] | None:
        """None: there are no delete files beside deltas, which compaction folds."""
        return None

    def remove_orphans(self, older_than_ms: int) -> list[str]:
        """Delete data folders that no version lists and that are older than the cutoff (a running writer's are younger)."""
        held = {p for v in self.history() for p in v.folders}
        gone = [e.path for e in self.files.entries(f"{self.path}/data") if e.path.rsplit("/", 1)[-1] not in held and e.modified_ms < older_than_ms]
        for path in gone:
            self.files.delete(path)
        return gone

    def drop(self) -> None:
        self.files.delete(self.path)


class SnapshotStore:
    """Tables ``namespace.table`` below a warehouse folder."""

    def __init__(self, spark: SparkSession, warehouse: str) -> None:
        self.spark, self.warehouse = spark, warehouse.rstrip("/")

    def table(self, name: str) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.warehouse}/{name.replace('.', '/')}")

    def tables(self, namespaces: list[str]) -> list[str]:
        """Names of the tables in ``namespaces`` (trimmed, lower-cased); a missing namespace has none."""
        files = Files(self.spark, self.warehouse)
        found = []
        for n in namespaces:
            n = n.strip().lower()
            names = [e.path.rsplit("/", 1)[-1] for e in files.entries(f"{self.warehouse}/{n}") if e.is_dir]
            found += [f"{n}.{t}" for t in sorted(names) if self.table(f"{n}.{t}").exists()]
        return found

    def rename(self, old: str, new: str) -> None:
        files = Files(self.spark, self.warehouse)
        target = self.table(new).path
        self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        files._fs.mkdirs(files._path(target).getParent())
        if not files.rename(self.table(old).path, target):
            raise RuntimeError(f"{old} can't be renamed to {new}")

    def copy(self, name: str, to: SnapshotStore, new: str | None = None) -> Version:
        """Copy a table's rows, schema and properties to another store."""
        v = self.table(name).version()
        return to.table(new or name).replace(self.table(name).read(), v.properties)


def copy_across(name: str, source, target, staging: str, credentials: Mapping[str, str], new: str | None = None) -> None:
    """Copy a table between stores that need different credentials, by way of Parquet in ``staging``, which both reach.

    The rows are staged under the present credentials; then ``credentials`` (system properties of the driver's JVM, as the
    object stores' default provider reads them) are set, cached file systems are dropped, and the table is created or
    replaced.  The properties are as before in the end, also where that fails.
    """
    spark = source.spark
    properties = dict(source.table(name).properties())
    path = f"{staging.rstrip('/')}/{uuid.uuid4().hex}"
    source.table(name).read().write.parquet(path)
    with switched(spark, credentials):
        target.table(new or name).replace(spark.read.parquet(path), properties)
    Files(spark, path).delete(path)
