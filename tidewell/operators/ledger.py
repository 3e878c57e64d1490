"""The operations ledger: progress rows of change batches and of maintenance, their retention and what they decide."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ledgers' columns.
CHANGE_LEDGER = (
    "dag_id string, iceberg_schema string, table_name string, scheduled_at timestamp, max_event_ts timestamp, processed_at timestamp, "
    "min_offset bigint, max_offset bigint, event_count bigint, processing_duration_sec double, batch_id bigint"
)
MAINTENANCE_LEDGER = (
    "dag_id string, iceberg_schema string, table_name string, procedure_type string, started_at timestamp, completed_at timestamp, "
    "duration_sec double, status string, error_message string, rewritten_files_count bigint, added_files_count bigint, batch_id bigint"
)
CHANGE_GROUP = ("dag_id", "iceberg_schema", "table_name")
MAINTENANCE_GROUP = (*CHANGE_GROUP, "procedure_type")
COMPACTION_INTERVAL = 14_400


def ledger_rows(spark: SparkSession, schema: str, rows: Sequence[dict]) -> DataFrame:
    """Ledger rows from values, never from SQL text; what a row lacks is null."""
    names = [c.split()[0] for c in schema.split(", ")]
    unknown = {k for r in rows for k in r} - set(names)
    if unknown:
        raise ValueError(f"not ledger columns: {sorted(unknown)}")
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def kept_rows(ledger: DataFrame, group: Sequence[str], time: str, cutoff: Column) -> DataFrame:
    """``ledger`` without rows older than ``cutoff``, but for each group's newest (all of a tie).

    It is what ``DELETE ... WHERE time < cutoff AND (group, time) NOT IN (SELECT group, max(time) ...)`` leaves, nulls
    included: a null in a group column can't be told apart, so such a newest row shields others of its time.  The join is
    hashed on the time; rows within retention don't take part in it.
    """
    newest = ledger.groupBy(*group).agg(F.max(time).alias("_newest")).select(*[F.col(g).alias(f"_{g}") for g in group], "_newest")
    old = ledger.where(F.col(time) < cutoff)
    alike = [F.col(g).isNull() | F.col(f"_{g}").isNull() | (F.col(g) == F.col(f"_{g}")) for g in group]
    shielded = old.join(newest, [F.col(time) == F.col("_newest"), *alike], "left_semi")
    return ledger.where(F.col(time).isNull() | (F.col(time) >= cutoff)).unionByName(shielded)


def last_success(ledger: DataFrame, group: Sequence[str], time: str, done: Column) -> DataFrame:
    """Each group's newest time among rows that are ``done``."""
    return ledger.where(done).groupBy(*group).agg(F.max(time).alias("last_completed"))


def due(last: Column, now: Column, interval_sec: int) -> Column:
    """Whether ``interval_sec`` whole seconds have passed since ``last``; never run is due."""
    seconds = lambda t: F.unix_timestamp(t.cast("timestamp"))
    return last.isNull() | (seconds(now) - seconds(last) >= interval_sec)


def should_run(last: datetime | None, interval_sec: int, now: datetime | None = None) -> bool:
    """:func:`due` for one table on the driver; a time without zone is UTC."""
    if last is None:
        return True
    aware = lambda t: t if t.tzinfo else t.replace(tzinfo=UTC)
    return (aware(now or datetime.now(UTC)) - aware(last)).total_seconds() >= interval_sec


def merged(ledger: DataFrame, rows: DataFrame, group: Sequence[str] = CHANGE_GROUP) -> DataFrame:
    """The ledger after an upsert of ``rows`` on the group columns."""
    from tidewell.operators.changes import upserted

    return upserted(ledger, rows, *group)
