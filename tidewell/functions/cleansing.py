"""Column work of the ingestion paths: keys, trimming, zones, audit and partition columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, AUDIT, AUDIT_BEFORE = "id_iceberg", "last_applied_date", "update_ts_dms"
# Partition column -> date pattern.
DATE_PARTS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}


def surrogate_key(columns: Sequence[Column | str]) -> Column:
    """md5 of the key columns' text joined by ``|``; nulls are skipped, as the mirrors' existing ids have it."""
    return F.md5(F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]))


def trim_strings(df: DataFrame) -> DataFrame:
    """Strings without spaces (U+0020 alone) at their ends; one projection, other types untouched."""
    return df.select(*[F.trim(df[f.name]).alias(f.name) if isinstance(f.dataType, T.StringType) else df[f.name] for f in df.schema.fields])


def timestamps_to_utc(df: DataFrame, zone: str = "UTC") -> DataFrame:
    """Timestamps (not those without zone) of wall clocks in ``zone`` as UTC."""
    return df.select(*[F.to_utc_timestamp(df[f.name], zone).alias(f.name) if isinstance(f.dataType, T.TimestampType) else df[f.name] for f in df.schema.fields])


def with_audit(df: DataFrame, at: Column | None = None, name: str = AUDIT) -> DataFrame:
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def renamed_audit(df: DataFrame, at: Column | None = None) -> DataFrame:
    """The staging audit column under its mirror name, or a new one where staging had none."""
    return df.withColumnRenamed(AUDIT_BEFORE, AUDIT) if AUDIT_BEFORE in df.columns else with_audit(df, at)


def with_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` with the surrogate key of ``key``; as it is where there is no key."""
    return df.withColumn(KEY, surrogate_key(key)) if key else df


def with_date_parts(df: DataFrame, column: str, parts: Sequence[str] = ("year", "month", "day"), drop: bool = False) -> DataFrame:
    """Text partition columns of a timestamp."""
    unknown = [p for p in parts if p not in DATE_PARTS]
    if unknown:
        raise ValueError(f"unknown partition columns: {unknown}")
    out = df.withColumns({p: F.date_format(column, DATE_PARTS[p]) for p in parts})
    return out.drop(column) if drop else out


def micros_text(column: Column | str) -> Column:
    """A timestamp as text with six digits of fraction."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``schema``'s columns, in its order and types; others go, a missing one is an analysis error."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
