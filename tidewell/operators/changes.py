"""Change-data operators: latest version of each key, upsert, delete and both at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(changes: DataFrame, key: str, *order: str) -> DataFrame:
    """Each key's row of the highest ``order``.

    The row-number filter lets the planner limit each task's rows of a key to one before the shuffle, so a key with a
    large part of all changes costs no more there than any other.
    """
    spec = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in order])
    return changes.withColumn("_version", F.row_number().over(spec)).where("_version = 1").drop("_version")


def upserts(changes: DataFrame, op: str = "op") -> DataFrame:
    """All but deletes; a row without an operation is neither."""
    return changes.where(F.col(op) != "d")


def deletes(changes: DataFrame, op: str = "op") -> DataFrame:
    return changes.where(F.col(op) == "d")


def upserted(target: DataFrame, source: DataFrame, *key: str) -> DataFrame:
    """``target`` with ``source``'s rows (one for each key) in the place of those of equal key, and added where there are none."""
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in target.columns], F.lit(True).alias("_s"))
    on = [target[k] == s[f"_s_{k}"] for k in key]
    joined = target.join(s, on, "full_outer")
    return joined.select(*[F.when(F.col("_s"), F.col(f"_s_{c}")).otherwise(target[c]).alias(c) for c in target.columns])


def deleted(target: DataFrame, gone: DataFrame, *key: str) -> DataFrame:
    """``target`` without rows whose key is in ``gone``; null keys equal nothing."""
    return target.join(gone.select(*key), list(key), "left_anti").select(*target.columns)


def applied(target: DataFrame, changes: DataFrame, key: str, op: str = "op") -> DataFrame:
    """``target`` after the latest ``changes`` (a row for each key): upserts and deletes in one full outer join."""
    s = changes.where(F.col(op).isNotNull()).select(*[F.col(c).alias(f"_s_{c}") for c in target.columns], F.col(op).alias("_op"))
    joined = target.join(s, target[key] == s[f"_s_{key}"], "full_outer").where("_op is null or _op <> 'd'")
    return joined.select(*[F.when(F.col("_op").isNotNull(), F.col(f"_s_{c}")).otherwise(target[c]).alias(c) for c in target.columns])


def batch_stats(batch: DataFrame, time: str = "timestamp", offset: str = "offset") -> DataFrame:
    """Rows, newest time as text and the range of offsets of a batch."""
    from tidewell.functions.cleansing import micros_text

    return batch.agg(
        F.count("*").alias("event_count"),
        micros_text(F.max(time)).alias("max_event_ts"),
        F.min(offset).alias("min_offset"),
        F.max(offset).alias("max_offset"),
    )


def by_schema_version(batch: DataFrame, column: str) -> list[int]:
    """The distinct schema ids of a batch in numeric order; nulls are no id."""
    return sorted(r[0] for r in batch.select(column).where(F.col(column).isNotNull()).distinct().collect())
