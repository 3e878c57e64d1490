"""Change streams landed as they are: decoded records in date-partitioned Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.cleansing import with_date_parts
from tidewell.operators.changes import by_schema_version
from tidewell.sources import avro
from tidewell.sources.registry import SchemaRegistry
from tidewell.streaming.change_batches import framed


def land_batch(registry: SchemaRegistry, batch: DataFrame, path: str, parts: Sequence[str] = ("year", "month", "day")) -> int:
    """Append a batch's whole envelopes below ``path``, one write per schema version; how many versions there were.

    Keys are ignored and nothing is made distinct; appends are at least once.
    """
    batch = batch.persist()
    try:
        rows = framed(batch)
        versions = by_schema_version(rows, "value_schema_id")
        for v in versions:
            own = rows.where(F.col("value_schema_id") == v).select("value", "timestamp")
            opened = avro.decoded(own, "value", registry.schema(v), "v").select("v.*", "timestamp")
            with_date_parts(opened, "timestamp", parts, drop=True).write.partitionBy(*parts).mode("append").parquet(path)
        return len(versions)
    finally:
        batch.unpersist()


def start_landing(spark: SparkSession, registry: SchemaRegistry, topic: str, stream: DataFrame, warehouse: str, checkpoint: str, parts: Sequence[str] = ("year", "month", "day"), every: str | None = "1 minutes"):
    """An always-on query for a topic (``every`` None: what is there, then stop)."""

    def each(batch: DataFrame, _: int) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", topic)
        land_batch(registry, batch, f"{warehouse.rstrip('/')}/{topic}", parts)

    writer = stream.writeStream.foreachBatch(each).queryName(topic).option("checkpointLocation", f"{checkpoint.rstrip('/')}/{topic}")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
