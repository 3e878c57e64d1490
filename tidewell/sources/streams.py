"""Change streams in Kafka's column layout: key, value (binary), topic, partition, offset, timestamp."""

from __future__ import annotations

import base64
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The columns of a record.
RECORD = "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"


def start_offsets(text: str | None, topic: str) -> str | None:
    """A topic's start from a base64 JSON map, whose values may be offset maps or their text; None if it has none.

    Only a fresh checkpoint heeds it.
    """
    if not text:
        return None
    given = json.loads(base64.b64decode(text)).get(topic)
    if given is None:
        return None
    offsets = json.loads(given) if isinstance(given, str) and given.lstrip().startswith("{") else given
    if isinstance(offsets, str):
        return offsets  # earliest or latest
    return json.dumps({topic: offsets if topic not in offsets else offsets[topic]})


def kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets: int, starting: str = "earliest", options: Mapping[str, str] | None = None) -> DataFrame:
    """One topic from Kafka; needs the connector's jar."""
    settings = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": str(max_offsets), "failOnDataLoss": "false"}
    return spark.readStream.format("kafka").options(**settings, **(options or {})).load()


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Records in Parquet files that arrive in a folder."""
    reader = spark.readStream.schema(RECORD)
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(path)
