"""Spark event logs as tables.

Lines are read as text and parsed against a fixed schema of the fields the reports use, in one pass: there is no inference
(which stumbles over names that differ in case alone), and a malformed line is passed over.
"""

from __future__ import annotations

import gzip
import io
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The events' fields.
_TASK = "`Task ID` long, `Launch Time` long, `Finish Time` long, `Failed` boolean, `Executor ID` string"
_METRICS = (
    "`Executor Run Time` long, `Executor CPU Time` long, `JVM GC Time` long, `Result Serialization Time` long, `Executor Deserialize Time` long, "
    "`Peak Execution Memory` long, `Memory Bytes Spilled` long, `Disk Bytes Spilled` long, `Input Metrics` struct<`Bytes Read`: long>, "
    "`Shuffle Read Metrics` struct<`Remote Bytes Read`: long, `Local Bytes Read`: long, `Fetch Wait Time`: long>, "
    "`Shuffle Write Metrics` struct<`Shuffle Bytes Written`: long>"
)
_STRUCT = lambda fields: "struct<" + fields.replace("` ", "`: ") + ">"
SCHEMA = (
    "`Event` string, `Timestamp` long, `Job ID` long, `Submission Time` long, `Completion Time` long, `Properties` map<string, string>, "
    "`executionId` long, `description` string, `time` long, `Stage ID` long, `Executor ID` string, `Maximum Memory` long, "
    f"`Task Info` {_STRUCT(_TASK)}, `Task Metrics` {_STRUCT(_METRICS)}, "
    "`Executor Info` struct<`Host`: string, `Total Cores`: int>, `Block Manager ID` struct<`Executor ID`: string>, "
    "`Spark Properties` map<string, string>, `id` string, `runId` string, `name` string, `exception` string, "
    "`progress` struct<`runId`: string, `batchId`: long, `numInputRows`: long>"
)
_PREFIX = "SparkListener"
_SQL = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
_STREAM = "org.apache.spark.sql.streaming.StreamingQueryListener$Query"


#: Endings of the compressed files that Spark writes and archives hold; none of them can be split.
COMPRESSED = (".zstd", ".zst", ".gz")
#: Characters of the lines that a worker hands over at once.
BATCH = 4 << 20


def _unpacked(path: str, content: pa.Scalar) -> io.BufferedIOBase:
    stream = pa.BufferReader(content.as_buffer())
    if path.endswith(".gz"):
        return gzip.GzipFile(fileobj=stream)
    return io.BufferedReader(zstandard.ZstdDecompressor().stream_reader(stream, read_across_frames=True))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole compressed files; a file is decoded as it is read, so only its compressed bytes are held."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            stream = _unpacked(path, content)
            while held := stream.readlines(BATCH):
                yield pa.RecordBatch.from_arrays([pa.array([x.decode("utf-8", "replace") for x in held])], ["value"])


def read(spark: SparkSession, path: str, pattern: str = "events_*") -> DataFrame:
    """The events of a file or a rolling log's folder.

    Plain files are split as usual.  A compressed one (``COMPRESSED``, optionally with ``.compact`` behind) is one task,
    since its middle can't be found; Spark's rolling logs bound such files.  Without any file the result is empty.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern or "*").load(path)
    names = [r[0] for r in found.select("path").collect()]  # the files of one application's log
    packed = [n for n in names if n.removesuffix(".compact").endswith(COMPRESSED)]
    plain = [n for n in names if n not in set(packed)]
    lines = spark.createDataFrame([], "value string")
    if plain:
        lines = lines.unionByName(spark.read.text([_quoted(n) for n in plain]))
    if packed:
        whole = spark.read.format("binaryFile").load([_quoted(n) for n in packed])
        lines = lines.unionByName(whole.select(F.regexp_replace("path", r"\.compact$", "").alias("path"), "content").mapInArrow(_lines, "value string"))
    return lines.select(F.from_json("value", SCHEMA, {"mode": "PERMISSIVE"}).alias("e")).select("e.*").where("`Event` is not null")


def _quoted(name: str) -> str:
    """A listed path as a pattern that only it matches."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in name)


def _of(events: DataFrame, name: str) -> DataFrame:
    return events.where(F.col("Event") == name)


def jobs(events: DataFrame) -> DataFrame:
    """job_id, pool, description, group_id, start_ms, end_ms (null if it didn't end)."""
    p = F.col("Properties")
    start = _of(events, f"{_PREFIX}JobStart").select(
        F.col("Job ID").alias("job_id"), F.coalesce(p["spark.scheduler.pool"], F.lit("default")).alias("pool"), p["spark.job.description"].alias("description"),
        p["spark.jobGroup.id"].alias("group_id"), F.col("Submission Time").alias("start_ms"),
    )
    end = _of(events, f"{_PREFIX}JobEnd").select(F.col("Job ID").alias("job_id"), F.col("Completion Time").alias("end_ms"))
    return start.join(end, "job_id", "left")


def executions(events: DataFrame) -> DataFrame:
    """SQL executions that ended: execution_id, description, start_ms, duration."""
    start = _of(events, f"{_SQL}Start").select(F.col("executionId").alias("execution_id"), "description", F.col("time").alias("start_ms"))
    end = _of(events, f"{_SQL}End").select(F.col("executionId").alias("execution_id"), F.col("time").alias("end_ms"))
    return start.join(end, "execution_id").select("execution_id", "description", "start_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration"))


def tasks(events: DataFrame) -> DataFrame:
    """All tasks that ended, failed ones with ``failed``."""
    i, m = "`Task Info`", "`Task Metrics`"
    at = lambda path: F.coalesce(F.col(path), F.lit(0))
    read_ = f"{m}.`Shuffle Read Metrics`"
    return _of(events, f"{_PREFIX}TaskEnd").select(
        F.col("Stage ID").alias("stage_id"), F.col(f"{i}.`Executor ID`").alias("executor_id"), F.coalesce(f"{i}.Failed", F.lit(False)).alias("failed"),
        (F.col(f"{i}.`Finish Time`") - F.col(f"{i}.`Launch Time`")).alias("duration"), at(f"{m}.`Executor Run Time`").alias("run_ms"),
        F.floor(at(f"{m}.`Executor CPU Time`") / 1_000_000).alias("cpu_ms"), at(f"{m}.`JVM GC Time`").alias("gc_ms"), at(f"{m}.`Result Serialization Time`").alias("ser_ms"),
        at(f"{m}.`Executor Deserialize Time`").alias("deser_ms"), at(f"{read_}.`Fetch Wait Time`").alias("fetch_wait_ms"), at(f"{m}.`Peak Execution Memory`").alias("peak_memory"),
        at(f"{m}.`Disk Bytes Spilled`").alias("disk_spill"), at(f"{m}.`Memory Bytes Spilled`").alias("memory_spill"), at(f"{m}.`Input Metrics`.`Bytes Read`").alias("input_bytes"),
        (at(f"{read_}.`Remote Bytes Read`") + at(f"{read_}.`Local Bytes Read`")).alias("shuffle_read"), at(f"{m}.`Shuffle Write Metrics`.`Shuffle Bytes Written`").alias("shuffle_write"),
    )


def executors(events: DataFrame) -> DataFrame:
    """executor_id, host, cores, added_ms, memory (null without a block manager)."""
    added = _of(events, f"{_PREFIX}ExecutorAdded").select(
        F.col("Executor ID").alias("executor_id"), F.col("Executor Info.Host").alias("host"), F.col("Executor Info.`Total Cores`").alias("cores"), F.col("Timestamp").alias("added_ms")
    )
    return added.join(block_managers(events), "executor_id", "left")


def block_managers(events: DataFrame) -> DataFrame:
    found = _of(events, f"{_PREFIX}BlockManagerAdded").select(F.col("Block Manager ID.`Executor ID`").alias("executor_id"), F.col("Maximum Memory").alias("memory"))
    return found.groupBy("executor_id").agg(F.max("memory").alias("memory"))


def application_span(events: DataFrame) -> DataFrame:
    """start_ms and end_ms of the application; end is 0 where it didn't end."""
    is_ = lambda name: F.col("Event") == f"{_PREFIX}{name}"
    return events.agg(
        F.coalesce(F.min(F.when(is_("ApplicationStart"), F.col("Timestamp"))), F.min(F.when(is_("ExecutorAdded"), F.col("Timestamp"))), F.lit(0)).alias("start_ms"),
        F.coalesce(F.max(F.when(is_("ApplicationEnd"), F.col("Timestamp"))), F.lit(0)).alias("end_ms"),
    )


def streaming_queries(events: DataFrame) -> DataFrame:
    """run_id, name, ended, exception, batches, rows of each query that was started."""
    started = _of(events, f"{_STREAM}StartedEvent").select(F.col("runId").alias("run_id"), "name")
    ended = _of(events, f"{_STREAM}TerminatedEvent").select(F.col("runId").alias("run_id"), F.lit(True).alias("ended"), "exception")
    progress = _of(events, f"{_STREAM}ProgressEvent").groupBy(F.col("progress.runId").alias("run_id")).agg(F.count("*").alias("batches"), F.sum("progress.numInputRows").alias("rows"))
    out = started.join(ended, "run_id", "left").join(progress, "run_id", "left")
    return out.select("run_id", "name", F.coalesce("ended", F.lit(False)).alias("ended"), "exception", F.coalesce("batches", F.lit(0)).alias("batches"), F.coalesce("rows", F.lit(0)).alias("rows"))


def properties(events: DataFrame) -> DataFrame:
    """key, value of the first environment update."""
    first = _of(events, f"{_PREFIX}EnvironmentUpdate").select("`Spark Properties`").limit(1)
    return first.select(F.explode("Spark Properties").alias("key", "value"))
