"""The nine reports on an application, each a table; ``python -m tidewell.plans.event_log_report PATH`` prints them."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import reports
from tidewell.sources import event_log

# Settings that the configuration report shows, set or not.
SETTINGS = (
    "spark.app.name", "spark.scheduler.mode", "spark.driver.memory", "spark.driver.cores", "spark.executor.memory", "spark.executor.cores", "spark.executor.instances",
    "spark.dynamicAllocation.enabled", "spark.sql.shuffle.partitions", "spark.sql.caseSensitive", "spark.sql.session.timeZone", "spark.sql.defaultCatalog", "spark.yarn.maxAppAttempts",
)
SKEW, SERIOUS_MS, TOP_SQL, TOP_STAGES, STEP_MS = 3.0, 10_000, 10, 15, 1000


def pools(events: DataFrame) -> DataFrame:
    return event_log.jobs(events).groupBy("pool").agg(F.count("*").alias("jobs")).orderBy(F.col("jobs").desc(), "pool")


def topic_spans(events: DataFrame) -> DataFrame:
    """A topic is the first line of a job's description; groups of one topic stay apart."""
    topic = F.element_at(F.split(F.col("description"), "\n"), 1)
    ended = event_log.jobs(events).where("end_ms is not null and description is not null").withColumn("topic", topic)
    spans = ended.groupBy("group_id", "topic").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("jobs"))
    return spans.withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))


def timeline(events: DataFrame, width: int = 60) -> DataFrame:
    """Topics by start, with a bar of ``width`` characters over the whole span."""
    spans = topic_spans(events)
    whole = spans.agg(F.min("start_ms").alias("t0"), F.max("end_ms").alias("t1"))
    scale = F.lit(width) / reports.at_least_one(F.col("t1") - F.col("t0"))
    left = F.least(F.lit(width - 1), F.floor((F.col("start_ms") - F.col("t0")) * scale)).cast("int")
    right = F.greatest(left + 1, F.least(F.lit(width), F.ceil((F.col("end_ms") - F.col("t0")) * scale)).cast("int"))
    bar = F.concat(F.repeat(F.lit(" "), left), F.repeat(F.lit("#"), right - left), F.repeat(F.lit(" "), F.lit(width) - right))
    out = spans.crossJoin(F.broadcast(whole)).withColumn("bar", bar)  # one row
    return out.select("topic", reports.clock_text(F.col("start_ms")).alias("start"), reports.duration_text(F.col("duration_ms")).alias("duration"), "jobs", "bar", "start_ms", "duration_ms").orderBy("start_ms", "topic")


def concurrency(events: DataFrame) -> DataFrame:
    return reports.concurrency(topic_spans(events), "start_ms", "end_ms", STEP_MS).agg(F.max("running").alias("max_running"))


def sql_classes(events: DataFrame) -> DataFrame:
    return reports.class_stats(event_log.executions(events), "description", "duration").orderBy(F.col("total_ms").desc(), "sql_class")


def slow_sql(events: DataFrame) -> DataFrame:
    return reports.slowest(event_log.executions(events), "duration", ["execution_id"], TOP_SQL)


def skewed_stages(events: DataFrame) -> DataFrame:
    good = event_log.tasks(events).where("not failed")
    return reports.slowest(reports.skewed_groups(good, "stage_id", "duration", SKEW, SERIOUS_MS), "ratio", ["stage_id"], TOP_STAGES)


def task_times(events: DataFrame) -> DataFrame:
    """Median, 95th percentile and longest of tasks, and the share of garbage collection."""
    good = event_log.tasks(events).where("not failed").withColumn("all", F.lit("all"))
    times = reports.index_percentiles(good, ["all"], "duration", {"p50_ms": 0.5, "p95_ms": 0.95})
    share = 100.0 * F.sum("gc_ms") / reports.at_least_one(F.sum("duration"))
    return good.groupBy("all").agg(F.count("*").alias("tasks"), F.max("duration").alias("max_ms"), share.alias("gc_pct")).join(times, "all").drop("all")


def executor_use(events: DataFrame) -> DataFrame:
    """Failed tasks count; without an end of the application its span is the least, 1 ms."""
    span = event_log.application_span(events).select(F.when(F.col("end_ms") > 0, F.col("end_ms") - F.col("start_ms")).otherwise(1).alias("span_ms"))
    found = event_log.executors(events).crossJoin(F.broadcast(span))  # one row
    span_ms = found.select("executor_id", "span_ms")
    used = reports.executor_use(event_log.tasks(events), found.select("executor_id", "cores", "span_ms").drop("span_ms"), F.lit(1)).drop("utilisation_pct", "verdict")
    share = 100.0 * F.col("busy_ms") / reports.at_least_one(F.col("span_ms") * F.col("cores"))
    verdict = reports.band(share, (30, 50, 80), ("idle", "low", "good", "busy"))
    return used.join(span_ms, "executor_id").withColumns({"utilisation_pct": share, "verdict": verdict}).join(event_log.executors(events).select("executor_id", "host", "memory"), "executor_id")


def memory(events: DataFrame) -> DataFrame:
    heap = event_log.block_managers(events).where("executor_id <> 'driver'").agg(F.coalesce(F.max("memory"), F.lit(0)).alias("heap"))
    heap_bytes = heap.first()[0]
    return reports.memory_use(event_log.tasks(events).where("not failed"), F.lit(heap_bytes)).withColumn("heap", F.lit(heap_bytes))


def cpu(events: DataFrame) -> DataFrame:
    return reports.time_breakdown(event_log.tasks(events).where("not failed"))


def streaming(events: DataFrame) -> DataFrame:
    good = F.col("ended") & F.col("exception").isNull()
    return event_log.streaming_queries(events).agg(
        F.count("*").alias("queries"), F.count(F.when(good, 1)).alias("succeeded"), F.count(F.when(F.col("exception").isNotNull(), 1)).alias("failed"),
        F.avg("batches").alias("avg_batches"), F.sum("rows").alias("rows"),
    )


def configuration(events: DataFrame) -> DataFrame:
    """The fixed settings with N/A where unset, and every setting whose name has kafka in it."""
    held = event_log.properties(events)
    fixed = events.sparkSession.createDataFrame([(k,) for k in SETTINGS], "key string").join(held, "key", "left").select("key", F.coalesce("value", F.lit("N/A")).alias("value"))
    return fixed.unionByName(held.where("contains(lower(key), 'kafka')"))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "configuration": configuration, "pools": pools, "timeline": timeline, "concurrency": concurrency, "sql classes": sql_classes, "slow sql": slow_sql, "skewed stages": skewed_stages,
    "task times": task_times, "executors": executor_use, "memory": memory, "cpu": cpu, "streaming": streaming,
}


def main(path: str) -> None:
    spark = SparkSession.builder.appName("event-log-report").getOrCreate()
    events = event_log.read(spark, path).persist()
    for name, report in REPORTS.items():
        print(f"== {name}")
        found = report(events).persist()
        found.show(max(found.count(), 1), truncate=False)  # whole: reports that are lists of the highest are cut already
        found.unpersist()


if __name__ == "__main__":
    main(sys.argv[1])
