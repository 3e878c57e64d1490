"""Measures that the event-log reports are made of, over flat tables of jobs, executions, tasks and executors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that a group's values are cut into, and points of a grid that are run up together.
CUTS, STRETCH = 64, 4096

# Statement classes, in the order in which they are looked for.
STATEMENT_CLASSES = (
    ("MERGE INTO", ("merge into",)),
    ("DELETE", ("delete from",)),
    ("INSERT INTO", ("insert into",)),
    ("DDL", ("create table", "create database")),
    ("SELECT", ("select",)),
)


def statement_class(text: Column) -> Column:
    """The first class of which a phrase is in the text; OTHER without any."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    found = F.lit("OTHER")
    for name, phrases in reversed(STATEMENT_CLASSES):
        hit = F.lit(False)
        for p in phrases:
            hit = hit | F.contains(lowered, F.lit(p))
        found = F.when(hit, F.lit(name)).otherwise(found)
    return found


def index_percentiles(df: DataFrame, group: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """For each group the value at index floor(n * share) of its sorted values, as ``shares``' names; nulls don't count.

    Equal values are counted before the shuffle.  Approximate quantiles cut a group's values into CUTS ranges; their counts
    say which ranges hold the wanted indexes, and only these are sorted, each by itself.  So the result is exact, and a
    group's values are neither sorted nor held by one task, however many they are.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("_n"))
    cuts = counts.groupBy(*[F.col(g).alias(f"_of_{g}") for g in group]).agg(F.percentile_approx(value, [i / CUTS for i in range(1, CUTS)], 1000).alias("_cuts"), F.sum("_n").alias("_all"))
    same = [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group]
    placed = counts.join(cuts, reduce(Column.__and__, same)).withColumn("_range", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    order = Window.partitionBy(*[f"_of_{g}" for g in group]).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    at = lambda s: F.floor(F.col("_all") * F.lit(s))
    ranges = placed.groupBy(*[f"_of_{g}" for g in group], "_all", "_range").agg(F.sum("_n").alias("_held")).withColumn("_before", F.coalesce(F.sum("_held").over(order), F.lit(0)))
    wanted = ranges.where(reduce(Column.__or__, [(at(s) >= F.col("_before")) & (at(s) < F.col("_before") + F.col("_held")) for s in shares.values()]))
    wanted = wanted.select(*[F.col(f"_of_{g}").alias(f"_want_{g}") for g in group], F.col("_range").alias("_w_range"), "_before")
    inside = placed.join(wanted, reduce(Column.__and__, [F.col(g).eqNullSafe(F.col(f"_want_{g}")) for g in group] + [F.col("_range") == F.col("_w_range")]))
    within = Window.partitionBy(*group, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
    return ranked.groupBy(*group).agg(*[F.min(F.when(F.col("_upto") > at(s), F.col(value))).alias(name) for name, s in shares.items()])


def class_stats(executions: DataFrame, text: str, duration: str) -> DataFrame:
    """Count, mean, median, 95th percentile, longest and total duration of each statement class."""
    classed = executions.select(statement_class(F.col(text)).alias("sql_class"), F.col(duration).alias("duration"))
    stats = classed.groupBy("sql_class").agg(
        F.count("*").alias("n"), F.avg("duration").alias("avg_ms"), F.max("duration").alias("max_ms"), F.sum("duration").alias("total_ms")
    )
    return stats.join(index_percentiles(classed, ["sql_class"], "duration", {"p50_ms": 0.5, "p95_ms": 0.95}), "sql_class", "left")


def slowest(df: DataFrame, duration: str, ties: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` rows of the longest duration, ties by ``ties``."""
    return df.orderBy(F.col(duration).desc(), *ties).limit(n)


def skewed_groups(tasks: DataFrame, group: str, duration: str, threshold: float = 3.0, serious_ms: float = 10_000) -> DataFrame:
    """Groups of two tasks or more whose longest exceeds ``threshold`` times their (upper) median."""
    longest = tasks.groupBy(group).agg(F.count(duration).alias("tasks"), F.max(duration).alias("max_ms"))
    middle = index_percentiles(tasks, [group], duration, {"p50_ms": 0.5})
    return (
        longest.where("tasks >= 2")
        .join(middle, group)
        .where("p50_ms > 0")
        .withColumn("ratio", F.col("max_ms") / F.col("p50_ms"))
        .where(F.col("ratio") > threshold)
        .withColumn("serious", F.col("max_ms") > serious_ms)
    )


def concurrency(spans: DataFrame, start: str, end: str, step: int) -> DataFrame:
    """How many spans cover each point of a grid from the first start (ends included), points that none covers left out.

    A span is a step up and a step down, whatever its length.  Steps are summed by point, then run up within stretches of
    the grid, over the sums of the stretches before; a row for each point is only made in the end.
    """
    first = spans.agg(F.min(start).alias("_t0"), F.max(end).alias("_t1"))
    s = spans.crossJoin(F.broadcast(first)).where(F.col(start).isNotNull() & F.col(end).isNotNull())  # one row
    step_ = F.lit(step)
    low = F.ceil((F.col(start) - F.col("_t0")) / step_)
    high = F.floor((F.least(F.col(end), F.col("_t1") - 1) - F.col("_t0")) / step_)
    edges = F.array(F.struct(low.alias("k"), F.lit(1).alias("d")), F.struct((high + 1).alias("k"), F.lit(-1).alias("d")))
    steps = s.where(high >= low).select(F.explode(edges).alias("e")).groupBy(F.col("e.k").alias("k")).agg(F.sum("e.d").alias("d"))
    steps = steps.withColumn("_stretch", F.floor(F.col("k") / STRETCH))
    sums = steps.groupBy("_stretch").agg(F.sum("d").alias("_d"), F.min("k").alias("_k"))
    in_order = Window.orderBy("_stretch")  # a row for each stretch
    sums = sums.select(F.col("_stretch").alias("_s"), F.coalesce(F.sum("_d").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_k").over(in_order).alias("_beyond"))
    within = Window.partitionBy("_stretch").orderBy("k")
    run = steps.join(sums, F.col("_stretch") == F.col("_s")).select(
        "k",
        (F.col("_before") + F.sum("d").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))).alias("running"),
        F.coalesce(F.lead("k").over(within), F.col("_beyond")).alias("next"),
    )
    points = run.where("running > 0").select(F.explode(F.sequence(F.col("k"), F.col("next") - 1)).alias("k"), "running").crossJoin(F.broadcast(first))
    return points.select((F.col("_t0") + F.col("k") * step_).alias("point"), "running")


def at_least_one(x: Column) -> Column:
    return F.greatest(F.lit(1), x)


def band(value: Column, limits: Sequence[float], names: Sequence[str]) -> Column:
    """The name of the range that a value is in: below the first limit, below the second, and so on."""
    out = F.lit(names[-1])
    for limit, name in reversed(list(zip(limits, names[:-1], strict=True))):
        out = F.when(value < limit, F.lit(name)).otherwise(out)
    return out


def executor_use(tasks: DataFrame, executors: DataFrame, span_ms: Column) -> DataFrame:
    """Tasks, mean and total busy time of each executor (of ``executors(executor_id, cores)``), and how much of its
    core time in ``span_ms`` that is."""
    busy = tasks.groupBy("executor_id").agg(F.count("*").alias("tasks"), F.avg("duration").alias("avg_ms"), F.sum("duration").alias("busy_ms"))
    share = 100.0 * F.coalesce(F.col("busy_ms"), F.lit(0)) / at_least_one(span_ms * F.col("cores"))
    return executors.join(busy, "executor_id", "left").select(
        "executor_id", "cores", F.coalesce("tasks", F.lit(0)).alias("tasks"), "avg_ms", F.coalesce("busy_ms", F.lit(0)).alias("busy_ms"), share.alias("utilisation_pct"),
        band(share, (30, 50, 80), ("idle", "low", "good", "busy")).alias("verdict"),
    )


def time_breakdown(tasks: DataFrame) -> DataFrame:
    """Where task time goes, in all: ``tasks(duration, run_ms, cpu_ms, gc_ms, ser_ms, deser_ms, fetch_wait_ms)``."""
    names = ("duration", "run_ms", "cpu_ms", "gc_ms", "ser_ms", "deser_ms", "fetch_wait_ms")
    total = tasks.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names], F.count("*").alias("tasks"))
    rest = F.col("duration") - F.col("run_ms") - F.col("gc_ms") - F.col("ser_ms") - F.col("deser_ms")
    share = lambda a, b: 100.0 * F.col(a) / at_least_one(F.col(b))
    return total.select(
        "*",
        F.greatest(F.lit(0), rest).alias("other_ms"),
        share("cpu_ms", "run_ms").alias("cpu_pct"),
        share("fetch_wait_ms", "run_ms").alias("fetch_wait_pct"),
        share("gc_ms", "duration").alias("gc_pct"),
        band(share("cpu_ms", "run_ms"), (50, 80), ("waits", "mixed", "computes")).alias("cpu_verdict"),
        band(share("fetch_wait_ms", "run_ms"), (5, 20), ("fine", "watch", "bad")).alias("fetch_verdict"),
        band(share("gc_ms", "duration"), (5, 10), ("fine", "watch", "bad")).alias("gc_verdict"),
    )


def memory_use(tasks: DataFrame, heap_bytes: Column) -> DataFrame:
    """Peak execution memory against a heap, and bytes spilled, read and shuffled, in all."""
    sums = ("disk_spill", "memory_spill", "input_bytes", "shuffle_read", "shuffle_write")
    total = tasks.agg(F.coalesce(F.max("peak_memory"), F.lit(0)).alias("peak_memory"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sums])
    share = 100.0 * F.col("peak_memory") / at_least_one(heap_bytes)
    return total.select("*", share.alias("peak_pct"), band(share, (30, 80), ("spare", "good", "tight")).alias("verdict"))


def duration_text(ms: Column) -> Column:
    """Milliseconds as ms, s, m or h."""
    return (
        F.when(ms < 1000, F.format_string("%dms", ms.cast("long")))
        .when(ms < 60_000, F.format_string("%.1fs", ms / 1000.0))
        .when(ms < 3_600_000, F.format_string("%.1fm", ms / 60_000.0))
        .otherwise(F.format_string("%.1fh", ms / 3_600_000.0))
    )


def bytes_text(n: Column) -> Column:
    """Bytes as B, KB, MB or GB."""
    return (
        F.when(n < 1024, F.format_string("%dB", n.cast("long")))
        .when(n < 1024**2, F.format_string("%.1fKB", n / 1024.0))
        .when(n < 1024**3, F.format_string("%.1fMB", n / float(1024**2)))
        .otherwise(F.format_string("%.2fGB", n / float(1024**3)))
    )


def clock_text(ms: Column) -> Column:
    """Epoch milliseconds as HH:MM:SS in UTC, whatever the session's zone."""
    second = F.pmod(F.floor(ms / 1000), F.lit(86_400))
    return F.format_string("%02d:%02d:%02d", (second / 3600).cast("int"), (F.pmod(second, F.lit(3600)) / 60).cast("int"), F.pmod(second, F.lit(60)).cast("int"))
