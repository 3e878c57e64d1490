"""The registered queries of the change-data and ingestion operators, with their SQL twins.

``events`` stands for a change log (event_id the offset, user_id the key, event_type the operation), ``customer`` for a
mirror, ``orders`` and ``lineitem`` for source tables and for jobs and tasks of an application.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import change_values, cleansing
from tidewell.operators import changes, ledger, reports, validation
from tidewell.operators.store import SnapshotStore
from tidewell.plans import event_log_report
from tidewell.scratch import scratch_path
from tidewell.sources import avro, event_log, jdbc, streams
from tidewell.sources.registry import FixedRegistry
from tidewell.streaming import change_batches, landing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL twin."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    op = F.when(F.col("event_type") == "error", "d").when(F.col("event_type") == "signup", "c").otherwise("u")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value", op.alias("op"))


def mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("amount"), F.col("c_name").alias("origin"))


def latest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = changes.latest_per_key(change_log(spark, sf_dir), "user_id", "event_id")
    return latest.select(F.col("user_id").alias("id"), F.col("value").alias("amount"), F.lit("change").alias("origin"), "op", "event_id")


_LOG = """log AS (
    SELECT event_id, user_id, ts, value, CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END AS op FROM events
), latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)"""
_STATE = """SELECT id, amount, origin FROM (
    SELECT user_id AS id, value AS amount, 'change' AS origin FROM latest WHERE {upserts}
    UNION ALL
    SELECT c_custkey, c_acctbal, c_name FROM customer WHERE {kept}
)"""


@query(f"WITH {_LOG} SELECT user_id, event_id, ts, value, op, md5(user_id::VARCHAR) AS id_iceberg FROM latest WHERE op <> 'd'")
def cdc_latest_upserts(spark, sf_dir):
    latest = changes.latest_per_key(change_log(spark, sf_dir), "user_id", "event_id")
    return changes.upserts(latest).select("user_id", "event_id", "ts", "value", "op", cleansing.surrogate_key(["user_id"]).alias(cleansing.KEY))


@query(f"WITH {_LOG} SELECT user_id, event_id, op FROM latest WHERE op = 'd'")
def cdc_latest_deletes(spark, sf_dir):
    latest = changes.latest_per_key(change_log(spark, sf_dir), "user_id", "event_id")
    return changes.deletes(latest).select("user_id", "event_id", "op")


@query(f"WITH {_LOG} " + _STATE.format(upserts="op <> 'd'", kept="c_custkey NOT IN (SELECT user_id FROM latest WHERE op <> 'd')"))
def cdc_merge_apply(spark, sf_dir):
    return changes.upserted(mirror(spark, sf_dir), changes.upserts(latest_changes(spark, sf_dir)), "id")


@query(f"WITH {_LOG} SELECT c_custkey AS id, c_acctbal AS amount, c_name AS origin FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM latest WHERE op = 'd')")
def cdc_delete_apply(spark, sf_dir):
    return changes.deleted(mirror(spark, sf_dir), changes.deletes(latest_changes(spark, sf_dir)), "id")


@query(f"WITH {_LOG} " + _STATE.format(upserts="op <> 'd'", kept="c_custkey NOT IN (SELECT user_id FROM latest)"))
def cdc_apply_state(spark, sf_dir):
    return changes.applied(mirror(spark, sf_dir), latest_changes(spark, sf_dir), "id")


@query("SELECT l_orderkey, l_linenumber, md5(l_orderkey::VARCHAR || '|' || l_linenumber::VARCHAR) AS id_iceberg FROM lineitem")
def surrogate_key(spark, sf_dir):
    return cleansing.with_key(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query(
    "SELECT count(*) AS event_count, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS max_event_ts, min(event_id) AS min_offset, max(event_id) AS max_offset FROM events"
)
def batch_stats(spark, sf_dir):
    return changes.batch_stats(table(spark, sf_dir, "events"), "ts", "event_id")


@query("SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour, count(*) AS n FROM events GROUP BY ALL")
def date_partitions(spark, sf_dir):
    parts = ("year", "month", "day", "hour")
    return cleansing.with_date_parts(table(spark, sf_dir, "events"), "ts", parts).groupBy(*parts).agg(F.count("*").alias("n"))


def _instant(column: str):
    """A wall clock without zone as the instant at which a clock in UTC shows it, whatever the session's zone."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column)).cast("timestamp")


@query("SELECT event_id, ts AS wall, epoch_us(ts) - 32400000000 AS utc_us FROM events")
def zone_shift(spark, sf_dir):
    """Clocks of a source zone as UTC; a timestamp without zone stays as it is."""
    clocks = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("wall"), _instant("ts").alias("at"))
    return cleansing.timestamps_to_utc(clocks, "Asia/Seoul").select("event_id", "wall", F.unix_micros("at").alias("utc_us"))


@query(
    """
WITH n AS (SELECT event_id, event_id % 20000 AS days, CASE WHEN event_id % 977 = 0 THEN 0 ELSE 1500000000000 + (event_id % 977) * 100000123 END AS ms, CASE WHEN event_id % 983 = 0 THEN 0 ELSE 1500000000000000 + (event_id % 983) * 100000123457 END AS us, event_id % 86400000000 AS of_day FROM events)
SELECT event_id, strftime(DATE '1970-01-01' + days::INT, '%Y-%m-%d') AS d, CASE WHEN ms <> 0 THEN ms * 1000 - 32400000000 END AS t_ms, CASE WHEN us <> 0 THEN us - 32400000000 END AS t_us, of_day AS t_day FROM n"""
)
def logical_type_casts(spark, sf_dir):
    e = F.col("event_id")
    micros = lambda c, kind: F.unix_micros(change_values.logical_value(c, f"io.debezium.time.{kind}"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.date_format(change_values.logical_value((e % 20000).cast("int"), "io.debezium.time.Date"), "yyyy-MM-dd").alias("d"),
        micros(F.when(e % 977 == 0, 0).otherwise(F.lit(1500000000000) + (e % 977) * F.lit(100000123)), "Timestamp").alias("t_ms"),
        micros(F.when(e % 983 == 0, 0).otherwise(F.lit(1500000000000000) + (e % 983) * F.lit(100000123457)), "MicroTimestamp").alias("t_us"),
        micros(e % F.lit(86400000000), "MicroTime").alias("t_day"),
    )


@query("SELECT event_id, event_id::INT AS schema_id, event_type AS payload FROM events")
def wire_header(spark, sf_dir):
    message = F.concat(F.unhex(F.concat(F.lit("00"), F.lpad(F.hex("event_id"), 8, "0"))), F.col("event_type").cast("binary"))
    framed = table(spark, sf_dir, "events").select("event_id", message.alias("m"))
    return framed.select("event_id", change_values.schema_id(F.col("m")).alias("schema_id"), change_values.payload(F.col("m")).cast("string").alias("payload"))


@query("SELECT event_id, user_id, event_type, value, event_id % 2 = 0 AS even, CASE WHEN event_id % 3 = 0 THEN NULL ELSE props END AS props FROM events")
def avro_round_trip(spark, sf_dir):
    schema = {
        "type": "record", "name": "Event",
        "fields": [
            {"name": "event_id", "type": "long"}, {"name": "user_id", "type": "long"}, {"name": "event_type", "type": "string"},
            {"name": "value", "type": ["null", "double"]}, {"name": "even", "type": "boolean"}, {"name": "props", "type": ["null", "string"]},
        ],
    }
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", (F.col("event_id") % 2 == 0).alias("even"), F.when(F.col("event_id") % 3 != 0, F.col("props")).alias("props")
    )
    return avro.decoded(avro.encoded(rows, schema), "payload", schema).select("record.*")


def order_database(spark: SparkSession, sf_dir: str) -> jdbc.Database:
    """An operational database that holds the orders: Derby, in a file that all executors open."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return jdbc.Derby.archived(spark, "APP.ORDERS", rows)


@query("SELECT min(o_orderkey) AS lower_bound, max(o_orderkey) AS upper_bound FROM orders")
def jdbc_bounds(spark, sf_dir):
    bounds = order_database(spark, sf_dir).bounds("APP.ORDERS", "o_orderkey")
    return spark.createDataFrame([bounds], "lower_bound long, upper_bound long")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def jdbc_range_read(spark, sf_dir):
    """The table in four ranges of the key that the source's catalog names."""
    return order_database(spark, sf_dir).read("APP.ORDERS", 4)


@query("SELECT o_orderstatus AS status, count(*) AS n, max(o_totalprice) AS dearest FROM orders GROUP BY 1")
def jdbc_pushed_query(spark, sf_dir):
    """A statement that the source runs; its groups alone come over."""
    db = order_database(spark, sf_dir)
    return db.query(f'SELECT "o_orderstatus" AS "status", CAST(count(*) AS BIGINT) AS "n", max("o_totalprice") AS "dearest" FROM {db.source_name("APP.ORDERS")} GROUP BY "o_orderstatus"')


@query(
    """SELECT event_id, user_id, event_type, ts FROM events WHERE NOT (ts < TIMESTAMP '2024-01-16' AND (user_id, event_type, ts) NOT IN (SELECT user_id, event_type, max(ts) FROM events GROUP BY ALL))"""
)
def ledger_purge_keep_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return ledger.kept_rows(rows, ["user_id", "event_type"], "ts", F.lit("2024-01-16").cast("timestamp_ntz"))


@query("SELECT user_id, event_type, max(ts) AS last_completed FROM events WHERE event_type <> 'error' GROUP BY ALL")
def ledger_last_success(spark, sf_dir):
    return ledger.last_success(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", F.col("event_type") != "error")


@query(
    """WITH s AS (SELECT user_id, event_type, max(event_id) AS v FROM events GROUP BY ALL)
SELECT user_id AS a, event_type AS b, 'x' AS c, v FROM s
UNION ALL SELECT c_custkey, m, 'x', c_nationkey::BIGINT FROM customer, (SELECT unnest(['click', 'none']) AS m) WHERE (c_custkey, m) NOT IN (SELECT user_id, event_type FROM s)"""
)
def ledger_merge(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("a"), F.explode(F.array(F.lit("click"), F.lit("none"))).alias("b"), F.lit("x").alias("c"), F.col("c_nationkey").cast("long").alias("v"))
    rows = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("a"), F.col("event_type").alias("b")).agg(F.max("event_id").alias("v")).select("a", "b", F.lit("x").alias("c"), "v")
    return ledger.merged(base, rows, ["a", "b", "c"])


@query(
    """SELECT user_id, (epoch(TIMESTAMP '2024-01-30 12:00:00')::BIGINT - epoch(date_trunc('second', max(ts)))::BIGINT) >= 14400 AS due FROM events GROUP BY user_id"""
)
def should_run_flags(spark, sf_dir):
    last = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("last"))
    return last.select("user_id", ledger.due(F.col("last"), F.lit("2024-01-30 12:00:00").cast("timestamp_ntz"), ledger.COMPACTION_INTERVAL).alias("due"))


@query("SELECT (event_id % 3 + 9)::INT AS schema_id, (event_id % 3)::INT AS place, count(*) AS n, min(event_id) AS first_offset, max(event_id) AS last_offset FROM events GROUP BY 1, 2")
def schema_version_split(spark, sf_dir):
    """A batch split by the schema ids that it holds, in their numeric order."""
    message = F.concat(F.unhex(F.concat(F.lit("00"), F.lpad(F.hex(F.col("event_id") % 3 + 9), 8, "0"))), F.lit("x").cast("binary"))
    batch = table(spark, sf_dir, "events").select("event_id", change_values.schema_id(message).alias("schema_id"))
    parts = [
        changes.batch_stats(of_schema.withColumn("at", F.lit(None).cast("timestamp")), "at", "event_id").select(
            F.lit(schema).alias("schema_id"), F.lit(i).alias("place"), F.col("event_count").alias("n"), F.col("min_offset").alias("first_offset"), F.col("max_offset").alias("last_offset")
        )
        for i, schema in enumerate(changes.by_schema_version(batch, "schema_id"))
        for of_schema in [batch.where(F.col("schema_id") == schema)]
    ]
    return reduce(DataFrame.unionAll, parts)


@query("SELECT p_partkey, trim('  ' || p_name || ' ', ' ') AS p_name, trim(p_brand, ' ') AS p_brand, trim(p_type, ' ') AS p_type, p_size, p_retailprice FROM part")
def trim_strings(spark, sf_dir):
    padded = table(spark, sf_dir, "part").withColumn("p_name", F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
    return cleansing.trim_strings(padded)


@query("SELECT o_orderkey, o_orderdate AS last_applied_date, md5(o_orderkey::VARCHAR) AS id_iceberg FROM orders")
def audit_rename(spark, sf_dir):
    staged = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias(cleansing.AUDIT_BEFORE))
    return cleansing.with_key(cleansing.renamed_audit(staged), ["o_orderkey"])


@query(
    """SELECT event_type, list_sort(list(value))[(floor(count(value) * 0.5))::INT + 1] AS p50, list_sort(list(value))[(floor(count(value) * 0.95))::INT + 1] AS p95
FROM events WHERE value IS NOT NULL GROUP BY event_type"""
)
def index_percentiles(spark, sf_dir):
    return reports.index_percentiles(table(spark, sf_dir, "events"), ["event_type"], "value", {"p50": 0.5, "p95": 0.95})


_CLASS = """CASE WHEN contains(t, 'merge into') THEN 'MERGE INTO' WHEN contains(t, 'delete from') THEN 'DELETE' WHEN contains(t, 'insert into') THEN 'INSERT INTO'
    WHEN contains(t, 'create table') OR contains(t, 'create database') THEN 'DDL' WHEN contains(t, 'select') THEN 'SELECT' ELSE 'OTHER' END"""
_TEXTS = ("MERGE INTO t USING s", "select * from t", "Insert into t select 1", "delete from t", "create table t as select 1", "vacuum")
_STATEMENTS = str(list(_TEXTS))


@query(
    f"""WITH s AS (SELECT lower(({_STATEMENTS})[(event_id % 6)::INT + 1]) AS t, (event_id * 7919) % 10007 AS d FROM events), c AS (SELECT {_CLASS} AS sql_class, d FROM s)
SELECT sql_class, count(*) AS n, avg(d) AS avg_ms, max(d) AS max_ms, sum(d)::BIGINT AS total_ms,
    list_sort(list(d))[(floor(count(*) * 0.5))::INT + 1] AS p50_ms, list_sort(list(d))[(floor(count(*) * 0.95))::INT + 1] AS p95_ms FROM c GROUP BY 1"""
)
def sql_class_stats(spark, sf_dir):
    texts = F.array(*[F.lit(x) for x in _TEXTS])
    runs = table(spark, sf_dir, "events").select(F.get(texts, (F.col("event_id") % 6).cast("int")).alias("t"), ((F.col("event_id") * 7919) % 10007).alias("d"))
    return reports.class_stats(runs, "t", "d")


@query(f"WITH s AS (SELECT doc_id, lower(text) AS t FROM documents) SELECT {_CLASS} AS sql_class, count(*) AS n FROM s GROUP BY 1")
def sql_class_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(reports.statement_class(F.col("text")).alias("sql_class")).agg(F.count("*").alias("n"))


@query(
    """WITH g AS (SELECT l_suppkey, count(*) AS tasks, max(l_extendedprice) AS max_ms, list_sort(list(l_extendedprice))[(floor(count(*) * 0.5))::INT + 1] AS p50_ms FROM lineitem GROUP BY 1)
SELECT l_suppkey, tasks, max_ms, p50_ms, max_ms / p50_ms AS ratio, max_ms > 10000 AS serious FROM g WHERE tasks >= 2 AND p50_ms > 0 AND max_ms / p50_ms > 2"""
)
def skew_groups(spark, sf_dir):
    return reports.skewed_groups(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice", threshold=2.0)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10")
def top_slow(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return reports.slowest(rows, "l_extendedprice", ["l_orderkey", "l_linenumber"])


def application_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an application's log, written as compressed lines and read back: each is a job, a statement and a task."""
    at, id_ = F.unix_millis(_instant("ts")), F.col("event_id")
    took = (id_ * 7919) % 10007
    user = F.col("user_id").cast("string")
    sql = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
    stream = "org.apache.spark.sql.streaming.StreamingQueryListener$Query"

    def line(event: str, /, **fields):
        return F.to_json(F.struct(F.lit(event).alias("Event"), *[c.alias(k.replace("_", " ") if k[0].isupper() else k) for k, c in fields.items()]))

    properties = F.create_map(
        F.lit("spark.job.description"), F.concat(F.lit("user "), user, F.lit("\nall of it")), F.lit("spark.jobGroup.id"), user, F.lit("spark.scheduler.pool"), F.nullif("event_type", F.lit("error"))
    )
    properties = F.map_filter(properties, lambda _, v: v.isNotNull())
    slow = F.floor(took * took / 1000)
    task = F.struct((F.col("event_id") * 0).alias("Launch Time"), slow.alias("Finish Time"), (id_ % 17 == 0).alias("Failed"), (F.col("user_id") % 7).cast("string").alias("Executor ID"))
    metrics = F.struct(F.floor(slow * 0.75).alias("Executor Run Time"), (id_ % 10).alias("JVM GC Time"))
    statements = F.array(*[F.lit(x) for x in _TEXTS])
    lines = F.array(
        line("SparkListenerJobStart", Job_ID=id_, Submission_Time=at, Properties=properties),
        F.when(id_ % 11 != 0, line("SparkListenerJobEnd", Job_ID=id_, Completion_Time=at + took)),
        line(sql + "Start", executionId=id_, description=F.get(statements, (id_ % 6).cast("int")), time=at),
        F.when(id_ % 13 != 0, line(sql + "End", executionId=id_, time=at + took)),
        line("SparkListenerTaskEnd", Stage_ID=F.col("user_id"), Task_Info=task, Task_Metrics=metrics),
        F.when(id_ % 100 == 0, line(stream + "StartedEvent", id=user, runId=id_.cast("string"), name=user)),
        F.when(id_ % 300 == 0, line(stream + "TerminatedEvent", id=user, runId=id_.cast("string"), exception=F.when(id_ % 900 == 0, F.lit("late")))),
        line(stream + "ProgressEvent", progress=F.struct((id_ - id_ % 100).cast("string").alias("runId"), (id_ % 100).alias("batchId"), F.lit(2).alias("numInputRows"))),
        F.lit("{malformed"),
    )
    n = F.col("id")
    fixed = F.array(
        line("SparkListenerExecutorAdded", Executor_ID=n.cast("string"), Timestamp=n * 0, Executor_Info=F.struct(F.concat(F.lit("h"), n).alias("Host"), F.lit(2).alias("Total Cores"))),
        line("SparkListenerBlockManagerAdded", Block_Manager_ID=F.struct(n.cast("string").alias("Executor ID")), Maximum_Memory=(n + 1) * 1000),
        F.when(n == 0, line("SparkListenerApplicationEnd", Timestamp=F.lit(50_000_000))),
        F.when(n == 0, line("SparkListenerEnvironmentUpdate", Spark_Properties=F.create_map(F.lit("spark.app.name"), F.lit("made"), F.lit("my.kafka.servers"), F.lit("k:9092")))),
    )
    made = [f.select(F.explode(x).alias("value")).where("value is not null") for f, x in ((table(spark, sf_dir, "events"), lines), (spark.range(7), fixed))]
    path = scratch_path(spark, "application-log")
    made[0].unionAll(made[1]).write.option("compression", "gzip").text(path)
    return event_log.read(spark, path, "part-*")


_RUN = "run AS (SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 AS began, (event_id * 7919) % 10007 AS took FROM events)"


@query("SELECT coalesce(nullif(event_type, 'error'), 'default') AS pool, count(*) AS jobs FROM events GROUP BY 1")
def pool_counts(spark, sf_dir):
    return event_log_report.pools(application_log(spark, sf_dir))


@query(
    f"""WITH {_RUN}, s AS (SELECT user_id, min(began) AS a, max(began + took) AS b, count(*) AS jobs FROM run WHERE event_id % 11 <> 0 GROUP BY 1),
g AS (SELECT min(a) AS t0, 60::DOUBLE / greatest(1, max(b) - min(a)) AS scale FROM s), l AS (SELECT *, least(59, floor((a - t0) * scale))::INT AS l FROM s, g),
r AS (SELECT *, greatest(l + 1, least(60, ceil((b - t0) * scale)::INT)) AS r FROM l)
SELECT 'user ' || user_id AS topic, strftime(make_timestamp(a * 1000), '%H:%M:%S') AS start, jobs, a AS start_ms, b - a AS duration_ms, repeat(' ', l) || repeat('#', r - l) || repeat(' ', 60 - r) AS bar FROM r"""
)
def timeline(spark, sf_dir):
    return event_log_report.timeline(application_log(spark, sf_dir)).select("topic", "start", "jobs", "start_ms", "duration_ms", "bar")


@query(
    f"""WITH {_RUN}, s AS (SELECT lower(({_STATEMENTS})[(event_id % 6)::INT + 1]) AS t, took AS d FROM run WHERE event_id % 13 <> 0), c AS (SELECT {_CLASS} AS sql_class, d FROM s)
SELECT sql_class, count(*) AS n, avg(d) AS avg_ms, max(d) AS max_ms, sum(d)::BIGINT AS total_ms,
    list_sort(list(d))[(floor(count(*) * 0.5))::INT + 1] AS p50_ms, list_sort(list(d))[(floor(count(*) * 0.95))::INT + 1] AS p95_ms FROM c GROUP BY 1"""
)
def log_sql_classes(spark, sf_dir):
    return event_log_report.sql_classes(application_log(spark, sf_dir))


@query(
    f"""WITH {_RUN}, t AS (SELECT user_id AS stage_id, took * took // 1000 AS d FROM run WHERE event_id % 17 <> 0),
g AS (SELECT stage_id, count(*) AS tasks, max(d) AS max_ms, list_sort(list(d))[(floor(count(*) * 0.5))::INT + 1] AS p50_ms FROM t GROUP BY 1)
SELECT stage_id, tasks, max_ms, p50_ms, max_ms / p50_ms AS ratio, max_ms > 10000 AS serious FROM g WHERE tasks >= 2 AND p50_ms > 0 AND max_ms / p50_ms > 3 ORDER BY ratio DESC, stage_id LIMIT 15"""
)
def log_skewed_stages(spark, sf_dir):
    return event_log_report.skewed_stages(application_log(spark, sf_dir))


@query(
    f"""WITH {_RUN}, t AS (SELECT took * took // 1000 AS d, event_id % 10 AS gc FROM run WHERE event_id % 17 <> 0)
SELECT count(*) AS tasks, max(d) AS max_ms, 100.0::DOUBLE * sum(gc) / sum(d) AS gc_pct, list_sort(list(d))[(floor(count(*) * 0.5))::INT + 1] AS p50_ms, list_sort(list(d))[(floor(count(*) * 0.95))::INT + 1] AS p95_ms FROM t"""
)
def log_task_times(spark, sf_dir):
    return event_log_report.task_times(application_log(spark, sf_dir))


@query(
    f"""WITH {_RUN}, t AS (SELECT (user_id % 7)::VARCHAR AS executor_id, count(*) AS tasks, avg(took * took // 1000) AS avg_ms, sum(took * took // 1000)::BIGINT AS busy_ms FROM run GROUP BY 1),
u AS (SELECT executor_id, 2 AS cores, tasks, avg_ms, busy_ms, 50000000::BIGINT AS span_ms, 100.0::DOUBLE * busy_ms / 100000000 AS utilisation_pct, 'h' || executor_id AS host, (executor_id::BIGINT + 1) * 1000 AS memory FROM t)
SELECT *, CASE WHEN utilisation_pct < 30 THEN 'idle' WHEN utilisation_pct < 50 THEN 'low' WHEN utilisation_pct < 80 THEN 'good' ELSE 'busy' END AS verdict FROM u"""
)
def log_executors(spark, sf_dir):
    return event_log_report.executor_use(application_log(spark, sf_dir))


@query(
    """WITH q AS (SELECT event_id AS run, event_id % 300 = 0 AS ended, event_id % 900 = 0 AS failed FROM events WHERE event_id % 100 = 0),
p AS (SELECT event_id - event_id % 100 AS run, count(*) AS batches FROM events GROUP BY 1)
SELECT count(*) AS queries, count(*) FILTER (ended AND NOT failed) AS succeeded, count(*) FILTER (ended AND failed) AS failed, avg(coalesce(batches, 0)) AS avg_batches, sum(2 * coalesce(batches, 0))::BIGINT AS rows FROM q LEFT JOIN p USING (run)"""
)
def log_streaming(spark, sf_dir):
    return event_log_report.streaming(application_log(spark, sf_dir))


@query(
    "SELECT unnest([" + ", ".join(f"'{k}'" for k in event_log_report.SETTINGS) + "]) AS key, CASE key WHEN 'spark.app.name' THEN 'made' ELSE 'N/A' END AS value UNION ALL SELECT 'my.kafka.servers', 'k:9092'"
)
def log_configuration(spark, sf_dir):
    return event_log_report.configuration(application_log(spark, sf_dir))


@query(
    """WITH s AS (SELECT user_id, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY 1), g AS (SELECT min(a) AS t0, max(b) AS t1 FROM s),
p AS (SELECT unnest(generate_series(t0, t1 - 1, 100)) AS point FROM g) SELECT point, count(*) AS running FROM p JOIN s ON point BETWEEN a AND b GROUP BY 1"""
)
def concurrency(spark, sf_dir):
    spans = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    return reports.concurrency(spans, "a", "b", 100)


@query(
    """WITH s AS (SELECT user_id, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY 1), g AS (SELECT min(a) AS t0, max(b) AS t1 FROM s),
p AS (SELECT unnest(generate_series(t0, t1 - 1, 100)) AS point FROM g), c AS (SELECT point, count(*) AS n FROM p JOIN s ON point BETWEEN a AND b GROUP BY 1) SELECT max(n) AS max_running FROM c"""
)
def max_concurrency(spark, sf_dir):
    return concurrency(spark, sf_dir).agg(F.max("running").alias("max_running"))


def _tasks(spark, sf_dir):
    q = F.col("l_quantity").cast("long")
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 7).alias("executor_id"), (q * 100).alias("duration"), (q * 80).alias("run_ms"), (q * 50).alias("cpu_ms"), (q % 5).alias("gc_ms"), (q % 3).alias("ser_ms"),
        (q % 4).alias("deser_ms"), (q % 7).alias("fetch_wait_ms"), (q * 1000).alias("peak_memory"), (q % 2 * 10).alias("disk_spill"), (q % 2 * 20).alias("memory_spill"),
        (q * 9).alias("input_bytes"), (q * 8).alias("shuffle_read"), (q * 7).alias("shuffle_write"),
    )


@query(
    """WITH t AS (SELECT l_suppkey % 7 AS executor_id, l_quantity::BIGINT * 100 AS duration FROM lineitem), x AS (SELECT unnest(range(0, 8)) AS executor_id),
b AS (SELECT executor_id, count(*) AS tasks, avg(duration) AS avg_ms, sum(duration)::BIGINT AS busy_ms FROM t GROUP BY 1),
u AS (SELECT x.executor_id, 2 AS cores, coalesce(tasks, 0) AS tasks, avg_ms, coalesce(busy_ms, 0) AS busy_ms, 100.0::DOUBLE * coalesce(busy_ms, 0) / greatest(1, 20000000 * 2) AS utilisation_pct FROM x LEFT JOIN b USING (executor_id))
SELECT *, CASE WHEN utilisation_pct < 30 THEN 'idle' WHEN utilisation_pct < 50 THEN 'low' WHEN utilisation_pct < 80 THEN 'good' ELSE 'busy' END AS verdict FROM u"""
)
def executor_utilisation(spark, sf_dir):
    executors = spark.range(8).select(F.col("id").alias("executor_id"), F.lit(2).alias("cores"))
    return reports.executor_use(_tasks(spark, sf_dir), executors, F.lit(20_000_000))


@query(
    """WITH q AS (SELECT l_quantity::BIGINT AS q FROM lineitem), s AS (SELECT sum(q * 100)::BIGINT AS duration, sum(q * 80)::BIGINT AS run_ms, sum(q * 50)::BIGINT AS cpu_ms, sum(q % 5)::BIGINT AS gc_ms,
    sum(q % 3)::BIGINT AS ser_ms, sum(q % 4)::BIGINT AS deser_ms, sum(q % 7)::BIGINT AS fetch_wait_ms, count(*) AS tasks FROM q)
SELECT *, greatest(0, duration - run_ms - gc_ms - ser_ms - deser_ms) AS other_ms, 100.0::DOUBLE * cpu_ms / run_ms AS cpu_pct, 100.0::DOUBLE * fetch_wait_ms / run_ms AS fetch_wait_pct,
    100.0::DOUBLE * gc_ms / duration AS gc_pct, 'mixed' AS cpu_verdict, 'fine' AS fetch_verdict, 'fine' AS gc_verdict FROM s"""
)
def time_breakdown(spark, sf_dir):
    return reports.time_breakdown(_tasks(spark, sf_dir))


@query(
    """WITH q AS (SELECT l_quantity::BIGINT AS q FROM lineitem), s AS (SELECT max(q * 1000) AS peak_memory, sum(q % 2 * 10)::BIGINT AS disk_spill, sum(q % 2 * 20)::BIGINT AS memory_spill, sum(q * 9)::BIGINT AS input_bytes,
    sum(q * 8)::BIGINT AS shuffle_read, sum(q * 7)::BIGINT AS shuffle_write FROM q) SELECT *, 100.0::DOUBLE * peak_memory / 100000 AS peak_pct, CASE WHEN 100.0 * peak_memory / 100000 < 30 THEN 'spare' WHEN 100.0 * peak_memory / 100000 < 80 THEN 'good' ELSE 'tight' END AS verdict FROM s"""
)
def spill_ratios(spark, sf_dir):
    return reports.memory_use(_tasks(spark, sf_dir), F.lit(100_000))


# a topic of the change log, with keys and envelopes as a connector writes them
_KEY = {"type": "record", "name": "Key", "fields": [{"name": "user_id", "type": "long"}]}
_ROW = {
    "type": "record", "name": "Value",
    "fields": [{"name": "user_id", "type": "long"}, {"name": "value", "type": ["null", "double"]}, {"name": "at", "type": [{"type": "long", "connect.name": "io.debezium.time.MicroTimestamp"}, "null"]}],
}
_ENVELOPE = {
    "type": "record", "name": "Envelope",
    "fields": [{"name": "before", "type": ["null", _ROW]}, {"name": "after", "type": ["null", "Value"]}, {"name": "op", "type": "string"}, {"name": "ts_ms", "type": ["null", "long"]}],
}
_REGISTRY = FixedRegistry({1: _KEY, 9: _ENVELOPE, 10: _ENVELOPE})
_TOPIC = "source.store.users"


def change_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log in Kafka's columns; its envelopes come in two schema versions."""
    us = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp"))
    row = F.struct("user_id", "value", us.alias("at"))
    gone = F.col("op") == "d"
    log = change_log(spark, sf_dir).select(
        "user_id", F.when(gone, row).alias("before"), F.when(~gone, row).alias("after"), "op", F.floor(us / 1000).alias("ts_ms"), F.col("event_id").alias("offset"),
        F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp").alias("timestamp"),
    )
    keyed = avro.encoded(log, _KEY, "k", keep=log.columns)
    both = avro.encoded(keyed, _ENVELOPE, "v", keep=["k", "offset", "timestamp"])
    head = lambda version: F.concat(F.unhex(F.lit("00")), F.unhex(F.lpad(F.hex(version), 8, "0")))
    return both.select(
        F.concat(head(F.lit(1)), "k").alias("key"), F.concat(head(F.col("offset") % 2 + 9), "v").alias("value"), F.lit(_TOPIC).alias("topic"), F.lit(0).alias("partition"), "offset", "timestamp"
    )


@query(
    f"""WITH {_LOG} SELECT user_id, value, epoch_us(ts) - 32400000000 AS at_us, md5(user_id::VARCHAR) AS id_iceberg FROM latest WHERE op <> 'd'"""
)
def stream_drain_state(spark, sf_dir):
    """The change log as files of a stream, drained into a mirror in four batches, read back."""
    root = scratch_path(spark, "drain")
    records = change_records(spark, sf_dir)
    low, high = table(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    edges = [low + (high + 1 - low) * i // 4 for i in range(5)]
    for a, b in zip(edges, edges[1:], strict=False):  # one after the other, as a topic's offsets come
        records.where((F.col("offset") >= a) & (F.col("offset") < b)).coalesce(1).write.mode("append").parquet(f"{root}/in")
    sink = change_batches.ChangeSink(spark, SnapshotStore(spark, f"{root}/wh"), _REGISTRY, "catalog", "local")
    sink.maintainer.ensure_ledgers()
    mirror_ = sink.store.table("local_store.users")
    mirror_.replace(spark.createDataFrame([], "user_id long, value double, at timestamp, last_applied_date timestamp, id_iceberg string"))
    errors = change_batches.drain_topics(sink, {_TOPIC: lambda: streams.file_stream(spark, f"{root}/in", 1)}, f"{root}/checkpoint")
    if errors:
        raise errors[_TOPIC]
    return mirror_.read().select("user_id", "value", F.unix_micros("at").alias("at_us"), "id_iceberg")


@query("SELECT year(ts)::INT AS year, month(ts)::INT AS month, day(ts)::INT AS day, count(*) AS n, count(*) FILTER (event_type = 'error') AS deletes FROM events GROUP BY ALL")
def landed_partitions(spark, sf_dir):
    """The change log landed as date-partitioned Parquet, counted by its partitions."""
    path = scratch_path(spark, "landed")
    landing.land_batch(_REGISTRY, change_records(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("year", "month", "day").agg(F.count("*").alias("n"), F.count(F.when(F.col("op") == "d", 1)).alias("deletes"))


@query(ORACLE_SQL["cdc_apply_state"])
def snapshot_store_state(spark, sf_dir):
    """The mirror as a stored table: replaced, changed in two commits, compacted, its old versions expired, read back."""
    t = SnapshotStore(spark, scratch_path(spark, "store")).table("ns.mirror")
    t.replace(mirror(spark, sf_dir))
    latest = latest_changes(spark, sf_dir)
    t.upsert(changes.upserts(latest), "id")
    t.delete(changes.deletes(latest), "id")
    t.compact()
    t.expire(2**60)
    return t.read()


@query(
    """SELECT * FROM (VALUES ('orders', 'count', NULL, '5', '6', false), ('orders', 'unreflected', 'O_CLERK', 'varchar(15)', NULL, false),
('orders', 'order', NULL, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice', 'o_orderkey,o_custkey,o_orderstatus,o_totalprice', true),
('orders', 'type', 'o_totalprice', 'decimal(15,2)', 'double', false), ('orders', 'nullability', 'o_orderkey', 'not null', 'null', false), ('orders', 'key', 'o_orderkey', NULL, NULL, false)
) AS t(table_name, step, c3, source, mirror, ok)""".replace("SELECT * FROM", "SELECT table_name, step, CASE WHEN step = 'key' THEN NULL ELSE c3 END AS column_name, CASE WHEN step = 'key' THEN c3 ELSE source END AS source, mirror, ok FROM")
)
def column_diff(spark, sf_dir):
    columns = {"o_orderkey": "bigint", "O_CUSTKEY": "bigint", "o_orderstatus": "char(1)", "o_totalprice": "decimal(15,2)", "O_CLERK": "varchar(15)"}
    found = validation.findings("orders", "mysql", columns, {"o_orderkey": False}, ["o_orderkey"], table(spark, sf_dir, "orders").schema)
    return validation.findings_frame(spark, found)
