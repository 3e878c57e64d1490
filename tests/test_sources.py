import gzip
import json

import pytest
import zstandard

from tidewell import session
from tidewell.operators import validation
from tidewell.operators.store import SnapshotStore
from tidewell.plans import event_log_report, jobs
from tidewell.settings import Settings
from tidewell.sources import event_log, jdbc, tables


@pytest.fixture(scope="module")
def derby(spark):
    db = jdbc.Derby.memory(spark, "store")
    c = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(db.options["url"])
    s = c.createStatement()
    for sql in (
        "CREATE SCHEMA STORE",
        "CREATE TABLE STORE.TB (ID INT NOT NULL PRIMARY KEY, NAME VARCHAR(20), PRICE DECIMAL(8,2))",
        "INSERT INTO STORE.TB VALUES " + ", ".join(f"({i}, ' n{i} ', {i}.5)" for i in range(1, 101)),
        "CREATE TABLE STORE.NOTHING (ID INT NOT NULL, T VARCHAR(5))",
    ):
        s.execute(sql)
    c.close()
    return db


def test_partitioned_read(derby):
    df = derby.read("STORE.TB", 4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    assert derby.bounds("STORE.TB", "ID") == (1, 100)
    assert derby.read("STORE.NOTHING", 4).rdd.getNumPartitions() == 1
    assert derby.primary_key("STORE.TB") == ["ID"] and derby.primary_key("STORE.NOTHING") == []


def test_archived_rows_come_back_as_they_were(spark):
    rows = [(1, "O", 1.5), (None, None, None), (3, "", 1 / 3), (4, " a,b ", -1e300), (5, 'q"u', 4.9e-324), (6, "two\r\nlines", 1e17), (2**62, "x" * 32672, None), (7, '""', 0.1)]
    for kept in (rows, []):
        db = jdbc.Derby.archived(spark, "APP.ODD", spark.createDataFrame(kept, "id long, status string, price double").repartition(3))
        df = db.read("APP.ODD", 4)
        assert sorted(map(tuple, df.collect()), key=repr) == sorted(kept, key=repr) and df.rdd.getNumPartitions() == (4 if kept else 1)


def test_snapshot_stage_load_and_validate(spark, derby, tmp_path):
    store = SnapshotStore(spark, f"file://{tmp_path}/wh")
    name = jobs.snapshot(derby, store, "local", "STORE.TB", 2)
    direct = store.table(name).read()
    assert name == "local_store.tb" and {"last_applied_date", "id_iceberg"} <= set(direct.columns) and direct.where("NAME = 'n7'").count() == 1
    path = jobs.stage(derby, f"file://{tmp_path}/stage", "STORE.TB")
    other = SnapshotStore(spark, f"file://{tmp_path}/wh2")
    jobs.load(spark, other, "local", "STORE.TB", path, derby.primary_key("STORE.TB"))
    a, b = (t.read().select("ID", "NAME", "PRICE", "id_iceberg") for t in (store.table(name), other.table(name)))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    found = jobs.validate(derby, store, "local", ["STORE.TB"])
    steps = {r.step: r.ok for r in found.collect()}
    assert steps["count"] and steps["order"] and steps["key"] and "type" not in steps and "unreflected" not in steps
    assert found.where("step = 'nullability'").count() == 1  # Parquet folders don't hold "not null"


def test_findings(spark):
    mirror = spark.createDataFrame([], "B string, A int, P decimal(5,1), id_iceberg string").schema
    got = validation.findings("t", "mysql", {"a": "int", "b": "bigint", "p": "decimal(6,2)", "c": "text"}, {"a": False}, [], mirror)
    failed = {(step, column) for _, step, column, _, _, ok in got if not ok}
    assert failed == {("count", None), ("unreflected", "c"), ("order", None), ("type", "b"), ("nullability", "a"), ("key", None)}
    exact = validation.findings("t", "mysql", {"p": "decimal(6,2)"}, {}, [], mirror, exact_decimals=True)
    assert ("type", "p") in {(r[1], r[2]) for r in exact}
    assert validation.comment_changes(mirror, {"a": "it's", "b": "", "zz": "x"}) == {"A": "it's"}


def test_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS old_ns")
    spark.sql("CREATE TABLE old_ns.t (a int, b string) USING parquet")
    assert tables.discover(spark, [" OLD_NS ", "no_such_schema"]) == ["old_ns.t"]
    ran = validation.sync_comments(spark, "old_ns.t", {"A": "it's a"}, "all of it")
    assert len(ran) == 2 and validation.sync_comments(spark, "old_ns.t", {"A": "it's a"}, "all of it") == []
    spark.sql("INSERT INTO old_ns.t VALUES (1, 'x')")
    tables.rename_namespace(spark, "old_ns", "new_ns", ["t"], {"b": "c"})
    assert spark.table("new_ns.t").columns == ["a", "c"] and spark.table("new_ns.t").count() == 1
    assert tables.discover(spark, ["new_ns"]) == ["new_ns.t"]
    spark.range(4).selectExpr("id", "cast(id % 2 AS string) AS day").write.partitionBy("day").parquet(f"{tmp_path}/ext")
    tables.create_external(spark, "new_ns.ext", f"{tmp_path}/ext", "id long, day string", ["day"])
    assert spark.table("new_ns.ext").where("day = '1'").count() == 2
    seen = tables.inspect(spark, "new_ns.ext")
    assert {r[0] for r in seen["partitions"].collect()} == {"day=0", "day=1"} and "partitions" not in tables.inspect(spark, "new_ns.t")
    assert "CREATE TABLE" in seen["create"].first()[0]
    spark.sql("CREATE VIEW new_ns.v AS SELECT 1 AS one")
    assert tables.views(spark, "new_ns") == ["v"]
    spark.sql("DROP DATABASE new_ns CASCADE")


def _log(tmp_path, lines):
    (tmp_path / "events_1").write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return f"file://{tmp_path}"


def _task(stage, ms, failed=False, **metrics):
    info = {"Task ID": 1, "Launch Time": 0, "Finish Time": ms, "Failed": failed, "Executor ID": "1"}
    return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Task Info": info, "Task Metrics": {"Executor Run Time": ms, "JVM GC Time": ms // 10, "Executor CPU Time": ms * 500_000, **metrics}}


def test_event_log(spark, tmp_path):
    job = lambda i, at, d: {"Event": "SparkListenerJobStart", "Job ID": i, "Submission Time": at, "Properties": {"spark.job.description": d, "spark.jobGroup.id": f"g{d}", **({"spark.scheduler.pool": "p"} if i else {})}}
    sql = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
    lines = [
        "{broken", {"Event": "SparkListenerApplicationStart", "Timestamp": 0}, {"Event": "SparkListenerExecutorAdded", "Executor ID": "1", "Timestamp": 0, "Executor Info": {"Host": "h", "Total Cores": 2}, "timestamp": 1},
        {"Event": "SparkListenerBlockManagerAdded", "Block Manager ID": {"Executor ID": "1"}, "Maximum Memory": 1000, "Timestamp": 1},
        job(0, 0, "a\nx"), job(1, 1000, "b"), job(2, 1500, "never ends"), {"Event": "SparkListenerJobEnd", "Job ID": 0, "Completion Time": 5000}, {"Event": "SparkListenerJobEnd", "Job ID": 1, "Completion Time": 2500},
        {"Event": sql + "Start", "executionId": 1, "description": "MERGE INTO t", "time": 0}, {"Event": sql + "End", "executionId": 1, "time": 700}, {"Event": sql + "Start", "executionId": 2, "description": "select 1", "time": 0},
        _task(1, 100), _task(1, 100), _task(1, 900), _task(1, 9000, failed=True), _task(2, 50),
        {"Event": "SparkListenerEnvironmentUpdate", "Spark Properties": {"spark.app.name": "x", "my.Kafka.servers": "y"}},
    ]
    events = event_log.read(spark, _log(tmp_path, lines))
    rows = lambda f: [r.asDict() for r in f(events).collect()]
    assert {r["pool"]: r["jobs"] for r in rows(event_log_report.pools)} == {"default": 1, "p": 2}
    assert [(r["topic"], r["duration"], r["jobs"]) for r in rows(event_log_report.timeline)] == [("a", "5.0s", 1), ("b", "1.5s", 1)]
    assert rows(event_log_report.concurrency) == [{"max_running": 2}]
    assert [(r["sql_class"], r["n"], r["p50_ms"]) for r in rows(event_log_report.sql_classes)] == [("MERGE INTO", 1, 700)]
    assert [(r["stage_id"], r["ratio"], r["serious"]) for r in rows(event_log_report.skewed_stages)] == [(1, 9.0, False)]
    times = rows(event_log_report.task_times)[0]
    assert (times["tasks"], times["p50_ms"], times["max_ms"]) == (4, 100, 900)
    used = rows(event_log_report.executor_use)[0]
    assert used["tasks"] == 5 and used["utilisation_pct"] == 100.0 * 10150 / 2 and used["memory"] == 1000
    assert rows(event_log_report.memory)[0]["heap"] == 1000 and rows(event_log_report.cpu)[0]["cpu_pct"] == 50.0
    config = {r["key"]: r["value"] for r in rows(event_log_report.configuration)}
    assert config["spark.app.name"] == "x" and config["spark.driver.cores"] == "N/A" and config["my.Kafka.servers"] == "y"
    assert rows(event_log_report.streaming)[0]["queries"] == 0


def test_own_event_log_can_be_read(spark):
    spark.range(10).count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    folder = spark.conf.get("spark.eventLog.dir") + "/eventlog_v2_" + spark.sparkContext.applicationId
    assert event_log.jobs(event_log.read(spark, folder)).count() > 0


@pytest.mark.parametrize("ending", ["", ".zstd", ".zst", ".gz", ".zstd.compact"])
def test_logs_larger_than_a_split_are_read_whole(spark, tmp_path, ending):
    text = "\n".join(json.dumps({"Event": "SparkListenerJobStart", "Job ID": i, "Submission Time": i, "Properties": {"spark.job.description": f"d{i}é"}}) for i in range(5000)).encode()
    half = text.index(b"\n", len(text) // 2) + 1
    pack = gzip.compress if ending == ".gz" else zstandard.compress if ending else bytes
    (tmp_path / f"events_1_app{ending}").write_bytes(pack(text[:half]) + pack(text[half:]))  # two frames, as a flushed log has
    (tmp_path / "appstatus_app").write_text("")
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    try:
        for key in keys:
            spark.conf.set(key, "4096")
        events = event_log.read(spark, f"file://{tmp_path}")
        assert sorted(r.job_id for r in event_log.jobs(events).select("job_id").collect()) == list(range(5000))
        assert ending or events.rdd.getNumPartitions() > 4
    finally:
        for key in keys:
            spark.conf.unset(key)


def test_settings_precedence(tmp_path):
    (tmp_path / ".env").write_text("# x\nSTORAGE__BUCKET='b1'\nDATABASE__HOST=file\nKAFKA__BOOTSTRAP_SERVERS=k\n")
    got = Settings.load(str(tmp_path / ".env"), environ={"STORAGE__CATALOG": "c", "STORAGE__BUCKET": "b2"}, fetch=lambda config: {"host": "vault", "user": "u"}, storage={"data_path": "/d"})
    assert got.warehouse == "s3a://b2/d" and got.catalog == "c" and got.database == {"host": "file", "user": "u"} and got.kafka == {"bootstrap_servers": "k"}
    with pytest.raises(ValueError, match="vault settings lack"):
        Settings.load(None, environ={})


def test_catalog_options():
    glue = session.catalog_options(Settings(storage={"catalog": "c", "catalog_type": "glue", "bucket": "b"}))
    assert glue["spark.sql.catalog.c.warehouse"] == "s3a://b"
    rest = session.catalog_options(Settings(storage={"catalog": "c", "catalog_type": "polaris"}, polaris=dict.fromkeys(("uri", "oauth2_server_uri", "credential", "scope", "realm"), "x")))
    assert rest["spark.sql.catalog.c.type"] == "rest"
    with pytest.raises(ValueError, match="POLARIS"):
        session.catalog_options(Settings(storage={"catalog": "c", "catalog_type": "polaris"}))
    assert session.catalog_options(Settings()) == {}


def test_texts_of_figures(spark):
    from pyspark.sql import functions as F

    from tidewell.operators import reports

    ms = [reports.duration_text(F.lit(n)) for n in (5, 1500, 90_000, 7_200_000)]
    size = [reports.bytes_text(F.lit(n)) for n in (7, 2048, 5 * 1024**2, 3 * 1024**3)]
    assert tuple(spark.range(1).select(*ms, *size, reports.clock_text(F.lit(3_661_000))).first()) == ("5ms", "1.5s", "1.5m", "2.0h", "7B", "2.0KB", "5.0MB", "3.00GB", "01:01:01")


def test_http_registry_asks_once_for_each_id():
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from threading import Thread
    from urllib.error import HTTPError

    from tidewell.sources.registry import HttpRegistry

    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            asked.append(self.path)
            good = self.path.endswith("/33")
            self.send_response(200 if good else 404)
            self.end_headers()
            self.wfile.write(json.dumps({"schema": '{"type": "long"}'} if good else {"error_code": 40403}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    Thread(target=server.serve_forever, daemon=True).start()
    try:
        registry = HttpRegistry(f"http://127.0.0.1:{server.server_port}/")
        assert registry.schema(33) == registry.schema(33) == '{"type": "long"}' and asked == ["/schemas/ids/33"]
        with pytest.raises(HTTPError):
            registry.schema(34)
    finally:
        server.shutdown()


def test_kafka_options():
    from unittest.mock import MagicMock

    from tidewell.sources.streams import kafka_stream

    spark = MagicMock()
    kafka_stream(spark, "h:9092", "a.b.c", 500, '{"a.b.c": {"0": 7}}', {"kafka.security.protocol": "SSL"})
    spark.readStream.format.assert_called_once_with("kafka")
    given = spark.readStream.format.return_value.options.call_args.kwargs
    assert given == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a.b.c", "startingOffsets": '{"a.b.c": {"0": 7}}', "maxOffsetsPerTrigger": "500", "failOnDataLoss": "false",
        "kafka.security.protocol": "SSL",
    }
