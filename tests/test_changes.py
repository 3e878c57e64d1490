from datetime import UTC, datetime

from pyspark.sql import functions as F

from tidewell.operators import changes, ledger


def test_latest_split_and_apply(spark):
    log = spark.createDataFrame([(1, 1, "c", 10), (1, 3, "u", 11), (2, 2, "d", 0), (3, 4, None, 5), (9, 5, "r", 7)], "id int, offset int, op string, v int")
    latest = changes.latest_per_key(log, "id", "offset")
    assert {(r.id, r.v) for r in changes.upserts(latest).collect()} == {(1, 11), (9, 7)}
    assert [r.id for r in changes.deletes(latest).collect()] == [2]
    target = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (None, 1)], "id int, v int")
    two_steps = changes.deleted(changes.upserted(target, changes.upserts(latest), "id"), changes.deletes(latest), "id")
    want = [(1, 11), (3, 0), (9, 7), (None, 1)]
    for got in (two_steps, changes.applied(target, latest, "id")):
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_empty_changes_leave_the_target(spark):
    target = spark.createDataFrame([(1, 0)], "id int, v int")
    none = spark.createDataFrame([], "id int, v int, op string")
    assert [tuple(r) for r in changes.applied(target, none, "id").collect()] == [(1, 0)]


def test_batch_stats_and_versions(spark):
    batch = spark.createDataFrame([(5, "2024-01-01 00:00:00.123456", 10), (9, "2024-01-02 00:00:00", 9), (7, None, None)], "offset long, timestamp string, s int").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    assert tuple(changes.batch_stats(batch).first()) == (3, "2024-01-02 00:00:00.000000", 5, 9)
    assert changes.by_schema_version(batch, "s") == [9, 10]


def test_retention_keeps_the_newest_and_what_a_null_shields(spark):
    rows = [(None, 1), (None, 5), (1, 1), (1, 4), (2, 5), (3, 2), (3, 5), (4, 5), (4, 9), (6, 2), (6, 2)]
    df = spark.createDataFrame(rows, "k int, t int")
    got = sorted(map(tuple, ledger.kept_rows(df, ["k"], "t", F.lit(8)).collect()), key=repr)
    assert got == sorted([(None, 5), (1, 4), (2, 5), (3, 5), (4, 5), (4, 9), (6, 2), (6, 2)], key=repr)
    df.createOrReplaceTempView("l")
    native = spark.sql("SELECT * FROM l EXCEPT ALL (SELECT * FROM l WHERE t < 8 AND (k, t) NOT IN (SELECT k, max(t) FROM l GROUP BY k))")
    assert sorted(map(tuple, native.collect()), key=repr) == got
    spark.catalog.dropTempView("l")


def test_should_run():
    now = datetime(2024, 1, 1, 12, tzinfo=UTC)
    assert ledger.should_run(None, 10, now)
    assert ledger.should_run(datetime(2024, 1, 1, 8), 14_400, now)
    assert not ledger.should_run(datetime(2024, 1, 1, 8, 0, 1), 14_400, now)


def test_ledger_rows_take_any_text(spark):
    df = ledger.ledger_rows(spark, ledger.MAINTENANCE_LEDGER, [{"dag_id": "a'b", "error_message": "it's \\ \"so\""}])
    assert df.first()["error_message"] == "it's \\ \"so\"" and df.first()["batch_id"] is None


def test_index_percentiles_against_sorting(spark):
    import random

    from tidewell.operators import reports

    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.randint(0, 9), rng.randint(-(10**6), 10**6), rng.random(), None])) for _ in range(3000)] + [("one", 5.0), ("c", float("nan")), ("c", 1.0)]
    rows = [(g, None if v is None else float(v)) for g, v in rows]
    shares = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p999": 0.999}
    got = {r.g: tuple(r)[1:] for r in reports.index_percentiles(spark.createDataFrame(rows, "g string, v double").repartition(3), ["g"], "v", shares).collect()}
    for g in {g for g, _ in rows}:
        held = sorted((v for k, v in rows if k == g and v is not None), key=lambda v: (v != v, v))
        assert repr(got[g]) == repr(tuple(held[int(len(held) * s)] for s in shares.values()))
    assert reports.index_percentiles(spark.createDataFrame([], "g string, v double"), ["g"], "v", shares).collect() == []


def test_concurrency_against_counting(spark, monkeypatch):
    import random

    from tidewell.operators import reports

    monkeypatch.setattr(reports, "STRETCH", 7)
    rng = random.Random(2)
    spans = [(a, a + rng.choice([0, 3, 40, 700])) for a in (rng.randint(100, 5000) for _ in range(60))] + [(9000, 9400), (None, 5), (6, None)]
    got = {r.point: r.running for r in reports.concurrency(spark.createDataFrame(spans, "a long, b long"), "a", "b", 10).collect()}
    whole = [(a, b) for a, b in spans if a is not None and b is not None]
    t0, t1 = min(a for a, _ in spans if a is not None), max(b for _, b in spans if b is not None)
    want = {p: sum(a <= p <= b for a, b in whole) for p in range(t0, t1, 10)}
    assert got == {p: n for p, n in want.items() if n}
