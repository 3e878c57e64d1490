import time

import pytest

from tidewell.operators import iceberg
from tidewell.operators.maintenance import Maintainer, ModifiedTables
from tidewell.operators.store import CommitConflict, SnapshotStore


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, f"file://{tmp_path}/wh")


def rows(spark, *values):
    return spark.createDataFrame(list(values), "id int, v string")


def test_versions(spark, store):
    t = store.table("ns.t")
    assert not t.exists()
    t.replace(rows(spark, (1, "a"), (2, "b")), {"key": "id"})
    t.append(rows(spark, (3, "c")))
    t.upsert(rows(spark, (2, "B"), (4, "d")), "id")
    t.delete(rows(spark, (1, "")), "id")
    assert sorted(map(tuple, t.read().collect())) == [(2, "B"), (3, "c"), (4, "d")]
    assert sorted(map(tuple, t.read(2).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    assert [v.operation for v in t.history()] == ["replace", "append", "upsert", "delete"] and t.version().properties == {"key": "id"}
    latest = spark.createDataFrame([(3, None, "d"), (9, "n", "c")], "id int, v string, op string")
    t.apply_changes(latest, "id")
    assert sorted(map(tuple, t.read().collect())) == [(2, "B"), (4, "d"), (9, "n")]


def test_batches_of_changes_are_deltas_until_they_are_folded(spark, store, monkeypatch):
    from tidewell.operators import store as store_module

    t = store.table("ns.d")
    t.replace(rows(spark, *[(i, "base") for i in range(6)], (None, "none")))
    batch = lambda *r: spark.createDataFrame(list(r), "id int, v string, op string")
    want = {None: "none", **dict.fromkeys(range(6), "base")}
    for step in range(4):
        t.apply_changes(batch((step, f"u{step}", "u"), (step + 1, None, "d"), (10 + step, "new", "c"), (5, "x", None)), "id")
        want[step], want[10 + step] = f"u{step}", "new"
        want.pop(step + 1, None)
        assert len(t.version().parts) == 1 and len(t.version().deltas) == step + 1
        assert {r.id: r.v for r in t.read().collect()} == want
    assert t.expire(2**60) == 4 and {r.id: r.v for r in t.read().collect()} == want  # the data and deltas of the version that stays
    t.append(rows(spark, (1, "again")))
    want[1] = "again"
    assert t.version().deltas == () and {r.id: r.v for r in t.read().collect()} == want
    t.apply_changes(batch((1, "later", "u")), "id")
    assert t.compact()[0] > 1 and t.version().deltas == () and t.read().where("id = 1").first().v == "later"
    monkeypatch.setattr(store_module, "MAX_DELTAS", 2)
    for _ in range(3):
        t.apply_changes(batch((1, "x", "u")), "id")
        assert len(t.version().deltas) < 2


def test_a_token_is_part_of_the_append(spark, store):
    t = store.table("ns.o")
    t.create(rows(spark).schema)
    assert t.append_once(rows(spark, (1, "a")), "last", "7") and not t.append_once(rows(spark, (1, "a")), "last", "7")
    assert t.append_once(rows(spark, (2, "a")), "last", "8") and t.read().count() == 2


def test_update(spark, store):
    from pyspark.sql import functions as F

    t = store.table("ns.t")
    t.replace(rows(spark, (1, "old"), (2, None), (3, "x")))
    t.update(F.col("v") == "old", v=F.lit("new"))
    assert sorted(map(tuple, t.read().collect()), key=repr) == [(1, "new"), (2, None), (3, "x")]


def test_a_faster_writer_wins(spark, store):
    t = store.table("ns.t")
    t.replace(rows(spark, (1, "a")))

    def change(df):
        t.append(rows(spark, (5, "z")))
        return df

    with pytest.raises(CommitConflict):
        t.rewrite(change, "x")
    assert sorted(map(tuple, t.read().collect())) == [(1, "a"), (5, "z")]


def test_compaction_expiry_and_orphans(spark, store, tmp_path):
    t = store.table("ns.t")
    t.create(rows(spark).schema)
    assert t.read().isEmpty()
    for i in range(5):
        t.append(rows(spark, (i, "x")))
    before, after = t.compact()
    assert before >= 5 and after == 1 and t.read().count() == 5
    assert t.compact() == (0, 0)
    assert t.expire(int(time.time() * 1000) + 1000) == 6
    assert len(t.history()) == 1 and t.read().count() == 5
    t._write(rows(spark, (7, "lost")))
    assert t.remove_orphans(0) == [] and len(t.remove_orphans(int(time.time() * 1000) + 5000)) == 1
    assert t.read().count() == 5


def test_copy_rename_and_listing(spark, store, tmp_path):
    store.table("a.t").replace(rows(spark, (1, "x")))
    other = SnapshotStore(spark, f"file://{tmp_path}/other")
    store.copy("a.t", other)
    store.rename("a.t", "b.t")
    assert store.tables([" A ", "b", "none"]) == ["b.t"] and other.table("a.t").read().count() == 1


def test_copy_across_switches_credentials_for_the_second_half(spark, store, tmp_path):
    from tidewell.operators.store import copy_across

    store.table("a.t").replace(rows(spark, (1, "x")), {"key": "id"})
    system = spark.sparkContext._jvm.java.lang.System
    system.setProperty("tidewell.test.key", "first")
    seen = []

    class Target(SnapshotStore):
        def table(self, name):
            seen.append((name, system.getProperty("tidewell.test.key"), system.getProperty("tidewell.test.other")))
            return super().table(name)

    other = Target(spark, f"file://{tmp_path}/other")
    copy_across("a.t", store, other, f"file://{tmp_path}/staging", {"tidewell.test.key": "second", "tidewell.test.other": "o"}, "b.t")
    assert seen == [("b.t", "second", "o")] and system.getProperty("tidewell.test.key") == "first" and system.getProperty("tidewell.test.other") is None
    assert other.table("b.t").read().count() == 1 and other.table("b.t").properties() == {"key": "id"} and not list((tmp_path / "staging").iterdir())


def test_maintainer(spark, store):
    m = Maintainer(spark, store, "dag")
    m.ensure_ledgers()
    m.ensure_ledgers()
    t = store.table("ns.t")
    t.replace(rows(spark, (1, "a")))
    t.append(rows(spark, (2, "b")))
    assert m.compact_due(["ns.t"], 3600) == ["ns.t"]
    assert m.compact_due(["ns.t"], 3600) == []
    assert not m.compact("ns.missing")
    got = {(r.table_name, r.procedure_type, r.status) for r in m.ledger.read().collect()}
    assert {("t", "rewrite_data_files", "success"), ("t", "expire_snapshots", "success"), ("missing", "rewrite_data_files", "failed"), ("missing", "expire_snapshots", "skipped")} <= got
    assert m.run_job(["ns"]) == ["ns.t"]
    assert m.ledger.read().where("procedure_type = 'remove_orphan_files'").count() == 1


def test_modified_tables():
    seen = ModifiedTables()
    seen.mark("a")
    seen.mark("a")
    assert seen.take() == {"a"} and seen.take() == set()


def test_statements():
    assert iceberg.merge_sql("c.n.t", "s", ["id"]) == "MERGE INTO `c`.`n`.`t` t USING s s ON t.`id` = s.`id` WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    assert "WHERE EXISTS (SELECT 1 FROM s s WHERE t.`id` = s.`id`)" in iceberg.delete_sql("n.t", "s", ["id"])
    assert "NOT IN (SELECT a, b, max(at) FROM `n`.`l` GROUP BY a, b)" in iceberg.purge_sql("n.l", ["a", "b"], "at", 7)
    assert iceberg.procedure_sql("c", "remove_orphan_files", "n.t", older_than="x") == "CALL c.system.remove_orphan_files(table => 'n.t', older_than => x)"
    with pytest.raises(ValueError, match="identifier"):
        iceberg.merge_sql("n.t; drop", "s", ["id"])


def test_a_mix_of_changes_against_a_dict(spark, store):
    from tidewell.operators import changes
    from tidewell.sources.generator import change_mix

    t = store.table("ns.mix")
    t.replace(spark.range(50).selectExpr("id", "cast(0 AS double) AS amount", "'base' AS note"))
    want = {i: (0.0, "base") for i in range(50)}
    for step in range(3):
        mix = change_mix(spark, 200, 50, seed=step, first_offset=step * 200)
        again = change_mix(spark, 200, 50, seed=step, first_offset=step * 200).repartition(3)
        rows = sorted(map(tuple, mix.collect()))
        assert rows == sorted(map(tuple, again.collect()))
        for _, key, op, amount, note in rows:
            if op == "d":
                want.pop(key, None)
            else:
                want[key] = (amount, note)
        latest = changes.latest_per_key(mix, "id", "offset").drop("offset")
        t.apply_changes(latest, "id")
    assert {r.id: (r.amount, r.note) for r in t.read().collect()} == want


class Recorder:
    """A session that notes statements and answers those that are read."""

    def __init__(self, spark, answers=()):
        self.real, self.ran, self.answers = spark, [], dict(answers)
        self.catalog = spark.catalog

    def sql(self, text):
        self.ran.append(text)
        found = next((rows for start, rows in self.answers.items() if text.startswith(start)), [])
        return type("Answer", (), {"collect": lambda _: found, "first": lambda _: found[0] if found else None})()


def test_iceberg_tables_run_their_statements_in_order(spark):
    fake = Recorder(spark, {"CALL c.system.rewrite_data": [{"rewritten_data_files_count": 4, "added_data_files_count": 1}], "CALL c.system.rewrite_position": [{"rewritten_delete_files_count": 2, "added_delete_files_count": 1}], "CALL c.system.expire": [{"deleted_data_files_count": 9}], "SHOW TBLPROPERTIES": [("last", "7"), ("comment", "old")]})
    t = iceberg.IcebergStore(fake, "c", "s3://b/w").table("ns.t")
    latest = spark.createDataFrame([(1, "a", "u"), (2, None, "d")], "id int, v string, op string")
    t.apply_changes(latest, "id")
    assert [x.split(" ")[0] for x in fake.ran] == ["MERGE", "DELETE"] and all("global_temp.changes_" in x for x in fake.ran)
    fake.ran.clear()
    t.apply_changes(latest.where("op = 'd'"), "id")
    assert [x.split(" ")[0] for x in fake.ran] == ["DELETE"]  # no rows, no commit
    fake.ran.clear()
    t.create(latest.schema)
    assert fake.ran[0] == "CREATE DATABASE IF NOT EXISTS `c`.`ns` LOCATION 's3://b/w/ns'"
    assert "`id` int, `v` string" in fake.ran[1] and "'commit.retry.num-retries' = '20'" in fake.ran[1] and "'format-version' = '2'" in fake.ran[1]
    fake.ran.clear()
    t.purge(["a", "b"], "at", 7)
    t.with_column_comments({"v": "it's"})
    t.with_comment("new")
    t.with_comment("old")
    assert fake.ran == [iceberg.purge_sql("c.ns.t", ["a", "b"], "at", 7), "ALTER TABLE `c`.`ns`.`t` ALTER COLUMN `v` COMMENT 'it\\'s'", "SHOW TBLPROPERTIES `c`.`ns`.`t`", "ALTER TABLE `c`.`ns`.`t` SET TBLPROPERTIES ('comment' = 'new')", "SHOW TBLPROPERTIES `c`.`ns`.`t`"]
    assert t.compact() == (4, 1) and t.compact_deletes() == (2, 1) and t.expire(0, 2) == 9 and "retain_last => 2" in fake.ran[-1]
    assert not t.append_once(latest, "last", "7")
    t.rewrite_manifests()
    assert fake.ran[-1] == "CALL c.system.rewrite_manifests(table => 'ns.t')"


def test_iceberg_replace_sets_properties_for_keyed_tables():
    from unittest.mock import MagicMock

    for properties, keyed in (({"key": "id"}, True), ({}, False)):
        spark, df = MagicMock(), MagicMock()
        writer = df.writeTo.return_value.using.return_value
        writer.tableProperty.return_value = writer
        iceberg.IcebergStore(spark, "c").table("ns.t").replace(df, properties)
        given = {c.args[0]: c.args[1] for c in writer.tableProperty.call_args_list}
        df.writeTo.assert_called_once_with("c.ns.t")
        df.writeTo.return_value.using.assert_called_once_with("iceberg")
        assert ("history.expire.max-snapshot-age-ms" in given) == keyed and given["write.spark.accept-any-schema"] == "false"
        writer.createOrReplace.assert_called_once_with()
    stream = MagicMock()
    iceberg.IcebergTable(stream, "c", "ns.t").stream(0, 100)
    stream.readStream.format.assert_called_once_with("iceberg")
    iceberg.IcebergTable(stream, "c", "ns.t").metadata("history")
    stream.table.assert_called_once_with("c.ns.t.history")


def test_jobs_keep_tables_where_the_settings_say():
    from tidewell.plans.jobs import table_store
    from tidewell.settings import Settings

    load = lambda kind: Settings.load(None, environ={"STORAGE__CATALOG": "lake", "STORAGE__BUCKET": "b", "STORAGE__CATALOG_TYPE": kind}, fetch=lambda c: {}, storage={"data_path": "/d"})
    assert isinstance(table_store(None, load("local")), SnapshotStore)
    found = table_store(None, load("glue"))
    assert isinstance(found, iceberg.IcebergStore) and found.catalog == "lake" and found.table("n.t").full == "lake.n.t"
