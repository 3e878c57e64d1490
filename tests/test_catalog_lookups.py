"""The lookups that MySQL and SQL Server would run, run over tables of the same names and columns in DuckDB."""

import duckdb
import pytest

from tidewell.sources import jdbc


class Answer(list):
    def first(self):
        return self[0] if self else None

    def collect(self):
        return self


class Row(tuple):
    names = ()

    def __getitem__(self, key):
        return super().__getitem__(self.names.index(key) if isinstance(key, str) else key)

    def asDict(self):  # noqa: N802
        return dict(zip(self.names, self, strict=True))


def over(kind, setup):
    """A database of ``kind`` whose statements run in DuckDB."""
    con = duckdb.connect()
    con.execute(setup)

    class Fake(kind):
        def query(self, sql):
            cur = con.execute(sql.replace("information_schema.", "info."))
            names = [c[0] for c in cur.description]
            return Answer(type("R", (Row,), {"names": names})(r) for r in cur.fetchall())

    return Fake(None, {})


MYSQL = """
CREATE SCHEMA info;
CREATE TABLE info.columns (table_schema text, table_name text, column_name text, ordinal_position int, column_type text, data_type text, is_nullable text, extra text, column_comment text);
INSERT INTO info.columns VALUES
  ('shop', 'sales', 'note', 2, 'varchar(20)', 'varchar', 'YES', '', 'what was said'), ('shop', 'sales', 'day', 1, 'date', 'date', 'NO', '', NULL),
  ('shop', 'sales', 'id', 3, 'int unsigned', 'int', 'NO', 'auto_increment', ''), ('shop', 'plain', 'v', 1, 'text', 'text', 'YES', '', ''),
  ('shop', 'dated', 'a', 1, 'text', 'text', 'YES', '', ''), ('shop', 'dated', 'd', 2, 'datetime', 'datetime', 'YES', '', ''), ('shop', 'dated', 'n', 3, 'bigint', 'bigint', 'YES', '', ''),
  ('other', 'sales', 'x', 1, 'int', 'int', 'YES', '', '');
CREATE TABLE info.key_column_usage (table_schema text, table_name text, column_name text, ordinal_position int, constraint_name text);
INSERT INTO info.key_column_usage VALUES ('shop', 'sales', 'id', 2, 'PRIMARY'), ('shop', 'sales', 'day', 1, 'PRIMARY'), ('shop', 'sales', 'note', 1, 'fk'), ('other', 'sales', 'x', 1, 'PRIMARY');
CREATE TABLE info.tables (table_schema text, table_name text, table_comment text, table_rows bigint, data_length bigint, index_length bigint);
INSERT INTO info.tables VALUES ('shop', 'sales', 'what was sold', 12, 3145728, 1048576), ('shop', 'plain', '', 0, 0, 0);
"""

SQLSERVER = """
CREATE SCHEMA info;
CREATE SCHEMA sys;
CREATE MACRO object_id(x) AS CASE x WHEN 'dbo.sales' THEN 7 WHEN 'dbo.plain' THEN 8 END;
CREATE MACRO columnproperty(id, c, p) AS CASE WHEN id = 7 AND c = 'id' AND p = 'IsIdentity' THEN 1 WHEN id = 7 THEN 0 END;
CREATE TABLE info.columns (table_catalog text, table_schema text, table_name text, column_name text, ordinal_position int, data_type text, is_nullable text);
INSERT INTO info.columns VALUES
  ('db', 'dbo', 'sales', 'day', 2, 'date', 'YES'), ('db', 'dbo', 'sales', 'id', 3, 'int', 'NO'), ('db', 'dbo', 'sales', 'a', 1, 'money', 'YES'),
  ('db', 'dbo', 'plain', 'n', 1, 'int', 'YES'), ('db', 'dbo', 'plain', 't', 3, 'datetime2', 'YES'), ('db', 'dbo', 'plain', 'u', 2, 'datetime', 'YES'), ('db', 'x', 'sales', 'z', 1, 'int', 'YES');
CREATE TABLE info.table_constraints (table_catalog text, table_schema text, table_name text, constraint_schema text, constraint_name text, constraint_type text);
INSERT INTO info.table_constraints VALUES ('db', 'dbo', 'sales', 'dbo', 'pk', 'PRIMARY KEY'), ('db', 'dbo', 'sales', 'dbo', 'uq', 'UNIQUE'), ('db', 'x', 'sales', 'x', 'pk', 'PRIMARY KEY');
CREATE TABLE info.key_column_usage (constraint_schema text, constraint_name text, column_name text, ordinal_position int);
INSERT INTO info.key_column_usage VALUES ('dbo', 'pk', 'id', 2), ('dbo', 'pk', 'day', 1), ('dbo', 'uq', 'a', 1), ('x', 'pk', 'z', 1);
CREATE TABLE sys.columns (object_id int, name text, column_id int);
INSERT INTO sys.columns VALUES (7, 'day', 2), (7, 'id', 3), (7, 'a', 1), (9, 'q', 1);
CREATE TABLE sys.extended_properties (major_id int, minor_id int, name text, value text);
INSERT INTO sys.extended_properties VALUES (7, 0, 'MS_Description', 'what was sold'), (7, 3, 'MS_Description', 'its number'), (7, 1, 'Other', 'no'), (9, 0, 'MS_Description', 'else');
CREATE TABLE sys.indexes (object_id int, index_id int);
INSERT INTO sys.indexes VALUES (7, 1), (9, 1);
CREATE TABLE sys.partitions (object_id int, index_id int, partition_id int, rows bigint);
INSERT INTO sys.partitions VALUES (7, 1, 70, 12), (9, 1, 90, 5);
CREATE TABLE sys.allocation_units (container_id int, total_pages bigint);
INSERT INTO sys.allocation_units VALUES (70, 256), (70, 128), (90, 1);
"""


def test_mysql():
    db = over(jdbc.MySql, MYSQL)
    assert db.primary_key("shop.sales") == ["day", "id"] and db.primary_key("shop.plain") == []
    assert db.partition_key("shop.sales") == "id" and db.partition_key("shop.dated") == "d" and db.partition_key("shop.plain") is None
    assert list(db.columns("shop.sales").items()) == [("day", "date"), ("note", "varchar(20)"), ("id", "int unsigned")]
    assert db.nullable("shop.sales") == {"day": False, "note": True, "id": False}
    assert db.column_comments("shop.sales") == {"day": "", "note": "what was said", "id": ""}
    assert db.table_comment("shop.sales") == "what was sold" and db.table_comment("shop.plain") is None and db.table_comment("shop.none") is None
    assert db.size("shop.sales")["table_rows"] == "12" and float(db.size("shop.sales")["table_size"]) == 4.0
    assert db.source_name("shop.sales") == "`shop`.`sales`"
    with pytest.raises(ValueError, match="identifier"):
        db.primary_key("shop.sales'--")


def test_sqlserver():
    db = over(jdbc.SqlServer, SQLSERVER)
    assert db.primary_key("db.dbo.sales") == ["day", "id"] and db.primary_key("db.dbo.plain") == []
    assert db.partition_key("db.dbo.sales") == "id" and db.partition_key("db.dbo.plain") == "u"
    assert list(db.columns("db.dbo.sales").items()) == [("a", "money"), ("day", "date"), ("id", "int")]
    assert db.nullable("db.dbo.sales") == {"a": True, "day": True, "id": False}
    assert list(db.column_comments("db.dbo.sales").items()) == [("a", ""), ("day", ""), ("id", "its number")]
    assert db.table_comment("db.dbo.sales") == "what was sold" and db.table_comment("db.dbo.plain") is None
    assert db.size("db.dbo.sales") == {"table_rows": "12", "table_size": "3.0"}
    assert db.source_name("db.dbo.sales") == "[db].[dbo].[sales]"
