"""Databases over JDBC: connections, catalog lookups in the source, whole and range-partitioned reads."""

from __future__ import annotations

import shutil
import zipfile
from abc import ABC, abstractmethod
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.naming import checked
from tidewell.scratch import scratch_path


@dataclass(frozen=True)
class Connection:
    host: str
    port: int
    user: str
    password: str

    def __repr__(self) -> str:
        return f"Connection({self.host}:{self.port}, {self.user})"


class Database(ABC):
    """A kind of database: how to reach it, quote a column, and ask its catalog about a table.

    Every lookup runs in the source; identifiers are checked before they become part of a statement.
    """

    kind: str

    def __init__(self, spark: SparkSession, options: Mapping[str, str]) -> None:
        self.spark, self.options = spark, dict(options)

    def query(self, sql: str) -> DataFrame:
        """A statement that the source runs."""
        return self.spark.read.format("jdbc").options(**self.options).option("query", sql).load()

    def _named(self, sql: str, value: str) -> dict[str, object]:
        return {r[0]: r[value] for r in self.query(sql).collect()}

    @abstractmethod
    def quoted(self, column: str) -> str: ...

    @abstractmethod
    def parts(self, table: str) -> tuple[str, ...]: ...

    @abstractmethod
    def primary_key(self, table: str) -> list[str]: ...

    @abstractmethod
    def partition_key(self, table: str) -> str | None: ...

    @abstractmethod
    def columns(self, table: str) -> dict[str, str]:
        """Column -> type as the catalog writes it, in order."""

    @abstractmethod
    def nullable(self, table: str) -> dict[str, bool]: ...

    @abstractmethod
    def column_comments(self, table: str) -> dict[str, str]: ...

    @abstractmethod
    def table_comment(self, table: str) -> str | None: ...

    @abstractmethod
    def size(self, table: str) -> dict[str, str]:
        """Estimated rows and megabytes, as ``table_rows`` and ``table_size``."""

    def source_name(self, table: str) -> str:
        """The table as statements name it."""
        return ".".join(self.quoted(p) for p in self.parts(table))

    def bounds(self, table: str, column: str) -> tuple[object, object]:
        c = self.quoted(checked(column))
        row = self.query(f"SELECT min({c}) AS lower_bound, max({c}) AS upper_bound FROM {self.source_name(table)}").first()
        return row[0], row[1]

    def read(self, table: str, partitions: int = 1, key: str | None = None) -> DataFrame:
        """The table; in ``partitions`` ranges of ``key`` (by default the catalog's choice) where it has rows and such a key."""
        reader = self.spark.read.format("jdbc").options(**self.options).option("dbtable", self.source_name(table))
        key = key or (self.partition_key(table) if partitions > 1 else None)
        low, high = self.bounds(table, key) if key and partitions > 1 else (None, None)
        if low is None:
            return reader.load()
        ranges = {"partitionColumn": self.quoted(key), "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}
        return reader.options(**ranges).load()


def _mounted(spark: SparkSession, path: str) -> Path:
    """Where a folder is for programs that know nothing of Hadoop's file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    uri = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).resolvePath(at).toUri()
    if uri.getScheme() != "file":
        raise ValueError(f"a database file needs a mounted scratch folder (spark.checkpoint.dir), not {uri.toString()}")
    return Path(uri.getPath())


def _joined(folder: Path) -> Path:
    """The part files of a folder as one, which grows out of the first."""
    first, *others = sorted(folder.glob("part-*"))
    with first.open("ab") as out:
        for p in others:
            with p.open("rb") as part:
                shutil.copyfileobj(part, out, 1 << 20)
            p.unlink()
    return first


class MySql(Database):
    kind = "mysql"

    @classmethod
    def connect(cls, spark: SparkSession, c: Connection, database: str = "") -> MySql:
        url = f"jdbc:mysql://{c.host}:{c.port}/{database}?zeroDateTimeBehavior=convertToNull&useUnicode=true&characterEncoding=UTF-8"
        return cls(spark, {"url": url, "driver": "com.mysql.cj.jdbc.Driver", "user": c.user, "password": c.password})

    def quoted(self, column: str) -> str:
        return f"`{column}`"

    def parts(self, table: str) -> tuple[str, str]:
        schema, name = table.split(".")
        return checked(schema), checked(name)

    def _where(self, table: str) -> str:
        schema, name = self.parts(table)
        return f"table_schema = '{schema}' AND table_name = '{name}'"

    def _columns(self, table: str, value: str) -> str:
        return f"SELECT column_name AS name, {value} AS v FROM information_schema.columns WHERE {self._where(table)} ORDER BY ordinal_position"

    def primary_key(self, table: str) -> list[str]:
        sql = "SELECT column_name AS name FROM information_schema.key_column_usage"
        return [r[0] for r in self.query(f"{sql} WHERE {self._where(table)} AND constraint_name = 'PRIMARY' ORDER BY ordinal_position").collect()]

    def partition_key(self, table: str) -> str | None:
        """The auto-increment column, else the first that is a number or a date."""
        fit = "extra LIKE '%auto_increment%' OR data_type IN ('int', 'bigint', 'date', 'datetime', 'timestamp')"
        order = "CASE WHEN extra LIKE '%auto_increment%' THEN 0 ELSE 1 END, ordinal_position"
        row = self.query(f"SELECT column_name AS name FROM information_schema.columns WHERE {self._where(table)} AND ({fit}) ORDER BY {order} LIMIT 1").first()
        return row[0] if row else None

    def columns(self, table: str) -> dict[str, str]:
        return self._named(self._columns(table, "column_type"), "v")

    def nullable(self, table: str) -> dict[str, bool]:
        return {k: v == "YES" for k, v in self._named(self._columns(table, "is_nullable"), "v").items()}

    def column_comments(self, table: str) -> dict[str, str]:
        return {k: v or "" for k, v in self._named(self._columns(table, "column_comment"), "v").items()}

    def table_comment(self, table: str) -> str | None:
        row = self.query(f"SELECT table_comment AS v FROM information_schema.tables WHERE {self._where(table)}").first()
        return (row[0] or None) if row else None

    def size(self, table: str) -> dict[str, str]:
        sql = "SELECT table_rows, round((data_length + index_length) / 1048576.0, 0) AS table_size FROM information_schema.tables"
        row = self.query(f"{sql} WHERE {self._where(table)}").first()
        return {k.lower(): str(v) for k, v in row.asDict().items()} if row else {}


class SqlServer(Database):
    kind = "sqlserver"

    @classmethod
    def connect(cls, spark: SparkSession, c: Connection, database: str = "") -> SqlServer:
        named = f";databaseName={database}" if database else ""
        url = f"jdbc:sqlserver://{c.host}:{c.port}{named};encrypt=false;"
        return cls(spark, {"url": url, "driver": "com.microsoft.sqlserver.jdbc.SQLServerDriver", "user": c.user, "password": c.password})

    def quoted(self, column: str) -> str:
        return f"[{column}]"

    def parts(self, table: str) -> tuple[str, str, str]:
        database, schema, name = table.split(".")
        return checked(database), checked(schema), checked(name)

    def _where(self, table: str, prefix: str = "") -> str:
        database, schema, name = self.parts(table)
        return f"{prefix}table_catalog = '{database}' AND {prefix}table_schema = '{schema}' AND {prefix}table_name = '{name}'"

    def _id(self, table: str) -> str:
        _, schema, name = self.parts(table)
        return f"object_id('{schema}.{name}')"

    def _columns(self, table: str, value: str) -> dict[str, object]:
        """Sorted here: a statement in parentheses may not be ordered."""
        rows = self.query(f"SELECT column_name AS name, {value} AS v, ordinal_position AS at FROM information_schema.columns WHERE {self._where(table)}")
        return {r[0]: r[1] for r in sorted(rows.collect(), key=lambda r: r[2])}

    def primary_key(self, table: str) -> list[str]:
        rows = self.query(
            "SELECT u.column_name AS name, u.ordinal_position AS at FROM information_schema.table_constraints k JOIN information_schema.key_column_usage u "
            "ON u.constraint_schema = k.constraint_schema AND u.constraint_name = k.constraint_name "
            f"WHERE k.constraint_type = 'PRIMARY KEY' AND {self._where(table, 'k.')}"
        ).collect()
        return [r[0] for r in sorted(rows, key=lambda r: r[1])]

    def partition_key(self, table: str) -> str | None:
        """The identity column, else the first date."""
        identity = f"columnproperty({self._id(table)}, column_name, 'IsIdentity')"
        rows = self.query(
            f"SELECT column_name AS name, coalesce({identity}, 0) AS is_identity, ordinal_position AS at FROM information_schema.columns "
            f"WHERE {self._where(table)} AND ({identity} = 1 OR data_type IN ('date', 'datetime', 'datetime2', 'timestamp'))"
        ).collect()
        return min(rows, key=lambda r: (-r[1], r[2]))[0] if rows else None

    def columns(self, table: str) -> dict[str, str]:
        return self._columns(table, "data_type")

    def nullable(self, table: str) -> dict[str, bool]:
        return {k: v == "YES" for k, v in self._columns(table, "is_nullable").items()}

    def _described(self, table: str, minor: str) -> str:
        return (
            f"SELECT c.name AS name, c.column_id AS at, cast(p.value AS nvarchar(4000)) AS v FROM sys.columns c LEFT JOIN sys.extended_properties p "
            f"ON p.major_id = c.object_id AND p.minor_id = {minor} AND p.name = 'MS_Description' WHERE c.object_id = {self._id(table)}"
        )

    def column_comments(self, table: str) -> dict[str, str]:
        return {r[0]: r[2] or "" for r in sorted(self.query(self._described(table, "c.column_id")).collect(), key=lambda r: r[1])}

    def table_comment(self, table: str) -> str | None:
        row = self.query(
            f"SELECT cast(value AS nvarchar(4000)) AS v FROM sys.extended_properties WHERE major_id = {self._id(table)} AND minor_id = 0 AND name = 'MS_Description'"
        ).first()
        return (row[0] or None) if row else None

    def size(self, table: str) -> dict[str, str]:
        row = self.query(
            "SELECT max(p.rows) AS table_rows, cast(sum(a.total_pages) * 8.0 / 1024 AS float) AS table_size FROM sys.indexes i "
            "JOIN sys.partitions p ON p.object_id = i.object_id AND p.index_id = i.index_id JOIN sys.allocation_units a ON a.container_id = p.partition_id "
            f"WHERE i.object_id = {self._id(table)}"
        ).first()
        return {k: str(v) for k, v in row.asDict().items()} if row else {}


class Derby(Database):
    """The database that comes with Spark; for tests and small stand-alone use.  Names are upper-cased by it."""

    kind = "mysql"  # its types are read like MySQL's

    @classmethod
    def at(cls, spark: SparkSession, place: str) -> Derby:
        system = spark.sparkContext._jvm.java.lang.System
        if system.getProperty("derby.stream.error.file") is None:  # else it writes a log beside whoever runs it
            system.setProperty("derby.stream.error.file", "/dev/null")
        return cls(spark, {"url": f"jdbc:derby:{place}", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})

    @classmethod
    def memory(cls, spark: SparkSession, name: str) -> Derby:
        """In the memory of whichever process connects, so for local sessions only."""
        return cls.at(spark, f"memory:{name};create=true")

    @classmethod
    def archived(cls, spark: SparkSession, table: str, rows: DataFrame) -> Derby:
        """A read-only database of one table that the driver and all executors open, in the scratch folder (a mounted one).

        Spark writes the rows as lines, which the driver's Derby loads in bulk on disk.  The archive isn't compressed: a page is a seek.
        """
        path = scratch_path(spark, "database")
        text = [F.concat(F.lit('"'), F.replace(F.col(f"`{c}`").cast("string"), F.lit('"'), F.lit('""')), F.lit('"')) for c in rows.columns]
        lines = F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in text])  # null: nothing, not even quotes
        rows.select(lines.alias("value")).write.option("compression", "none").text(f"{path}/lines")
        folder = _mounted(spark, path)
        cls.at(spark, f"{folder}/db")._load(table, rows.dtypes, _joined(folder / "lines"))
        shutil.rmtree(folder / "lines")
        with zipfile.ZipFile(folder / "db.jar", "w", zipfile.ZIP_STORED) as archive:
            for p in sorted((folder / "db").rglob("*")):
                archive.write(p, p.relative_to(folder))
        shutil.rmtree(folder / "db")
        return cls.at(spark, f"jar:({folder}/db.jar)db")

    def _load(self, table: str, dtypes: list[tuple[str, str]], file: Path) -> None:
        """Create the database and the table, take the file's lines, and shut the database down."""
        schema, name = self.parts(table)
        columns = ", ".join(f"{self.quoted(checked(c))} {'VARCHAR(32672)' if kind == 'string' else kind.upper()}" for c, kind in dtypes)
        connect, url = self.spark.sparkContext._jvm.java.sql.DriverManager.getConnection, self.options["url"]
        connection = connect(f"{url};create=true")
        try:
            statement = connection.createStatement()
            statement.execute("CALL SYSCS_UTIL.SYSCS_SET_DATABASE_PROPERTY('derby.storage.pageReservedSpace', '0')")  # rows never grow
            statement.execute(f"CREATE TABLE {self.source_name(table)} ({columns})")
            place = str(file).replace("'", "''")
            statement.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_TABLE('{schema}', '{name}', '{place}', ',', '\"', 'UTF-8', 1)")
        finally:
            connection.close()
            try:
                connect(f"{url};shutdown=true")
            except Py4JJavaError as ended:
                if ended.java_exception.getSQLState() != "08006":  # it says by an exception that it is down
                    raise

    def quoted(self, column: str) -> str:
        return f'"{column}"'

    def parts(self, table: str) -> tuple[str, str]:
        schema, name = table.split(".")
        return checked(schema), checked(name)

    def _columns(self, table: str, value: str) -> dict[str, object]:
        schema, name = self.parts(table)
        rows = self.query(
            f"SELECT c.columnname AS name, {value} AS v, c.columnnumber AS pos FROM sys.syscolumns c JOIN sys.systables t ON t.tableid = c.referenceid "
            f"JOIN sys.sysschemas s ON s.schemaid = t.schemaid WHERE s.schemaname = '{schema}' AND t.tablename = '{name}'"
        ).collect()
        return {r[0]: r[1] for r in sorted(rows, key=lambda r: r[2])}

    def primary_key(self, table: str) -> list[str]:
        """Through the driver's metadata: the catalog keeps key columns in a descriptor that SQL can't open."""
        schema, name = self.parts(table)
        connection = self.spark.sparkContext._jvm.java.sql.DriverManager.getConnection(self.options["url"])
        try:
            found, rows = connection.getMetaData().getPrimaryKeys(None, schema, name), []
            while found.next():
                rows.append((found.getInt("KEY_SEQ"), found.getString("COLUMN_NAME")))
        finally:
            connection.close()
        return [c for _, c in sorted(rows)]

    def partition_key(self, table: str) -> str | None:
        fit = ("INT", "BIGINT", "DATE", "TIMESTAMP")
        return next((c for c, t in self.columns(table).items() if t.split()[0] in fit), None)

    def columns(self, table: str) -> dict[str, str]:
        kinds = {k: str(v).replace(" NOT NULL", "") for k, v in self._columns(table, "cast(c.columndatatype AS varchar(128))").items()}
        return {k: {"INTEGER": "INT", "CLOB(2147483647)": "TEXT"}.get(v, v) for k, v in kinds.items()}

    def nullable(self, table: str) -> dict[str, bool]:
        return {k: "NOT NULL" not in str(v) for k, v in self._columns(table, "cast(c.columndatatype AS varchar(128))").items()}

    def column_comments(self, table: str) -> dict[str, str]:
        return dict.fromkeys(self.columns(table), "")

    def table_comment(self, table: str) -> str | None:
        return None

    def size(self, table: str) -> dict[str, str]:
        return {"table_rows": str(self.query(f"SELECT count(*) AS n FROM {self.source_name(table)}").first()[0])}


DATABASES: dict[str, type[Database]] = {"mysql": MySql, "sqlserver": SqlServer}
