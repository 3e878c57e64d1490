"""Tables and Parquet folders as sources."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidewell.functions.naming import checked

log = logging.getLogger(__name__)


def parquet(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    return spark.read.option("recursiveFileLookup", recursive).option("datetimeRebaseMode", "CORRECTED").parquet(path)


def discover(spark: SparkSession, schemas: Sequence[str], catalog: str | None = None) -> list[str]:
    """``schema.table`` of every table in ``schemas`` (trimmed, lower-cased); a schema that can't be listed is warned of."""
    found = []
    for schema in (s.strip().lower() for s in schemas):
        where = f"`{checked(catalog)}`.`{schema}`" if catalog else f"`{schema}`"
        try:
            found += [f"{schema}.{r['tableName']}" for r in spark.sql(f"SHOW TABLES IN {where}").collect() if not r["isTemporary"]]
        except Exception as e:  # one schema's failure must not keep the others from maintenance
            log.warning("tables of %s can't be listed: %s", schema, str(e).splitlines()[0])
    return found


def create_external(spark: SparkSession, name: str, path: str, columns: str, partitions: Sequence[str]) -> None:
    """A partitioned table over Parquet that is there; its partitions are discovered."""
    by = f" PARTITIONED BY ({', '.join(map(checked, partitions))})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{by} LOCATION '{path}'")
    if partitions:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def rename_namespace(spark: SparkSession, old: str, new: str, tables: Sequence[str], columns: dict[str, str] | None = None) -> list[str]:
    """Move ``tables`` to another namespace (by copy where the catalog can't rename across them), rename columns, and drop
    the old namespace if it is empty.  Returns the statements that ran."""
    done = []

    def run(sql: str) -> None:
        spark.sql(sql)
        done.append(sql)

    run(f"CREATE DATABASE IF NOT EXISTS {checked(new)}")
    for t in map(checked, tables):
        names = {a.lower(): checked(b) for a, b in (columns or {}).items()}
        have = spark.table(f"{checked(old)}.{t}").columns
        try:
            run(f"ALTER TABLE {old}.{t} RENAME TO {new}.{t}")
        except AnalysisException:
            picked = ", ".join(f"`{c}` AS `{names.get(c.lower(), c)}`" for c in have)
            run(f"CREATE TABLE {new}.{t} AS SELECT {picked} FROM {old}.{t}")
            run(f"DROP TABLE {old}.{t}")
            continue
        for c in have:
            if c.lower() in names:
                run(f"ALTER TABLE {new}.{t} RENAME COLUMN `{c}` TO {names[c.lower()]}")
    if not spark.catalog.listTables(old):
        run(f"DROP DATABASE {old}")
    return done


def inspect(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """What the catalog says about a table: its statement, properties and, where it has them, partitions."""
    found = {"create": spark.sql(f"SHOW CREATE TABLE {table}"), "properties": spark.sql(f"SHOW TBLPROPERTIES {table}")}
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        found["partitions"] = spark.sql(f"SHOW PARTITIONS {table}")
    return found


def views(spark: SparkSession, schema: str) -> list[str]:
    """The schema's own views; the statement lists every session's temporary views beside them."""
    return [r["viewName"] for r in spark.sql(f"SHOW VIEWS IN `{checked(schema)}`").collect() if not r["isTemporary"]]
