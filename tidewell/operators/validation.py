"""Differences between a source table and its mirror, as a table of findings; comments carried over."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidewell.functions.cleansing import AUDIT, KEY
from tidewell.functions.source_types import source_type

FINDINGS = "table_name string, step string, column_name string, source string, mirror string, ok boolean"
#: Columns that only mirrors have.
OWN_COLUMNS = frozenset({AUDIT, KEY})
#: Types that a mirror's format widens.
WIDENED = {T.ShortType: T.IntegerType, T.ByteType: T.IntegerType}


def findings(
    table: str, dialect: str, columns: Mapping[str, str], nullable: Mapping[str, bool], key: Sequence[str], mirror: T.StructType, exact_decimals: bool = False
) -> list[tuple]:
    """Steps in order: count, unreflected, order, type, nullability, key.  Names compare without case; columns that only
    the mirror has count but aren't listed.  ``exact_decimals`` compares precision and scale, too."""
    held = {f.name.lower(): f for f in mirror.fields if f.name not in OWN_COLUMNS}
    source = {c.lower(): c for c in columns}
    out: list[tuple] = [(table, "count", None, str(len(source)), str(len(held)), len(source) == len(held))]
    out += [(table, "unreflected", name, columns[name], None, False) for low, name in source.items() if low not in held]
    common = [c for c in source if c in held]
    there = [c for c in held if c in source]
    out.append((table, "order", None, ",".join(common), ",".join(there), common == there))
    for c in common:
        want, have = source_type(columns[source[c]], dialect), held[c].dataType
        same = type(want) is type(have) or WIDENED.get(type(want)) is type(have)
        if exact_decimals and isinstance(want, T.DecimalType) and isinstance(have, T.DecimalType):
            same = want == have
        if not same:
            out.append((table, "type", source[c], want.simpleString(), have.simpleString(), False))
    for c in common:
        may = nullable.get(source[c])
        if may is not None and may != held[c].nullable:
            out.append((table, "nullability", source[c], "null" if may else "not null", "null" if held[c].nullable else "not null", False))
    has_key = KEY in mirror.fieldNames()
    out.append((table, "key", None, ",".join(key) or None, KEY if has_key else None, bool(key) == has_key))
    return out


def findings_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), FINDINGS)


def comment_changes(mirror: T.StructType, comments: Mapping[str, str]) -> dict[str, str]:
    """Mirror column -> comment, where the source has one that differs."""
    by_name = {f.name.lower(): f for f in mirror.fields}
    return {
        by_name[c.lower()].name: text
        for c, text in comments.items()
        if text and c.lower() in by_name and by_name[c.lower()].metadata.get("comment", "") != text
    }


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sync_comments(spark: SparkSession, table: str, columns: Mapping[str, str], comment: str | None) -> list[str]:
    """Bring a catalog table's comments in line with the source's; returns the statements that ran."""
    ran = [f"ALTER TABLE {table} ALTER COLUMN `{c}` COMMENT {_quoted(t)}" for c, t in comment_changes(spark.table(table).schema, columns).items()]
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Comment'").collect()}
    if comment and described.get("Comment") != comment:
        ran.append(f"ALTER TABLE {table} SET TBLPROPERTIES ('comment' = {_quoted(comment)})")
    for sql in ran:
        spark.sql(sql)
    return ran
