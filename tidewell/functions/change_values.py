"""Values in change records: wire header, logical types, envelope schema."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes before the Avro payload: a marker and a big-endian schema id.
HEADER = 5


def schema_id(message: Column) -> Column:
    """The wire header's schema id as an int; null for null (a tombstone) and for what is shorter than a header."""
    return F.when(F.octet_length(message) >= HEADER, F.conv(F.hex(F.substring(message, 2, 4)), 16, 10).cast("int"))


def payload(message: Column) -> Column:
    """What follows the wire header."""
    return F.when(F.octet_length(message) >= HEADER, F.substring(message, HEADER + 1, 2147483647))


def logical_value(column: Column, logical: str, source_zone: str = "Asia/Seoul") -> Column:
    """A change record's number as the date or time that its logical type means; other types pass.

    Datetimes are wall-clock numbers of ``source_zone`` and become UTC; null and 0 are null, for 0 is the default that
    schemas put where nothing was.  Zoned timestamps are ISO text, which the cast to the catalog's type reads.
    """
    if logical == "io.debezium.time.Date":
        return F.date_add(F.lit("1970-01-01").cast("date"), column.cast("int"))
    if logical == "io.debezium.time.MicroTime":
        return F.timestamp_micros(column.cast("long"))
    to_instant = {"io.debezium.time.Timestamp": F.timestamp_millis, "io.debezium.time.MicroTimestamp": F.timestamp_micros}.get(logical)
    if to_instant is None:
        return column
    return F.when(column != 0, F.to_utc_timestamp(to_instant(column.cast("long")), source_zone))


def _named(kind, seen: dict) -> None:
    """Collect named types of an Avro schema."""
    if isinstance(kind, list):
        for k in kind:
            _named(k, seen)
    elif isinstance(kind, dict):
        if kind.get("type") in ("record", "enum", "fixed") and "name" in kind:
            seen[kind["name"]] = kind
            if kind.get("namespace"):
                seen[f"{kind['namespace']}.{kind['name']}"] = kind
        for f in kind.get("fields", []):
            _named(f["type"], seen)
        for inner in ("items", "values"):
            if inner in kind:
                _named(kind[inner], seen)
        if isinstance(kind.get("type"), (dict, list)):
            _named(kind["type"], seen)


def logical_types(schema: str | Mapping) -> dict[str, str]:
    """Column -> logical (else plain) type of the row record in an envelope schema's ``before`` or ``after``.

    Of a union the first branch that isn't null counts.  Without a row record there are no columns.
    """
    envelope = json.loads(schema) if isinstance(schema, str) else schema
    named: dict = {}
    _named(dict(envelope), named)

    def branch(kind):
        return next((k for k in kind if k != "null"), None) if isinstance(kind, list) else kind

    for f in envelope.get("fields", []):
        if f.get("name") in ("before", "after"):
            row = branch(f["type"])
            row = named.get(row) if isinstance(row, str) else row
            if isinstance(row, dict) and "fields" in row:
                kinds = {c["name"]: branch(c["type"]) for c in row["fields"] if c.get("name")}
                return {c: (k.get("connect.name") or k.get("type") if isinstance(k, dict) else k) for c, k in kinds.items() if k}
    return {}
