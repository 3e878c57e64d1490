"""Avro payloads: Spark's own functions where the module is loaded, else a decoder after the Avro specification.

The decoder runs in Arrow batches and works by column: all payloads of a batch take the same step through the schema
together, in numpy, and each field becomes an Arrow array at once (:class:`Columns`).  Payloads with arrays or maps, whose
steps differ from value to value, are decoded one by one, by closures that a schema is compiled to once per task.  Named types
(an envelope's ``after`` is the record its ``before`` defines) resolve to their definition.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Callable, Iterator, Mapping, Sequence
from decimal import Decimal
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Reader = Callable[[bytes, int], tuple[Any, int]]


def schema_of(schema: str | Mapping) -> dict:
    return json.loads(schema) if isinstance(schema, str) else dict(schema)


def _long(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7


def _fixed(code: str) -> Reader:
    kind = struct.Struct("<" + code)
    return lambda data, at: (kind.unpack_from(data, at)[0], at + kind.size)


def _bytes(data: bytes, at: int) -> tuple[bytes, int]:
    n, at = _long(data, at)
    if n < 0 or at + n > len(data):
        raise ValueError("payload ends inside a value")
    return data[at : at + n], at + n


def _string(data: bytes, at: int) -> tuple[str, int]:
    raw, at = _bytes(data, at)
    return raw.decode(), at


_PRIMITIVES: dict[str, Reader] = {
    "null": lambda data, at: (None, at), "boolean": lambda data, at: (data[at] != 0, at + 1), "int": _long, "long": _long,
    "float": _fixed("f"), "double": _fixed("d"), "bytes": _bytes, "string": _string,
}
_SPARK = {
    "null": T.NullType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "bytes": T.BinaryType(), "string": T.StringType(),
}


class Codec:
    """Readers, writers and Spark types of a schema and the named types in it."""

    def __init__(self, schema: str | Mapping) -> None:
        self.names: dict[str, Any] = {}
        self.schema = schema_of(schema)
        self._collect(self.schema)

    def _collect(self, kind: Any) -> None:
        if isinstance(kind, list):
            for k in kind:
                self._collect(k)
        elif isinstance(kind, dict):
            if "name" in kind and kind.get("type") in ("record", "enum", "fixed"):
                self.names[kind["name"]] = kind
                if kind.get("namespace"):
                    self.names[f"{kind['namespace']}.{kind['name']}"] = kind
            for f in kind.get("fields", []):
                self._collect(f["type"])
            for k in ("items", "values"):
                self._collect(kind.get(k))
            if isinstance(kind.get("type"), (dict, list)):
                self._collect(kind["type"])

    def _plain(self, kind: Any) -> Any:
        """A type without references and needless wrapping."""
        while True:
            if isinstance(kind, str) and kind in self.names:
                kind = self.names[kind]
            elif isinstance(kind, dict) and (isinstance(kind["type"], (dict, list)) or kind["type"] in self.names):
                kind = kind["type"]
            else:
                return kind

    def spark_type(self, kind: Any = None) -> T.DataType:
        kind = self._plain(self.schema if kind is None else kind)
        if isinstance(kind, list):
            some = [k for k in kind if k != "null"]
            if len(some) > 1:
                return T.StructType([T.StructField(f"member{i}", self.spark_type(k)) for i, k in enumerate(some)])
            return self.spark_type(some[0]) if some else T.NullType()
        name = kind if isinstance(kind, str) else kind["type"]
        if isinstance(kind, dict):
            if kind.get("logicalType") == "decimal":
                return T.DecimalType(kind["precision"], kind.get("scale", 0))
            if name == "record":
                return T.StructType([T.StructField(f["name"], self.spark_type(f["type"])) for f in kind["fields"]])
            if name == "array":
                return T.ArrayType(self.spark_type(kind["items"]))
            if name == "map":
                return T.MapType(T.StringType(), self.spark_type(kind["values"]))
            if name == "enum":
                return T.StringType()
            if name == "fixed":
                return T.BinaryType()
        return _SPARK[name]

    def reader(self, kind: Any = None) -> Reader:
        kind = self._plain(self.schema if kind is None else kind)
        if isinstance(kind, list):
            branches = [self.reader(k) for k in kind]
            some = [i for i, k in enumerate(kind) if k != "null"]
            member = {i: f"member{j}" for j, i in enumerate(some)} if len(some) > 1 else {}

            def union(data: bytes, at: int) -> tuple[Any, int]:
                i, at = _long(data, at)
                value, at = branches[i](data, at)
                return ({member[i]: value} if i in member else value), at

            return union
        name = kind if isinstance(kind, str) else kind["type"]
        if name == "record":
            fields = [(f["name"], self.reader(f["type"])) for f in kind["fields"]]

            def record(data: bytes, at: int) -> tuple[dict, int]:
                out = {}
                for field, read in fields:
                    out[field], at = read(data, at)
                return out, at

            return record
        if name in ("array", "map"):
            item = self.reader(kind["items" if name == "array" else "values"])

            def blocks(data: bytes, at: int) -> tuple[Any, int]:
                out: list = []
                while True:
                    n, at = _long(data, at)
                    if n == 0:
                        return out, at
                    if n < 0:
                        n, (_, at) = -n, _long(data, at)
                    for _ in range(n):
                        if name == "map":
                            key, at = _string(data, at)
                            value, at = item(data, at)
                            out.append((key, value))
                        else:
                            value, at = item(data, at)
                            out.append(value)

            return blocks
        if name == "enum":
            symbols = kind["symbols"]
            return lambda data, at: ((lambda x: (symbols[x[0]], x[1]))(_long(data, at)))
        size = kind.get("size") if name == "fixed" else None
        plain: Reader = (lambda data, at: (data[at : at + size], at + size)) if size is not None else _PRIMITIVES[name]
        if isinstance(kind, dict) and kind.get("logicalType") == "decimal":
            scale = kind.get("scale", 0)

            def decimal(data: bytes, at: int) -> tuple[Decimal, int]:
                raw, at = plain(data, at)
                return Decimal(int.from_bytes(raw, "big", signed=True)).scaleb(-scale), at

            return decimal
        return plain

    def writer(self, kind: Any = None) -> Callable[[Any], bytes]:
        """An encoder of records of primitives and unions of null with one (for tests and fixtures)."""
        kind = self._plain(self.schema if kind is None else kind)
        if isinstance(kind, list):
            branches = [self.writer(k) for k in kind]
            null, other = kind.index("null"), next(i for i, k in enumerate(kind) if k != "null")
            return lambda v: _encoded_long(null) if v is None else _encoded_long(other) + branches[other](v)
        name = kind if isinstance(kind, str) else kind["type"]
        if name == "record":
            fields = [(f["name"], self.writer(f["type"])) for f in kind["fields"]]
            return lambda v: b"".join(write(v[n]) for n, write in fields)
        if isinstance(kind, dict) and kind.get("logicalType") == "decimal":

            def decimal(v: Decimal) -> bytes:
                n = int(v.scaleb(kind.get("scale", 0)))
                raw = n.to_bytes(n.bit_length() // 8 + 1, "big", signed=True)
                return _encoded_long(len(raw)) + raw

            return decimal
        if name == "array":
            item = self.writer(kind["items"])
            return lambda v: (_encoded_long(len(v)) + b"".join(map(item, v)) if v else b"") + b"\x00"
        if name == "enum":
            return lambda v: _encoded_long(kind["symbols"].index(v))
        if name == "fixed":
            return bytes
        return {
            "null": lambda v: b"", "boolean": lambda v: b"\x01" if v else b"\x00", "int": _encoded_long, "long": _encoded_long,
            "float": struct.Struct("<f").pack, "double": struct.Struct("<d").pack, "bytes": lambda v: _encoded_long(len(v)) + v,
            "string": lambda v: _encoded_long(len(v.encode())) + v.encode(),
        }[name]


def _encoded_long(n: int) -> bytes:
    n = (n << 1) ^ (n >> 63)
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


class Columns:
    """Decodes payloads that lie one after the other in a buffer, all together."""

    def __init__(self, codec: Codec, data: bytes | memoryview, begin: np.ndarray, end: np.ndarray) -> None:
        self.codec, self.end = codec, end
        self.data = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(16, np.uint8)])  # a step may look beyond the end
        self.at = begin.astype(np.int64)

    @classmethod
    def fit(cls, codec: Codec, kind: Any = None) -> bool:
        """Whether all payloads of a type take the same steps, but for branches of unions."""
        kind = codec._plain(codec.schema if kind is None else kind)
        if isinstance(kind, list):
            return all(cls.fit(codec, k) for k in kind)
        if isinstance(kind, dict) and kind["type"] == "record":
            return bool(kind["fields"]) and all(cls.fit(codec, f["type"]) for f in kind["fields"])
        return not (isinstance(kind, dict) and (kind["type"] in ("array", "map") or (kind.get("logicalType") == "decimal" and kind["precision"] > 38)))

    def decode(self) -> pa.Array:
        out = self._value(self.codec.schema, np.arange(len(self.at)))
        if (self.at != self.end).any():
            raise ValueError("bytes after an Avro value")
        return out

    def _moved(self, rows: np.ndarray, by: np.ndarray | int) -> np.ndarray:
        """Where ``rows`` are, before they move on."""
        start = self.at[rows]
        if (np.asarray(by) < 0).any() or (start + by > self.end[rows]).any():
            raise ValueError("payload ends inside a value")
        self.at[rows] = start + by
        return start

    def _longs(self, rows: np.ndarray) -> np.ndarray:
        value = np.zeros(len(rows), np.uint64)
        open_ = np.arange(len(rows))
        for shift in range(0, 70, 7):
            byte = self.data[self._moved(rows[open_], 1)]
            value[open_] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
            open_ = open_[byte >= 0x80]
            if not len(open_):
                return (value >> np.uint64(1)).astype(np.int64) ^ -(value & np.uint64(1)).astype(np.int64)
        raise ValueError("a number of more than ten bytes")

    def _gathered(self, rows: np.ndarray, n: np.ndarray, kind: pa.DataType) -> pa.Array:
        start = self._moved(rows, n)
        ends = np.cumsum(n)
        held = self.data[np.repeat(start - (ends - n), n) + np.arange(int(n.sum()))]
        return pa.Array.from_buffers(kind, len(rows), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(held)])

    def _decimals(self, rows: np.ndarray, n: np.ndarray, precision: int, scale: int) -> pa.Array:
        if (n > 16).any():
            raise ValueError("a decimal of more than 16 bytes")
        start = self._moved(rows, n)
        out = np.empty((len(rows), 16), np.uint8)  # little-endian; beyond the payload its sign goes on
        sign = np.where((n > 0) & (self.data[start] >= 0x80), 0xFF, 0).astype(np.uint8)
        for i in range(16):
            out[:, i] = np.where(i < n, self.data[np.maximum(start + n - 1 - i, 0)], sign)
        return pa.Array.from_buffers(pa.decimal128(precision, scale), len(rows), [None, pa.py_buffer(out)])

    def _union(self, kinds: list, rows: np.ndarray) -> pa.Array:
        branch = self._longs(rows)
        if ((branch < 0) | (branch >= len(kinds))).any():
            raise ValueError("a branch that the union doesn't have")
        members = []
        for k, kind in enumerate(kinds):
            if kind == "null":
                continue
            own = branch == k
            place = pa.array(np.cumsum(own) - 1, mask=~own)
            members.append(self._value(kind, rows[own]).take(place))
        if len(members) > 1:
            mask = pa.array(np.isin(branch, [k for k, kind in enumerate(kinds) if kind == "null"]))
            return pa.StructArray.from_arrays(members, [f"member{i}" for i in range(len(members))], mask=mask)
        return members[0] if members else pa.nulls(len(rows))

    def _value(self, kind: Any, rows: np.ndarray) -> pa.Array:
        kind = self.codec._plain(kind)
        if isinstance(kind, list):
            return self._union(kind, rows)
        name = kind if isinstance(kind, str) else kind["type"]
        if name == "record":
            return pa.StructArray.from_arrays([self._value(f["type"], rows) for f in kind["fields"]], [f["name"] for f in kind["fields"]])
        if name in ("bytes", "fixed", "string"):
            n = np.full(len(rows), kind["size"]) if name == "fixed" else self._longs(rows)
            if isinstance(kind, dict) and kind.get("logicalType") == "decimal":
                return self._decimals(rows, n, kind["precision"], kind.get("scale", 0))
            out = self._gathered(rows, n, pa.string() if name == "string" else pa.binary())
            out.validate(full=True)
            return out
        if name in ("int", "long"):
            values = self._longs(rows)
            return pa.array(values, pa.int64()).cast(pa.int32()) if name == "int" else pa.array(values)
        if name in ("float", "double"):
            width = 4 if name == "float" else 8
            start = self._moved(rows, width)
            return pa.array(np.ascontiguousarray(self.data[start[:, None] + np.arange(width)]).view(f"<f{width}").reshape(-1))
        if name == "boolean":
            return pa.array(self.data[self._moved(rows, 1)] != 0)
        if name == "enum":
            return pa.array(kind["symbols"], pa.string()).take(pa.array(self._longs(rows)))
        return pa.nulls(len(rows))


def _decoded_batch(codec: Codec, values: pa.Array, arrow: pa.DataType) -> pa.Array:
    """A batch of payloads by column; null stays null."""
    values = values.cast(pa.binary())
    good = values.drop_null()
    offsets = np.frombuffer(good.buffers()[1], np.int32)[good.offset : good.offset + len(good) + 1].astype(np.int64)
    found = Columns(codec, good.buffers()[2] or b"", offsets[:-1], offsets[1:]).decode()
    if values.null_count:
        there = values.is_valid().to_numpy(zero_copy_only=False)
        found = found.take(pa.array(np.cumsum(there) - 1, mask=~there))
    return found.cast(arrow)


def decoded(df: DataFrame, column: str, schema: str | Mapping, into: str = "record") -> DataFrame:
    """``df`` with the Avro values of ``column`` as ``into`` in its place; null stays null, a bad payload fails the query.

    Where Spark's Avro module is loaded it decodes them, in the JVM; else this module does, in Arrow batches.
    """
    if avro_module_loaded(df.sparkSession):
        return df.select(*[c for c in df.columns if c != column], native_from_avro(F.col(column), schema).alias(into))
    codec = Codec(schema)
    kind = codec.spark_type()
    others = [c for c in df.columns if c != column]
    out = T.StructType([df.schema[c] for c in others] + [T.StructField(into, kind)])
    source = codec.schema

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        own, arrow = Codec(source), to_arrow_type(kind)
        if Columns.fit(own):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], _decoded_batch(own, batch.column(len(others)), arrow)], [*others, into])
            return
        read = own.reader()
        for batch in batches:
            values = []
            for data in batch.column(len(others)).to_pylist():
                if data is None:
                    values.append(None)
                    continue
                value, end = read(data, 0)
                if end != len(data):
                    raise ValueError(f"{len(data) - end} bytes after an Avro value")
                values.append(value)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(others)], pa.array(values, arrow)], [*others, into])

    return df.select(*others, column).mapInArrow(decode, out)


def encoded(df: DataFrame, schema: str | Mapping, into: str = "payload", keep: Sequence[str] = ()) -> DataFrame:
    """One Avro value per row of a record schema's columns, beside the columns to ``keep``."""
    source = schema_of(schema)
    names = [f["name"] for f in source["fields"]]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        write = Codec(source).writer()
        for batch in batches:
            values = [write(row) for row in batch.select(list(range(len(names)))).rename_columns(names).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[len(names) :], pa.array(values, pa.binary())], [*keep, into])

    out = T.StructType([df.schema[c] for c in keep] + [T.StructField(into, T.BinaryType())])
    kept = [F.col(c).alias(f"_kept_{c}") for c in keep]
    return df.select(*names, *kept).mapInArrow(encode, out)


def native_from_avro(column: Column, schema: str | Mapping) -> Column:
    """Spark's ``from_avro``; needs the spark-avro module."""
    from pyspark.sql.avro.functions import from_avro

    return from_avro(column, json.dumps(schema_of(schema)), {"mode": "FAILFAST"})


def avro_module_loaded(spark) -> bool:
    return spark._jvm.java.lang.Thread.currentThread().getContextClassLoader().getResource("org/apache/spark/sql/avro/AvroDataToCatalyst.class") is not None
