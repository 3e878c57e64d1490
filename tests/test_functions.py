import hashlib
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions import change_values as cv
from tidewell.functions import cleansing, naming
from tidewell.functions.source_types import source_type


@pytest.mark.parametrize(
    ("text", "dialect", "want"),
    [
        ("tinyint(1)", "mysql", T.BooleanType()),
        ("tinyint(4)", "mysql", T.IntegerType()),
        ("int(11) unsigned", "mysql", T.LongType()),
        ("int(10)", "mysql", T.IntegerType()),
        ("varchar(20) character set utf8", "mysql", T.StringType()),
        ("decimal( 9 , 2 ) unsigned", "mysql", T.DecimalType(9, 2)),
        ("int unsigned", "mysql", T.LongType()),
        ("bigint unsigned", "mysql", T.LongType()),
        ("decimal(12,8)", "mysql", T.DecimalType(12, 8)),
        ("decimal(5)", "mysql", T.DecimalType(5, 0)),
        ("decimal", "mysql", T.DecimalType(10, 0)),
        ("year", "mysql", T.StringType()),
        (" DATETIME(6) ", "mysql", T.TimestampType()),
        ("money", "sqlserver", T.DecimalType(19, 4)),
        ("datetime2", "sqlserver", T.TimestampType()),
        ("uniqueidentifier", "sqlserver", T.StringType()),
        ("time", "sqlserver", T.StringType()),
        ("smallint", "sqlserver", T.ShortType()),
        ("decimal(5,1)", "sqlserver", T.DecimalType(38, 10)),
        ("", "mysql", T.StringType()),
        ("(3)", "sqlserver", T.StringType()),
    ],
)
def test_source_type(text, dialect, want):
    assert source_type(text, dialect) == want


def test_unknown_dialects_are_refused():
    with pytest.raises(ValueError, match="oracle"):
        source_type("int", "oracle")


def test_wire_header(spark):
    rows = spark.createDataFrame([(bytearray(b"\0\0\0\0\x21abc"),), (bytearray(b"\0\0\0"),), (None,), (bytearray(b"\0\0\0\1\0"),)], "m binary")
    got = rows.select(cv.schema_id(F.col("m")), cv.payload(F.col("m"))).collect()
    assert [tuple(r) for r in got] == [(33, b"abc"), (None, None), (None, None), (256, b"")]


def test_logical_values(spark):
    noon = datetime(2031, 8, 9, 12, 30, 15, 250_000)
    since = noon - datetime(1970, 1, 1)
    whole = since // timedelta(microseconds=1)
    micros = lambda n, kind: F.unix_micros(cv.logical_value(F.lit(n), f"io.debezium.time.{kind}"))
    got = spark.range(1).select(
        cv.logical_value(F.lit(since.days), "io.debezium.time.Date"), micros(whole % 86_400_000_000, "MicroTime"), micros(whole // 1000, "Timestamp"), micros(whole + 7, "MicroTimestamp"),
        micros(0, "Timestamp"), micros(None, "MicroTimestamp"), cv.logical_value(F.lit(noon.isoformat() + "Z"), "io.debezium.time.ZonedTimestamp").cast("timestamp").cast("string"),
    ).first()
    nine_hours = 9 * 3_600_000_000  # the source zone's offset
    assert got[0] == noon.date() and got[1] == whole % 86_400_000_000
    assert got[2] == whole - nine_hours and got[3] == whole + 7 - nine_hours
    assert got[4] is None and got[5] is None and got[6] == "2031-08-09 12:30:15.25"


def test_surrogate_key(spark):
    one = spark.sql("SELECT 5 AS shop, DATE '2031-08-09' AS day, 81 AS till, 'blue door' AS note, cast(null AS string) AS n")
    got = one.select(cleansing.surrogate_key(["shop", "day", "till", "note"]), cleansing.surrogate_key(["shop", "n", "note"]), cleansing.surrogate_key(["shop", "note"])).first()
    assert got[0] == hashlib.md5(b"5|2031-08-09|81|blue door").hexdigest()
    assert got[1] == got[2] == hashlib.md5(b"5|blue door").hexdigest()  # nulls are skipped


def test_cleansing(spark):
    rows = spark.createDataFrame([("  a ", "\tb\u3000", 1)], "x string, y string, n int")
    assert tuple(cleansing.trim_strings(rows).first()) == ("a", "\tb\u3000", 1)
    staged = rows.withColumnRenamed("x", cleansing.AUDIT_BEFORE)
    assert cleansing.AUDIT in cleansing.renamed_audit(staged).columns
    assert cleansing.renamed_audit(rows).columns[-1] == cleansing.AUDIT
    assert cleansing.with_key(rows, []).columns == rows.columns
    with pytest.raises(ValueError, match="week"):
        cleansing.with_date_parts(rows, "x", ["week"])


def test_names():
    assert naming.topic_target("Local", "p.Store.TB_Upper").name == "local_store.tb_upper"
    assert naming.source_target("local", "store.dbo.T").name == "local_store.t"
    for bad in ("a.b", "a.b.c.d"):
        with pytest.raises(ValueError, match="three parts"):
            naming.topic_target("s", bad)
    with pytest.raises(ValueError, match="identifier"):
        naming.checked("a; drop")


_ROW = {
    "type": "record", "name": "Sale",
    "fields": [
        {"name": "till", "type": "int"},
        {"name": "day", "type": {"type": "int", "connect.name": "io.debezium.time.Date"}},
        {"name": "closed", "type": [{"type": "long", "connect.name": "io.debezium.time.Timestamp", "default": 0}, "null"]},
        {"name": "sum", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 9, "scale": 3, "connect.name": "org.apache.kafka.connect.data.Decimal"}]},
    ],
}
CHANGE = {
    "type": "record", "name": "Change",
    "fields": [{"name": "before", "type": ["null", _ROW]}, {"name": "after", "type": ["null", "Sale"]}, {"name": "op", "type": "string"}, {"name": "ts_ms", "type": ["null", "long"]}],
}


def test_logical_types():
    assert cv.logical_types(CHANGE) == {"till": "int", "day": "io.debezium.time.Date", "closed": "io.debezium.time.Timestamp", "sum": "org.apache.kafka.connect.data.Decimal"}
    assert cv.logical_types({"fields": [{"name": "after", "type": "string"}]}) == {}


def test_avro_named_types_unions_and_decimals(spark):
    from tidewell.sources import avro

    codec = avro.Codec(CHANGE)
    row = {"till": 81, "day": 22500, "closed": None, "sum": Decimal("-12.250")}
    values = [{"before": None, "after": row, "op": "c", "ts_ms": 5}, {"before": row, "after": None, "op": "d", "ts_ms": None}]
    data = [codec.writer()(v) for v in values]
    assert [codec.reader()(x, 0) for x in data] == [(v, len(x)) for v, x in zip(values, data, strict=True)]
    frame = avro.decoded(spark.createDataFrame([(bytearray(x),) for x in data] + [(None,)], "value binary"), "value", CHANGE, "v")
    got = frame.select("v.after.till", "v.after.sum", "v.before.till", "v.op").collect()
    assert [tuple(r) for r in got] == [(81, Decimal("-12.250"), None, "c"), (None, None, 81, "d"), (None, None, None, None)]


def test_avro_arrays_maps_and_members():
    from tidewell.sources.avro import Codec

    kind = {"type": "record", "name": "R", "fields": [{"name": "a", "type": {"type": "array", "items": "long"}}, {"name": "u", "type": ["int", "string"]}, {"name": "m", "type": {"type": "map", "values": "int"}}]}
    data = b"\x04\x02\x04\x00" + b"\x02\x02x" + b"\x01\x06\x02k\x0a\x00"
    assert Codec(kind).reader()(data, 0) == ({"a": [1, 2], "u": {"member1": "x"}, "m": [("k", 5)]}, len(data))


def test_avro_is_decoded_natively_where_the_module_is_loaded(spark, monkeypatch):
    from tidewell.sources import avro

    asked = []
    monkeypatch.setattr(avro, "avro_module_loaded", lambda s: True)
    monkeypatch.setattr(avro, "native_from_avro", lambda column, schema: asked.append(schema) or F.struct(F.length(column).alias("n")))
    got = avro.decoded(spark.createDataFrame([(1, bytearray(b"abc"))], "id int, value binary"), "value", CHANGE, "v")
    assert got.columns == ["id", "v"] and got.first().v.n == 3 and asked == [CHANGE]
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()


def test_avro_by_column_equals_value_by_value():
    import random

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    from tidewell.sources import avro

    inner = {"type": "record", "name": "In", "fields": [{"name": "e", "type": {"type": "enum", "name": "E", "symbols": ["x", "y", "z"]}}, {"name": "w", "type": {"type": "fixed", "name": "F", "size": 3}}]}
    kind = {
        "type": "record", "name": "Out",
        "fields": [
            {"name": "a", "type": "long"}, {"name": "b", "type": ["null", "int"]}, {"name": "c", "type": ["string", "null"]}, {"name": "d", "type": "double"}, {"name": "f", "type": "float"},
            {"name": "g", "type": "boolean"}, {"name": "h", "type": ["null", inner]}, {"name": "i", "type": ["null", "In"]}, {"name": "j", "type": "bytes"}, {"name": "n", "type": "null"},
            {"name": "k", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 4}]},
        ],
    }
    rng = random.Random(3)
    maybe = lambda v: v if rng.random() < 0.7 else None
    one = lambda: {"e": rng.choice("xyz"), "w": rng.randbytes(3)}
    codec = avro.Codec(kind)
    assert avro.Columns.fit(codec)
    values = [
        {
            "a": rng.choice([0, -1, 2**63 - 1, -(2**63), rng.randint(-(10**9), 10**9)]), "b": maybe(rng.randint(-(2**31), 2**31 - 1)), "c": maybe("é" * rng.randint(0, 90)), "d": rng.random(),
            "f": float(rng.randint(0, 99)), "g": rng.random() < 0.5, "h": maybe(one()), "i": maybe(one()), "j": rng.randbytes(rng.randint(0, 200)), "n": None,
            "k": maybe(Decimal(rng.choice([0, -1, 127, 128, -129, 10**19, -(10**19), rng.randint(-(10**9), 10**9)])).scaleb(-4)),
        }
        for _ in range(300)
    ]
    data = [codec.writer()(v) if i % 7 else None for i, v in enumerate(values)]
    arrow = to_arrow_type(codec.spark_type())
    for part in (data, data[5:40], [None, None], []):
        want = [None if x is None else codec.reader()(x, 0)[0] for x in part]
        assert avro._decoded_batch(codec, pa.array(part, pa.binary()), arrow).to_pylist() == want
    assert avro._decoded_batch(codec, pa.array(data, pa.binary()).slice(11, 50), arrow).to_pylist() == [None if x is None else codec.reader()(x, 0)[0] for x in data[11:61]]
    good = data[1]
    for bad, why in ((good[:-1], "ends inside"), (good + b"x", "bytes after"), (b"\xff" * 11, "ten bytes|ends inside"), (b"\x00\x09", "branch|ends inside")):
        with pytest.raises(ValueError, match=why):
            avro._decoded_batch(codec, pa.array([good, bad], pa.binary()), arrow)
    union = avro.Codec({"type": "record", "name": "U", "fields": [{"name": "u", "type": ["int", "null", "string"]}]})
    got = avro._decoded_batch(union, pa.array([b"\x00\x06", b"\x04\x02q", b"\x02"], pa.binary()), to_arrow_type(union.spark_type())).to_pylist()
    assert got == [{"u": {"member0": 3, "member1": None}}, {"u": {"member0": None, "member1": "q"}}, {"u": None}]
