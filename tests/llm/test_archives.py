import gzip
import io

import pytest

from tests.oracle import assert_same
from tidewell.llm import archives as ar
from tidewell.llm import queries

PAGES = "page_id long, url string, html string, response boolean, tied string, p int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, True, "t", 1) for r in rows], PAGES)


def result(df):
    return sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in df.collect()), key=repr)


def test_round_trip_of_awkward_pages(spark):
    rows = [
        (5, "http://a b\n", ""), (3, None, None), (3, "http://x", ""), (3, "http://x", ""), (None, "u", "zz"), (None, "u", "zz"), (8, "v", "yy"), (7, "v", "yy"),
        (9, "http://h/ü", "q\r\n\r\nWARC/1.0\r\n"), (11, "w", "x" * 300_000), (12, "w", "é\U0001f600\x00"),
    ]
    want = [
        (5, 0, "revisit", 3), (3, 0, "response", None), (3, 0, "revisit", 3), (3, 0, "revisit", 3), (None, 2, "response", None), (None, 2, "revisit", None), (8, 2, "revisit", 7),
        (7, 2, "response", None), (9, 15, "response", None), (11, 300_000, "response", None), (12, 7, "response", None),
    ]
    assert result(ar.round_trip(pages(spark, rows))) == sorted(want, key=repr)
    assert ar.round_trip(pages(spark, [])).collect() == []


def test_small_payloads_are_responses(spark):
    rows = [(1, "a", "xy"), (2, "a", "xy"), (3, "a", "long enough"), (4, "a", "long enough")]
    assert result(ar.round_trip(pages(spark, rows), least_bytes=5)) == [(1, 2, "response", None), (2, 2, "response", None), (3, 11, "response", None), (4, 11, "revisit", 3)]


def test_query_equals_its_twin(spark, data):
    assert assert_same(queries.op6_warc(spark, data), queries.ORACLE_SQL["op6_warc"], data) > 0


@pytest.mark.parametrize("version", [1, 2])
def test_arc_versions(version):
    page = ar.page_arc(4, "http://x/y z", b"<p>hi</p>", version, "20200304050607")
    dns = ar.arc_header(version, "dns:x", "2020", "text/dns; charset=utf-8", 7) + b"1.2.3.4"
    file = ar.arc_version_block(version, "f.arc", "20200101000000") + page + b"\n\n" + dns
    a, b = (ar.arc_to_warc(r) for r in ar.parse_arc(file))
    assert a.headers["WARC-Type"] == "response" and a.headers["WARC-Date"] == "2020-03-04T05:06:07Z" and a.headers["WARC-Target-URI"] == "http://x/y%20z"
    assert a.payload == b"<p>hi</p>" and a.headers["WARC-Payload-Digest"] == "sha1:" + ar.digest32(b"<p>hi</p>")
    assert b.headers["WARC-Type"] == "resource" and b.headers["WARC-Date"] == "2020-01-01T00:00:00Z" and b.headers["Content-Type"] == "text/dns; charset=utf-8" and b.payload == b"1.2.3.4"
    back = list(ar.read_warc(io.BytesIO(a.to_bytes() + ar.RECORD_END + b.to_bytes() + ar.RECORD_END)))
    assert [r.block for r in back] == [a.block, b.block] and back[0].headers == a.headers
    with pytest.raises(ValueError, match="cut short"):
        list(ar.parse_arc(file[:-3]))


def test_arc_files_become_warc_files(spark, tmp_path):
    file = ar.arc_version_block(1, "f.arc", "20200101000000") + ar.page_arc(1, "http://x", b"a", 1, "20200101000000") + ar.page_arc(2, "http://y", b"b", 1, "20200101000000")
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.arc.gz").write_bytes(gzip.compress(file))
    ar.write_warc(ar.convert_arc_files(spark, f"file://{tmp_path}/in").select("record"), f"file://{tmp_path}/out", compression=None)
    (out,) = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    with out.open("rb") as f:
        records = list(ar.read_warc(f))
    assert [r.payload for r in records] == [b"a", b"b"] and len({r.headers["WARC-Record-ID"] for r in records}) == 2
    assert {r.page_id for r in ar.read_pages(spark, f"file://{tmp_path}/out").collect()} == {1, 2}


def test_odd_header_lines(spark, tmp_path):
    head = ar.arc_version_block(2, "f.arc", "20200101000000")
    lines = [
        (b"http://a/b c d 1.2.3.4 20200101000000 text/html; charset=x 200 - - 0 f.arc 3", "http://a/b c d", "text/html; charset=x", "200"),
        (b"http://b ::1 2020 text/html 3", "http://b", "text/html", "-"),
        (b"http://c 1.2.3.4 20200101 3", "http://c", "-", "-"),
    ]
    data = head + b"\n".join(line + b"\nxyz" for line, *_ in lines)
    got = list(ar.parse_arc(data))
    assert [(r.url, r.fields["Content-type"], r.fields["Result-code"]) for r in got] == [x[1:] for x in lines] and {r.block for r in got} == {b"xyz"}
    bad = head + b"not a header at all\nnor this one\n" + ar.page_arc(1, "http://x", b"a", 2, "2020") + b"http://y 1.2.3.4 2020 text/html 200 - - 0 f.arc 999\nshort"
    with pytest.raises(ValueError, match="not a record's header"):
        list(ar.parse_arc(bad))
    (tmp_path / "b.arc").write_bytes(bad)
    rows = ar.convert_arc_files(spark, f"file://{tmp_path}").collect()
    assert [r.record is None for r in rows] == [False, True, True] and "not a record" in rows[1].problem and "cut short" in rows[2].problem


def test_files_are_bounded_and_say_who_wrote_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ar, "FILE_RECORDS", ((10, 4), (100, 2), (1 << 62, 1)))
    rows = [(i, "u", "x" * (i % 10)) for i in range(20)] + [(100 + i, "u", "y" * (50 + i)) for i in range(5)] + [(200 + i, "u", "z" * (500 + i)) for i in range(3)]
    ar.archive_pages(pages(spark, rows).coalesce(1), f"file://{tmp_path}/w", date="20230203040506")
    kinds, dates = [], set()
    for p in sorted((tmp_path / "w").glob("part-*")):
        found = list(ar.read_warc(gzip.open(p)))
        longest = max((int(r.http["content-length"]) for r in found if r.http), default=0)
        assert len(found) <= (4 if longest <= 10 else 2 if longest <= 100 else 1)
        kinds += [r.headers["WARC-Type"] for r in found]
        dates |= {r.headers["WARC-Date"] for r in found}
    assert kinds.count("warcinfo") >= 3 and len(kinds) - kinds.count("warcinfo") == len(rows) and dates == {"2023-02-03T04:05:06Z"}
    back = result(ar.read_pages(spark, f"file://{tmp_path}/w"))
    assert len(back) == len(rows) and [r[3] for r in back if r[0] == 15] == [5]


def test_a_changed_payload_is_noticed(spark, tmp_path):
    record = ar.arc_to_warc(next(ar.parse_arc(ar.arc_version_block(1, "f", "2020") + ar.page_arc(1, "u", b"abc", 1, "2020")))).to_bytes()
    (tmp_path / "part-0").write_bytes(record.replace(b"abc", b"abd") + ar.RECORD_END)
    with pytest.raises(Exception, match="isn't what its header says"):
        ar.read_pages(spark, f"file://{tmp_path}").collect()
