import hashlib
import io

from pyspark.sql import functions as F

from ledgerlens.llm import queries, warc
from ledgerlens.session import shared_dir

LONG = "<p>é" + "x" * 200 + "</p>"
ROWS = [(1, "http://a/1", LONG), (2, "http://a/2\r\nX: y", LONG), (3, None, None), (4, "http://a/4", ""), (5, "u", "short"), (6, "u", "short"),
        (7, "http://a/7", "y" * 99), (8, "http://a/8", "y" * 99), (9, "ü", "WARC/1.1\r\n\r\n" * 30), (10, "u", "z" * 100), (10, "u", "z" * 100), (12, "u", "z" * 100)]


def pages(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def written_archive(spark, rows=ROWS):
    path = f"{shared_dir(spark)}/test-{id(rows)}-{hashlib.md5(str(rows).encode()).hexdigest()}-{F.rand()._jc.toString()[-6:]}".replace(" ", "").replace("(", "").replace(")", "")
    warc.write_archive(warc.with_revisits(pages(spark, rows)), path)
    return path


def test_round_trip(spark):
    path = written_archive(spark)
    got = warc.read_archive(spark, path).collect()
    assert len(got) == len(ROWS)
    text = {i: (h or "").encode() for i, _, h in ROWS}
    for r in got:
        page = int(r.record_id[len("<urn:x-page:"):-1])
        assert r.payload_length == len(text[page]) and r.payload_digest == "sha256:" + hashlib.sha256(text[page]).hexdigest()
        first = min(i for i in text if text[i] == text[page])
        if len(text[page]) >= 100 and first != page:
            assert r.record_type == "revisit" and r.refers_to == f"<urn:x-page:{first}>" and r.payload == b""
        else:
            assert r.record_type == "response" and bytes(r.payload) == text[page] and r.refers_to is None
    assert {r.target_uri for r in got} >= {"http://a/1", "http://a/2%0D%0AX: y", "ü", None}


def test_filters_reach_the_reader_and_skip_payloads(spark):
    path = written_archive(spark)
    for condition, n in (("record_type = 'revisit'", 2), ("record_type <> 'revisit' and payload_length >= 100", 4),
                         ("target_uri like 'http://a/%' and refers_to is not null", 1), ("record_type in ('revisit') or payload_length = 0", 4)):
        assert warc.read_archive(spark, path).filter(condition).count() == n, condition
    heads = warc.read_archive(spark, path, payload=False)
    assert heads.filter("payload is not null").count() == 0 and heads.count() == len(ROWS)
    stream = CountingStream(b"".join(warc.record_bytes(r) for r in records()))
    found = list(warc.records(stream, 0, len(stream.data), [lambda r: r["record_type"] == "revisit"], True))
    assert len(found) == 1 and stream.taken == [0]


def test_gzip_members_are_stepped_over():
    import gzip
    import os
    big = [{**r, "payload": os.urandom(200_000) if r["payload"] else None} for r in records()]
    members = [warc.gzip_member(warc.record_bytes(r)) for r in big]
    assert [gzip.decompress(m) for m in members] == [warc.record_bytes(r) for r in big]
    stream = CountingStream(b"".join(members))
    size = len(stream.data)
    assert [r["record_type"] for r in warc.gzip_records(stream, 0, size, [lambda r: r["record_type"] == "revisit"], True)] == ["revisit"]
    assert sum(n for n in stream.taken) < 20_000
    both = list(warc.gzip_records(stream, 0, size, [], True))
    assert both[0]["payload"] == big[0]["payload"] and both[1]["payload"] == b""
    foreign = b"".join(gzip.compress(warc.record_bytes(r), mtime=0) for r in big)   # no length field
    assert [r["payload"] for r in warc.gzip_records(io.BytesIO(foreign), 0, len(foreign), [], True)] == [b["payload"] for b in both]


class CountingStream(io.BytesIO):
    def __init__(self, data):
        super().__init__(data)
        self.data, self.taken = data, []

    def read(self, n=-1):
        self.taken.append(n)
        return super().read(n)


def records():
    base = {"date": None, "target_uri": "u", "payload_digest": "sha256:0", "payload_length": 3, "refers_to": None, "record_id": "<urn:x-page:1>"}
    return [{**base, "record_type": "response", "payload": b"abc" * 1000}, {**base, "record_type": "revisit", "payload": None}]


def test_file_ranges_cover_each_record_once(spark, monkeypatch, tmp_path):
    import pyarrow as pa
    monkeypatch.setattr(warc, "SPLIT_BYTES", 300)
    monkeypatch.setattr(warc, "FILE_BYTES", 2000)
    writer = warc.WarcWriter(str(tmp_path))
    rows = [{**records()[0], "record_id": f"<urn:x-page:{i}>", "content_length": None, "payload": b"p" * (i * 7 % 400)} for i in range(40)]
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows)])), None])
    reader = warc.WarcReader(str(tmp_path), True)
    ranges = reader.partitions()
    assert len(ranges) > 10 and len({r.file for r in ranges}) > 2
    got = [r for part in ranges for b in reader.read(part) for r in b.to_pylist()]
    assert sorted(r["record_id"] for r in got) == sorted(r["record_id"] for r in rows)


def test_only_committed_files_are_read(spark, tmp_path):
    import pyarrow as pa
    writer = warc.WarcWriter(str(tmp_path))
    rows = [{**records()[0], "content_length": None}]
    lost = writer.write(iter([pa.RecordBatch.from_pylist(rows)]))          # a task that was repeated elsewhere
    writer.commit([writer.write(iter([pa.RecordBatch.from_pylist(rows)]))])
    assert sum(1 for p in warc.WarcReader(str(tmp_path), True).partitions()) == 1
    writer.abort([lost])
    assert len(list(tmp_path.glob("*.warc.gz"))) == 1


def test_null_ids_and_empty_tables(spark):
    rows = [(None, "u", LONG), (None, "u", LONG), (3, "u", LONG)]
    kinds = sorted((str(r.record_type), str(r.refers_to)) for r in warc.with_revisits(pages(spark, rows)).collect())
    assert kinds == [("response", "None"), ("revisit", "<urn:x-page:3>"), ("revisit", "<urn:x-page:3>")]
    assert {r.record_type for r in warc.with_revisits(pages(spark, rows[:2])).collect()} == {"response"}
    assert warc.read_archive(spark, written_archive(spark, [])).count() == 0


def test_a_member_of_several_records_is_an_error():
    import gzip

    import pytest
    raw = [warc.record_bytes(r) for r in records()]
    own, both = b"".join(gzip.compress(r) for r in raw), b"".join(raw)
    assert len(list(warc.gzip_records(io.BytesIO(own), 0, len(own), [], True))) == len(raw)
    for data in (gzip.compress(both), warc.gzip_member(both), gzip.compress(raw[0])[:-20]):
        for payload in (True, False):
            with pytest.raises(ValueError):
                list(warc.gzip_records(io.BytesIO(data), 0, len(data), [], payload))


def test_each_filter_and_its_negation_equal_sparks(spark):
    """Pushed filters on a nullable header against Spark's own result on the same rows."""
    from pyspark.sql import functions as F

    rows = [(i, f"u{i}", LONG if i % 2 else f"{LONG}{i}") for i in range(12)]
    path = written_archive(spark, rows)
    plain = spark.createDataFrame(warc.read_archive(spark, path).drop("payload").collect(), warc.read_archive(spark, path).drop("payload").schema)
    for column, value, more in (("refers_to", "<urn:x-page:1>", "<urn:x-page:9>"), ("target_uri", "u3", "u9")):
        c = F.col(column)
        tests = [c == value, c.eqNullSafe(value), c.eqNullSafe(more), c.isNull(), c.isNotNull(), c.isin(value, more), c > value, c >= value, c < more,
                 c <= more, c.startswith(value[:2]), c.endswith(value[-2:]), c.contains(value[1:]), c.isin(value, None), c.eqNullSafe(None)]
        for test in [*tests, *(~t for t in tests), *(~~t for t in tests)]:
            want = sorted(r.record_id for r in plain.filter(test).collect())
            got = sorted(r.record_id for r in warc.read_archive(spark, path, payload=False).filter(test).select("record_id").collect())
            assert got == want, test


def test_each_filter_class_is_tested_on_null_headers():
    from pyspark.sql.datasource import EqualNullSafe, EqualTo, In, IsNotNull, IsNull, Not, StringContains

    row, null = {"refers_to": "<a>"}, {"refers_to": None}
    at = ("refers_to",)
    for f, on_row, on_null in ((EqualNullSafe(at, "<b>"), False, False), (Not(EqualNullSafe(at, "<b>")), True, True), (Not(EqualNullSafe(at, None)), True, False),
                               (Not(IsNull(at)), True, False), (Not(IsNotNull(at)), False, True), (Not(EqualTo(at, "<b>")), True, False),
                               (Not(In(at, ("<b>", None))), False, False), (Not(In(at, ("<b>",))), True, False), (Not(StringContains(at, "b")), True, False)):
        test = warc.header_test(f)
        assert (test(row), test(null)) == (on_row, on_null), f
    assert warc.header_test(Not(Not(EqualTo(at, "<b>")))) is None
