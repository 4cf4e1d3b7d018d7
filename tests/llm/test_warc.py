import hashlib

from loomspan.llm.common import new_path
from loomspan.llm.warc import MAGIC, read_warc, write_warc

FAKE = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"


def _round_trip(spark, rows, schema="page_id bigint, url string, html string", split=1500):
    path = new_path(spark, "warc-test")
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    write_warc(spark.createDataFrame(rows, schema).coalesce(1), path)
    for k in before:
        spark.conf.set(k, str(split))
    try:
        return read_warc(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_magic_in_payloads_and_small_splits(spark):
    payloads = ["x" * 700, FAKE, FAKE * 40 + "tail", "a\r\n\r\nb", MAGIC, MAGIC * 3, "", None, "é漢" * 400, FAKE + "y" * 1200, "z" * 5000, FAKE[:-2], "Content-Length: 5\r\n\r\n" + FAKE]
    rows = [(i, f"http://h/{i}", p) for i, p in enumerate(payloads)]
    got = _round_trip(spark, rows)
    assert {r.page_id: bytes(r.payload) for r in got} == {i: (p or "").encode() for i, _, p in rows}
    assert len(got) == len(rows)
    assert all(r.declared_digest == hashlib.sha1(bytes(r.payload)).hexdigest() for r in got)


def test_revisits_ties_and_nulls(spark):
    long, short = "L" * 1000, "S" * 999
    rows = [(1, "u", long), (7, "u", long), (7, "v", long), (None, "w", long), (3, None, short), (4, "a\r\nb", short), (None, "n", FAKE * 30), (None, None, FAKE * 30)]
    got = sorted((r.page_id, r.record_type, r.refers_to, r.target_uri, r.declared_bytes) for r in _round_trip(spark, rows) if r.page_id is not None)
    assert got[0] == (1, "revisit", 7, "u", 1000)
    assert [g[:3] for g in got[1:]] == [(3, "response", None), (4, "response", None), (7, "response", None), (7, "response", None)]
    assert got[1][3] is None and got[2][3] == "a%0D%0Ab"
    nulls = sorted((r.record_type, r.refers_to or 0) for r in _round_trip(spark, rows) if r.page_id is None)
    assert nulls == [("response", 0), ("response", 0), ("revisit", 7)]


def test_empty_and_extra_columns(spark):
    assert _round_trip(spark, []) == []
    rows = [(1, "u", "h", "x", 5)]
    got = _round_trip(spark, rows, "page_id bigint, url string, html string, payload string, n int")
    assert [bytes(r.payload) for r in got] == [b"h"]


def test_damaged_tail_is_dropped(spark):
    path = new_path(spark, "warc-test")
    good = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nok\r\n\r\n"
    bad = f"{MAGIC}WARC-Type: response\r\nno length\r\n\r\n"
    spark.createDataFrame([(good + bad + good,)], "value string").coalesce(1).write.option("lineSep", "\r\n").text(path)
    assert [r.page_id for r in read_warc(spark, path).collect()] == [1]


def test_headers_with_bare_line_ends(spark):
    path = new_path(spark, "warc-test")
    odd = f"{MAGIC}WARC-Type: response\nContent-Length: 2\nWARC-Record-ID: <urn:page:1>\nContent-Length: 9\r\n\r\nok\r\n\r\n"
    good = f"{MAGIC}WARC-Type: response\r\nWARC-Record-ID: <urn:page:2>\r\nContent-Length: 3\r\n\r\nyes\r\n\r\n"
    spark.createDataFrame([(odd + good + odd,)], "value string").coalesce(1).write.option("lineSep", "\r\n").text(path)
    got = sorted((r.page_id, r.record_type, bytes(r.payload)) for r in read_warc(spark, path).collect())
    assert got == [(1, "response", b"ok"), (1, "response", b"ok"), (2, "response", b"yes")]


def test_very_many_magic_lines_in_one_payload(spark):
    payload = MAGIC * 60_000 + "end"
    got = _round_trip(spark, [(1, "u", payload), (2, "u", "x")], split=100_000)
    assert {r.page_id: bytes(r.payload) for r in got} == {1: payload.encode(), 2: b"x"}
