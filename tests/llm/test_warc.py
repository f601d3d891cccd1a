import gzip
import hashlib
import random

import check
from jobweave.llm import warc
from jobweave.llm.oracles import ORACLES
from jobweave.llm.queries import QUERIES
from jobweave.session import scratch_path


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload string, refers_to string")


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_records_come_back(spark):
    long = "".join(random.Random(1).choice("abcdé <>\r\n") for _ in range(300_000))
    same = "<p>" + "x" * 200
    rows = [
        (7, "http://a", same), (3, None, same), (9, "http://b\r\nX: y", same), (1, "u", None), (2, "u", ""), (4, "u", "y" * 99), (5, "u", "y" * 99),
        (10, "u", "y" * 100), (11, "u", "y" * 100), (12, "u", long), (13, "u", "WARC/1.1\r\n\r\nHTTP/1.1 200 OK\r\n\r\n\r\n"), (None, "u", "no id"),
    ]
    got = {r.record_id: r for r in warc.round_trip(spark, table(spark, [(*r, "extra", "extra") for r in rows]), chunk_bytes=1000).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        body = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
    assert {i: r.refers_to for i, r in got.items() if r.record_type == "revisit"} == {7: 3, 9: 3, 11: 10}


def test_chunks_carry_running_digests_and_the_bytes(spark):
    body = bytes(range(65, 91)) * 500
    pages = table(spark, [(1, "u", body.decode(), "", "")])
    manifest = warc.write_archives(warc.with_revisits(pages), scratch_path(spark, "warc-test"))
    chunks = warc.chunk_table(manifest, chunk_bytes=999).orderBy("chunk_no").collect()
    assert [c.chunk_no for c in chunks] == list(range(14)) and [c.is_last for c in chunks] == [False] * 13 + [True]
    assert b"".join(bytes(c.data) for c in chunks) == body
    for c in chunks:
        assert c.digest_so_far == hashlib.sha256(body[: c.start + c.n_bytes]).hexdigest()
    (file,) = manifest.collect()
    with gzip.open(local(file.path)) as archive:
        text = archive.read()
    assert text.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and text.endswith(body + b"\r\n\r\n")


def test_archives_are_cut_by_size(spark):
    pages = table(spark, [(i, "u", str(random.Random(i).random()) * 50, "", "") for i in range(60)]).coalesce(1)
    manifest = warc.write_archives(warc.with_revisits(pages), scratch_path(spark, "warc-test"), file_bytes=2000)
    assert manifest.count() > 3 and manifest.agg({"n_records": "sum"}).first()[0] == 60
    assert warc.record_table(warc.chunk_table(manifest, with_data=False)).count() == 60


def test_equal_rows_and_no_rows(spark):
    twice = [(5, "u", "z" * 150, "", "")] * 2 + [(6, "u", "z" * 150, "", "")]
    got = sorted((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.round_trip(spark, table(spark, twice)).collect())
    assert got == [(5, "response", None, 150), (5, "response", None, 150), (6, "revisit", 5, 150)]
    assert warc.round_trip(spark, table(spark, twice).limit(0)).collect() == []


def test_a_wrong_digest_is_an_error(spark):
    chunks = spark.createDataFrame([(1, "response", None, "u", "00", 0, 0, 3, "11", True)], warc.CHUNKS)
    try:
        warc.record_table(chunks).collect()
    except Exception as error:  # noqa: BLE001 - Spark wraps it
        assert "wrong payload digest" in str(error)
    else:
        raise AssertionError("no error")


def test_query_matches_sql(spark, data):
    same, note = check.compare(spark, check.connect(data), QUERIES["op2_warc_chunks"], ORACLES["op2_warc_chunks"], data)
    assert same, note
