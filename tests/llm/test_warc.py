import base64
import gzip
import hashlib

import duckdb
import pytest

from grantlake.llm import warc as W

PAGES = [
    (1, "http://a.example/x?y=1", "<p>one</p>"), (2, "http://b.example", "<p>one</p>"), (3, None, None), (4, "bad\r\nurl", ""),
    (5, "http://c.example/é", "WARC/1.1\r\nWARC-Type: response\r\n\r\nContent-Length: 4\r\n\r\n"), (6, "u", "<p>one</p>"), (7, "u", "é\r\n\r\n" * 50_000), (9, "v", "solo"),
]


def want(pages, least=0):
    out = []
    for page, _, html in pages:
        data = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "")]
        last = max(same) if len(data) >= least else page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if page == last else "revisit", None if page == last else last))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 1, 11])
def test_round_trip(spark, least):
    pages = spark.createDataFrame([(*p, i) for i, p in enumerate(PAGES)], "page_id long, url string, html string, record_id int").repartition(3)
    got = sorted(tuple(r) for r in W.digest_of_pages(pages, min_bytes=least).collect())
    assert got == want(PAGES, least)


def test_oracle_agrees(spark):
    con = duckdb.connect()
    con.execute("create table pages(page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, ?, ?)", PAGES)
    assert sorted(con.execute(W.ORACLE).fetchall()) == want(PAGES)


def test_nested_rows_and_real_payloads(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    W.write_archive(pages, folder := f"file://{tmp_path}/arc")
    rows = W.assemble(W.read_records(spark, folder)).collect()
    assert len(rows) == len(PAGES)
    html = {p: h or "" for p, _, h in PAGES}
    for r in rows:
        assert len(r.requests) == len(r.metadata) == 1
        page = int(r.metadata[0].fields["page-id"])
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload).decode() == html[page]


def test_concurrent_to_in_either_direction_and_orphans(spark, tmp_path):
    def record(kind, name, extra="", block=b"", content="application/http"):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: {name}\r\n{extra}Content-Type: {content}\r\nContent-Length: {len(block)}\r\n\r\n"
        return gzip.compress(head.encode() + block + b"\r\n\r\n")

    data = record("warcinfo", "i", content="application/warc-fields") + record("response", "r", "WARC-Concurrent-To: q\r\nWARC-Concurrent-To: m\r\n", b"HTTP/1.1 200 OK\r\n\r\nhi")
    data += record("request", "q") + record("metadata", "m", "", b"a: b\r\n", "application/warc-fields") + record("metadata", "n", "WARC-Concurrent-To: r\r\n", b"") + record("request", "lost", "WARC-Concurrent-To: none\r\n")
    (tmp_path / "part-0.warc.gz").write_bytes(data)
    (row,) = W.assemble(W.read_records(spark, f"file://{tmp_path}")).collect()
    assert (row.record_id, bytes(row.payload), [q.record_id for q in row.requests], [m.record_id for m in row.metadata]) == ("r", b"hi", ["q"], ["m", "n"])


def test_damage_is_seen():
    good = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:AAAA\r\nContent-Length: 21\r\n\r\nHTTP/1.1 200 OK\r\n\r\nhi\r\n\r\n"
    for bad in (good, good[:-10], b"nonsense\r\n\r\n"):
        with pytest.raises(ValueError):
            list(W.parse(bad))


def test_null_repeated_ids_and_no_rows(spark):
    pages = spark.createDataFrame([(None, "u", "x"), (1, "u", "x"), (1, "u", "x"), (None, None, "y")], "page_id long, url string, html string")
    got = sorted((str(r.page_id), r.record_type, str(r.refers_to)) for r in W.digest_of_pages(pages).collect())
    assert got == [("1", "response", "None"), ("None", "response", "None"), ("None", "revisit", "1")]
    assert W.digest_of_pages(pages.limit(0)).count() == 0
