"""Archives written and read back, revisits, and payloads that look like archives."""

import base64
import gzip
import hashlib
from pathlib import Path

import duckdb
import pytest
from given import documents, stays  # noqa: F401

from aerometry.llm import warc
from aerometry.llm.oracles import ORACLES

SCHEMA = "page_id long, url string, html string, record_id string, payload_bytes int, refers_to long"

RECORD = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
PAGES = [
    (1, "http://a.example/1", "<p>one</p>"),
    (2, None, "<p>one</p>"),
    (3, "http://a.example/3", None),
    (4, "http://a.example/4\r\nWARC-Type: metadata", ""),
    (5, "é", "x\r\n\r\ny\r\n"),
    (6, "", RECORD * 3),
    (7, "u", "\r\n\r\n\r\n" + RECORD + "\r"),
    (7, "u", "\r\n\r\n\r\n" + RECORD + "\r"),
    (None, "v", "<p>one</p>"),
    (8, "w", "é\x00\x1c\n" * 50_000),
    (9, "w", "\r\n" * 5),
    (10, "w", "\r\n\r"),
]


def table(spark, pages):
    return spark.createDataFrame([(*page, "r", 1, 2) for page in pages], SCHEMA)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(pages, least_bytes=0):
    last = {}
    for page_id, _, html in pages:
        last[html or ""] = max(last.get(html or "", (False, 0)), (page_id is not None, page_id or 0))
    rows, kept = [], set()
    for page_id, _, html in pages:
        html = html or ""
        own = (page_id is not None, page_id or 0)
        stays = len(html.encode()) < least_bytes or (own == last[html] and html not in kept)
        kept |= {html} if stays and own == last[html] else set()
        kind = ("response", None) if stays else ("revisit", last[html][1])
        rows.append((page_id, len(html.encode()), digest(html), *kind))
    return sorted(rows, key=repr)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("least_bytes", [0, 5])
def test_pages_through_archives(spark, documents, least_bytes):
    pages = table(spark, PAGES).repartition(3)
    found = warc.archive_pages(pages, least_bytes).select(*COLUMNS).collect()
    assert sorted(map(tuple, found), key=repr) == expected(PAGES, least_bytes)


def test_payloads_survive(spark, documents, base):
    """Every payload is read back as it was, from files of two records."""
    warc.write_archives(warc.records_of(table(spark, PAGES)), f"{base}/a", records_per_file=2)
    records = warc.read_archives(spark, f"{base}/a").collect()
    assert sorted(bytes(r.payload) for r in records) == sorted((h or "").encode() for _, _, h in PAGES)
    assert len({r.record_id for r in records}) == len(PAGES)
    files = list(Path(f"{base}/a").glob("*.gz"))
    assert len(files) >= len(PAGES) // 2
    text = gzip.open(files[0]).read()
    assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")


def test_deduplicated_archives_hold_a_payload_once(spark, documents, base):
    hot = [(i, f"u{i}", "<p>same</p>" * 100) for i in range(500)] + PAGES
    warc.write_archives(warc.records_of(table(spark, hot)), f"{base}/a")
    warc.deduplicate_archives(spark, f"{base}/a", f"{base}/b")
    records = warc.read_archives(spark, f"{base}/b").collect()
    assert len(records) == len(hot)
    payloads = [bytes(r.payload) for r in records if r.record_type == "response"]
    assert len(payloads) == len(set(payloads)) == len({h or "" for _, _, h in hot})
    by_id = {r.record_id: r for r in records}
    for r in records:
        if r.record_type == "revisit":
            original = by_id[r.refers_to]
            assert original.record_type == "response" and r.payload is None
            assert (r.payload_digest, r.payload_bytes) == (original.payload_digest, original.payload_bytes)
    again = f"{base}/c"  # deduplicated archives stay as they are
    warc.deduplicate_archives(spark, f"{base}/b", again)
    kinds = lambda rs: sorted((r.record_id, r.record_type, r.refers_to) for r in rs)
    assert kinds(warc.read_archives(spark, again).collect()) == kinds(records)


def test_broken_archives_are_errors(spark, documents, base):
    warc.write_archives(warc.records_of(table(spark, PAGES[:1]).coalesce(1)), f"{base}/a")
    whole = gzip.open(next(Path(f"{base}/a").glob("*.gz"))).read()
    for name, data in (("cut", whole[:-20]), ("changed", whole.replace(b"one", b"two"))):
        Path(f"{base}/{name}").mkdir()
        (Path(f"{base}/{name}") / "part-0.txt.gz").write_bytes(gzip.compress(data))
        with pytest.raises(Exception, match="ends within a record|another payload"):
            warc.read_archives(spark, f"{base}/{name}").collect()


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_parser_takes_any_cut(size):
    text = "".join(
        f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:{i}>\r\n"
        f"WARC-Payload-Digest: sha1:{digest(html)}\r\n"
        f"Content-Length: {19 + len(html.encode())}\r\n\r\nHTTP/1.1 200 OK\r\n\r\n{html}\r\n\r\n"
        for i, (_, _, html) in enumerate(PAGES[:8])
        for html in [html or ""]
    ).encode()
    parser = warc.ArchiveParser("t")
    cuts = range(0, len(text), size)
    found = [record for at in cuts for record in parser.feed(text[at : at + size])]
    parser.close()
    assert [record[-1].decode() for record in found] == [html or "" for _, _, html in PAGES[:8]]


def test_first_archives_go_when_written_anew(spark, documents, stays):
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "a")], "page_id long, url string, html string")
    found, left = stays(lambda: warc.archive_pages(pages))
    assert left == {"warc-deduplicated": 1, "warc-headers": 1}
    assert sorted((r.page_id, r.refers_to) for r in found.collect()) == [(1, 2), (2, None)]


def test_empty_table(spark, documents):
    assert warc.archive_pages(table(spark, [])).count() == 0


def test_sql_equals_plain(spark):
    connection = duckdb.connect()
    pages = [page for page in PAGES if page[0] not in (7, None)]  # rows that SQL cannot tell apart
    connection.execute("create table pages (page_id bigint, url varchar, html varchar)")
    connection.executemany("insert into pages values (?, ?, ?)", pages)
    found = connection.execute(f"select {', '.join(COLUMNS)} from ({ORACLES['op13_warc']})").fetchall()
    assert sorted(found, key=repr) == expected(pages)
