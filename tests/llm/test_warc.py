"""Archives: round trips, revisits and transactions."""

import gzip
import hashlib
import io

import pyarrow as pa
import pytest

from cellbulk.llm import warc
from cellbulk.session import new_folder

BODY = "<p>" + "é" * 60 + "</p>"
PAGES = [
    (5, "http://a.example/1", BODY), (3, "http://a.example/2", BODY), (9, None, BODY),
    (1, "http://b.example/\r\nX: y", "short"), (2, "http://b.example/", "short"), (4, "http://c.example/", None),
    (6, "http://c.example/", ""), (None, "http://d.example/", "no id " * 40), (7, "x", "WARC/1.1\r\n\r\n" * 30),
    (8, "y", "z" * 3_000_000), (11, "r", "repeated row " * 20), (11, "r", "repeated row " * 20),
]


def run(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = new_folder(spark, "warc-test")
    warc.write_warc(pages.repartition(3), path, records_per_file=5)
    return path, warc.read_records(spark, path)


def test_every_page_comes_back_as_one_capture(spark):
    _, records = run(spark, PAGES)
    captures = warc.assemble(records).collect()
    assert len(captures) == len(PAGES)
    held = {}
    for page, _, html in PAGES:
        if page is not None and len((html or "").encode()) >= 100:
            held[html] = min(page, held.get(html, page))
    for c in captures:
        page = c.metadata.page_id
        html = next(h for p, _, h in PAGES if p == page) or ""
        first = held.get(html, page)
        assert c.response.payload_bytes == len(html.encode())
        assert c.response.payload_digest == hashlib.sha256(html.encode()).hexdigest()
        assert c.response.kind == ("response" if page == first else "revisit")
        assert c.refers_to == (None if page == first else first)
        assert c.request.method == "GET"
        if page == first:
            assert bytes(c.response.payload).decode() == html


def test_captures_may_lack_records(spark):
    _, records = run(spark, PAGES[:2])
    bare = warc.assemble(records.where("kind in ('response', 'revisit')")).collect()
    assert len(bare) == 2 and all(c.request is None and c.metadata is None for c in bare)
    assert warc.assemble(records.where("kind = 'request'")).collect() == []


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = new_folder(spark, "warc-test")
    warc.write_warc(pages, path)
    assert warc.assemble(warc.read_records(spark, path)).collect() == []


def test_records_of_many_gzip_members():
    one = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 10\r\n\r\npage-id: 4\r\n\r\n"
    rows = [r for b in warc._record_batches("f", pa.py_buffer(gzip.compress(one) * 3), True) for r in b.to_pylist()]
    assert [r["page_id"] for r in rows] == [4, 4, 4]


def test_a_changed_payload_is_noticed():
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha256:00\r\nContent-Length: {len(block)}\r\n\r\n"
    with pytest.raises(ValueError, match="digest"):
        list(warc._record_batches("f", pa.py_buffer(head.encode() + block + b"\r\n\r\n"), True))
    with pytest.raises(ValueError, match="not a WARC"):
        list(warc.parse_warc(io.BytesIO(b"nonsense\r\n")))


def test_columns_of_any_name_survive_typing(docs):
    typed = warc.with_record_types(docs, payload="text", key="doc_id")
    assert typed.columns == docs.columns + ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert typed.select(*docs.columns).exceptAll(docs).isEmpty() and typed.count() == docs.count()
