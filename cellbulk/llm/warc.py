"""WARC archives: write captures, read them back, assemble transactions.

A capture is three records: a request, a response (or a revisit of an equal payload)
and a metadata record. Request and metadata name the response in WARC-Concurrent-To.
Files are written by Spark's text writer: every row is one record and the line
separator is the CRLF CRLF that ends a record, so commits, retries and any store that
Spark can write to are handled by Spark. Reading takes whole files (``binaryFile``),
each holding at most ``records_per_file`` records, and joins the records of a capture
by their identifiers, in whatever order or file they lie.

Defined results: a null payload is empty; a null page id writes a capture whose page
id is read back as null; rows that repeat a page id and its payload are all responses.
A null URL writes no target; line breaks in a URL are percent-encoded.
"""

import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk.llm.common import packed, unpacked
from cellbulk.session import saved

CRLF = "\r\n"
MIN_REVISIT_BYTES = 100
RECORD = pa.schema([
    ("record_id", pa.string()), ("kind", pa.string()), ("concurrent_to", pa.string()),
    ("refers_to_record", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
    ("page_id", pa.int64()), ("method", pa.string()), ("status", pa.int32()),
    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
    ("file", pa.string()),
])
RECORD_SCHEMA = (
    "record_id string, kind string, concurrent_to string, refers_to_record string, "
    "target_uri string, warc_date string, page_id long, method string, status int, "
    "payload_bytes long, payload_digest string, payload binary, file string"
)


def with_record_types(pages: DataFrame, payload: str = "html", key: str = "page_id",
                      least: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Adds payload_bytes, payload_digest, record_type and refers_to, in place of columns of
    these names.

    Only digests that occur twice are joined back, so the usual page is not shuffled.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    known = packed(pages, page=F.col(key), payload_bytes=F.octet_length(body).cast("long"), payload_digest=F.sha2(body, 256))
    repeated = (
        known.where(F.col("payload_bytes") >= least).groupBy("payload_digest")
        .agg(F.count("*").alias("copies"), F.min("page").alias("first"))
        .where("copies > 1 and first is not null").drop("copies")
    )
    again = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    typed = known.join(repeated, "payload_digest", "left").withColumns({
        "record_type": F.when(again, "revisit").otherwise("response"),
        "refers_to": F.when(again, F.col("first"))})
    return unpacked(typed, pages.columns, "payload_bytes", "payload_digest", "record_type", "refers_to")


def _uuid(kind: str, key: Column) -> Column:
    """A record id made of page id and payload digest, so a retried task writes the same
    one and a revisit can name the response that it repeats."""
    digest = F.md5(F.concat_ws(
        "\x1f", F.lit(kind), F.coalesce(key.cast("string"), F.lit("")), F.col("payload_digest")))
    parts = [F.substring(digest, start, size) for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(headers: list[Column], block: Column) -> Column:
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(CRLF, F.lit("WARC/1.1"), *headers, length), F.lit(CRLF * 2), block)


def _header(name: str, value: Column) -> Column:
    """Null, and so left out by concat_ws, if the value is null."""
    return F.concat(F.lit(f"{name}: "), value)


def write_warc(pages: DataFrame, path: str, url: str = "url", payload: str = "html",
               key: str = "page_id", date: str = "2024-01-01T00:00:00Z",
               records_per_file: int = 20_000) -> None:
    """Write three records per row of ``pages`` below ``path``."""
    typed = with_record_types(pages, payload, key)
    target = F.regexp_replace(F.regexp_replace(F.col(url), "\r", "%0D"), "\n", "%0A")
    response_id = _uuid("response", F.col(key))
    common = [_header("WARC-Date", F.lit(date)), _header("WARC-Target-URI", target)]
    request = _record([
        _header("WARC-Type", F.lit("request")),
        _header("WARC-Record-ID", _uuid("request", F.col(key))),
        _header("WARC-Concurrent-To", response_id), *common,
        _header("Content-Type", F.lit("application/http; msgtype=request")),
    ], F.concat(F.lit("GET "), F.coalesce(target, F.lit("/")), F.lit(f" HTTP/1.1{CRLF * 2}")))
    body = F.coalesce(F.col(payload), F.lit(""))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(CRLF * 2))
    response = _record([
        _header("WARC-Type", F.col("record_type")), _header("WARC-Record-ID", response_id), *common,
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Refers-To", F.when(revisit, _uuid("response", F.col("refers_to")))),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _header("Content-Type", F.lit("application/http; msgtype=response")),
    ], F.concat(http, F.when(revisit, F.lit("")).otherwise(body)))
    metadata = _record([
        _header("WARC-Type", F.lit("metadata")),
        _header("WARC-Record-ID", _uuid("metadata", F.col(key))),
        _header("WARC-Concurrent-To", response_id), *common,
        _header("Content-Type", F.lit("application/warc-fields")),
    ], F.concat_ws(CRLF, _header("page-id", F.col(key).cast("string")), F.lit("via: table")))
    (typed.select(F.explode(F.array(request, response, metadata)).alias("value"))
     .write.option("lineSep", CRLF * 2).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def parse_warc(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers with lower-case names, block) of each record of an uncompressed stream."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers["content-length"]))


def _row(headers: dict[str, str], block: bytes, file: str, with_payload: bool) -> dict:
    row = {
        "record_id": headers.get("warc-record-id"), "kind": headers.get("warc-type"),
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to_record": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"), "warc_date": headers.get("warc-date"),
        "file": file,
    }
    if row["kind"] == "metadata":
        fields = dict(f.split(": ", 1) for f in block.decode("utf-8").split(CRLF) if ": " in f)
        row["page_id"] = int(fields["page-id"]) if "page-id" in fields else None
    elif row["kind"] == "request":
        row["method"] = block.split(b" ", 1)[0].decode("ascii")
    elif row["kind"] in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split(CRLF)
        http = dict(x.lower().split(": ", 1) for x in lines[1:] if ": " in x)
        stated = headers.get("warc-payload-digest", "").removeprefix("sha256:")
        row["status"] = int(lines[0].split(" ")[1])
        if row["kind"] == "response":
            row["payload_bytes"], row["payload_digest"] = len(payload), hashlib.sha256(payload).hexdigest()
            if stated and stated != row["payload_digest"]:
                raise ValueError(f"{file}: the payload of {row['record_id']} does not match its digest")
            row["payload"] = payload if with_payload else None
        else:
            row["payload_bytes"], row["payload_digest"] = int(http["content-length"]), stated
    return row


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``, compressed or not."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column("path"), batch.column("content")):
                yield from _record_batches(file.as_py(), content.as_buffer(), with_payload)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(parse, RECORD_SCHEMA)


def _record_batches(file: str, content: pa.Buffer, with_payload: bool,
                    most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    stream = io.BufferedReader(pa.BufferReader(content))
    if stream.peek(2)[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    rows, size = [], 0
    for headers, block in parse_warc(stream):
        rows.append(_row(headers, block, file, with_payload))
        size += 200 + len(block) * with_payload
        if size > most:
            yield pa.RecordBatch.from_pylist(rows, RECORD)
            rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (record_id, response, request, metadata, refers_to).

    Requests and metadata are joined to the response that they name in
    WARC-Concurrent-To; of several for one response the smallest counts. A capture
    without request or metadata keeps null there; records that name no known response
    are left out. ``refers_to`` is the page id of the response that a revisit repeats.
    """
    def of(kind: str, *fields: str) -> DataFrame:
        return (records.where((F.col("kind") == kind) & F.col("concurrent_to").isNotNull())
                .groupBy(F.col("concurrent_to").alias("record_id"))
                .agg(F.min(F.struct(*fields, "record_id", "file")).alias(kind)))

    metadata = of("metadata", "page_id")
    responses = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", "refers_to_record",
        F.struct("kind", "target_uri", "warc_date", "status", "payload_bytes", "payload_digest",
                 "payload", "file").alias("response"))
    captures = responses.join(of("request", "target_uri", "method"), "record_id", "left").join(
        metadata, "record_id", "left")
    # One payload may be repeated by a third of all pages: the few records that are
    # referred to are resolved first, and revisits meet them on a join that can be split.
    revisits = records.where(F.col("refers_to_record").isNotNull()).select("record_id", "refers_to_record")
    referred = revisits.select(F.col("refers_to_record").alias("record_id")).distinct()
    targets = saved(referred.join(metadata, "record_id").select(
        F.col("record_id").alias("refers_to_record"), F.col("metadata.page_id").alias("refers_to")), "warc-targets")
    resolved = revisits.join(targets, "refers_to_record").groupBy("record_id").agg(
        F.min("refers_to").alias("refers_to"))
    return captures.drop("refers_to_record").join(resolved, "record_id", "left")
