"""Block gzip text as a Spark data source: one large file is read by many tasks.

A block gzip file is a chain of gzip members of at most 64 KiB, each with its compressed
size in an extra header field. A task takes a range of the compressed bytes; it looks for
the first block that begins there, checks it by its checksum, and inflates the blocks
that begin in its range. Lines are shared out by where they begin: a task drops what
stands before the first line end of its range and completes the line that begins at or
before the start of the next range. A plain gzip file has no blocks and is read whole by
the task of its first range. Lines go to Spark as Arrow batches and are parsed there.

The writer makes such files: rows (file, value) of a task become ``{file}.{task}.{n}{suffix}``.
Tasks write below a hidden folder, and the driver moves the files of a job that succeeds,
so lost or repeated tasks leave nothing behind.

Paths are opened by pyarrow's file systems. A last line without a line end counts; ``\\r``
before a line end is dropped; a truncated or damaged block is an error.
"""

import json
import struct
import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from cellbulk import schemas
from cellbulk.functions.genomics import accession_of
from cellbulk.sources.readers import file_listing

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Layout of a block as published with the format.
MAGIC = b"\x1f\x8b\x08\x04"
HEADER, TAIL = "<4sIBBH2sHH", "<II"
HEADER_SIZE, TAIL_SIZE = struct.calcsize(HEADER), struct.calcsize(TAIL)
LARGEST, PAYLOAD = 1 << 16, 65_280

SPLIT_BYTES = 32 << 20
BATCH_BYTES = 4 << 20
_READ = 1 << 20


def opened(path: str):
    """(file system, path inside it)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def block(payload: bytes, level: int = 6) -> bytes:
    """One block; that of no bytes is the end mark."""
    packer = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packer.compress(payload) + packer.flush()
    size = HEADER_SIZE + len(body) + TAIL_SIZE
    if size > LARGEST:  # bytes that do not compress
        return block(payload[:len(payload) // 2], level) + block(payload[len(payload) // 2:], level)
    return struct.pack(HEADER, MAGIC, 0, 0, 255, 6, b"BC", 2, size - 1) + body + struct.pack(TAIL, zlib.crc32(payload), len(payload))


def extent(data: bytes, at: int) -> tuple[int, int] | None:
    """(header length, block length) of the block header at ``at``; None if there is none."""
    if data[at:at + 4] != MAGIC or len(data) < at + 12:
        return None
    extra = int.from_bytes(data[at + 10:at + 12], "little")
    field, end = at + 12, at + 12 + extra
    while field + 4 <= min(end, len(data)):
        name, length = data[field:field + 2], int.from_bytes(data[field + 2:field + 4], "little")
        if name == b"BC" and length == 2 and field + 6 <= len(data):
            return 12 + extra, int.from_bytes(data[field + 4:field + 6], "little") + 1
        field += 4 + length
    return None


def inflated(data: bytes) -> bytes | None:
    """Contents of one whole block; None unless its checksum and length hold."""
    head, _ = extent(data, 0)
    try:
        content = zlib.decompress(data[head:-TAIL_SIZE], -15)
    except zlib.error:
        return None
    return content if struct.unpack(TAIL, data[-TAIL_SIZE:]) == (zlib.crc32(content), len(content)) else None


class Bytes:
    """Forward reading of a file by absolute position, a megabyte at a time."""

    def __init__(self, stream):
        self.stream, self.start, self.held = stream, 0, b""

    def get(self, at: int, count: int) -> bytes:
        if not self.start <= at <= at + count <= self.start + len(self.held):
            self.stream.seek(at)
            self.start, self.held = at, self.stream.read(max(count, _READ))
        return self.held[at - self.start:at - self.start + count]


def first_block(source: Bytes, start: int) -> int | None:
    """Where the first block at or after ``start`` begins."""
    window = source.get(start, 2 * LARGEST + 64)
    at = window.find(MAGIC)
    while 0 <= at <= LARGEST:
        found = extent(window, at)
        if found and len(window) >= at + found[1] and inflated(window[at:at + found[1]]) is not None:
            return start + at
        at = window.find(MAGIC, at + 1)
    return None


def blocks(source: Bytes, at: int) -> Iterator[tuple[int, bytes]]:
    """(position, contents) of all blocks from ``at`` on."""
    while head := source.get(at, 512):
        found = extent(head, 0)
        content = inflated(source.get(at, found[1])) if found else None
        if content is None:
            raise ValueError(f"no whole block at byte {at}")
        yield at, content
        at += found[1]


def members(source: Bytes) -> Iterator[bytes]:
    """Contents of a plain gzip file, member after member, in pieces."""
    at, unpacker = 0, zlib.decompressobj(31)
    while data := source.get(at, _READ):
        at += len(data)
        while data:
            if unpacker.eof:
                unpacker = zlib.decompressobj(31)
            yield unpacker.decompress(data)
            data = unpacker.unused_data
    if not unpacker.eof and at:
        raise ValueError("the file ends within a gzip member")


def owned_text(source: Bytes, start: int, stop: int) -> Iterator[bytes]:
    """Text of the lines that belong to the range, in pieces."""
    if extent(source.get(0, 512), 0) is None:
        if start == 0:
            yield from members(source)
        return
    at = first_block(source, start) if start else 0
    if at is None or at >= stop:
        return
    inside = start == 0
    for position, content in blocks(source, at):
        if position >= stop:
            if not inside:
                return  # no line ends in the range, so none begins there
            end = content.find(b"\n") + 1
            yield content[:end] if end else content
            if end:
                return
        elif inside:
            yield content
        elif end := content.find(b"\n") + 1:
            inside = True
            yield content[end:]


def line_batches(pieces: Iterable[bytes], name: str, most: int) -> Iterator[pa.RecordBatch]:
    """(file, value) batches of about ``most`` bytes of text; a longer line is a batch of its own."""
    held, size = [], 0
    for piece in pieces:
        held.append(piece)
        size += len(piece)
        if size >= most and b"\n" in piece:
            whole, _, rest = b"".join(held).rpartition(b"\n")
            yield as_batch(whole, name)
            held, size = [rest], len(rest)
    rest = b"".join(held)
    if rest:
        yield as_batch(rest.removesuffix(b"\n"), name)


def as_batch(text: bytes, name: str) -> pa.RecordBatch:
    lines = pc.list_flatten(pc.split_pattern(pa.array([text.decode("utf-8", "replace")], pa.large_string()), "\n"))
    lines = pc.utf8_rtrim(lines, characters="\r").cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(name), len(lines)), lines], names=["file", "value"])


@dataclass
class ByteRange(InputPartition):
    path: str
    start: int
    stop: int

    def __init__(self, path: str, start: int, stop: int):
        self.path, self.start, self.stop = path, start, stop


class BlockReader(DataSourceReader):
    def __init__(self, options):
        self.files = json.loads(options["files"])
        self.split, self.most = int(options["split_bytes"]), int(options["batch_bytes"])

    def partitions(self):
        return [ByteRange(path, start, min(start + self.split, length))
                for path, length in self.files for start in range(0, length, self.split)]

    def read(self, partition):
        if partition is None:  # Spark's one partition of a source that has none
            return
        filesystem, inner = opened(partition.path)
        with filesystem.open_input_file(inner) as stream:
            try:
                yield from line_batches(owned_text(Bytes(stream), partition.start, partition.stop),
                                        inner.rsplit("/", 1)[-1], self.most)
            except (ValueError, zlib.error) as error:
                raise ValueError(f"{partition.path}: {error}") from error


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


class BlockWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.suffix = options["path"].rstrip("/"), options["suffix"]
        self.hidden = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def write(self, iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        attempt, names, now, stream, held = uuid.uuid4().hex, [], None, None, bytearray()
        filesystem, inner = opened(f"{self.hidden}/{attempt}")
        filesystem.create_dir(inner, recursive=True)

        def ended():
            if stream:
                stream.write(block(bytes(held)) + block(b"")) if held else stream.write(block(b""))
                stream.close()
                held.clear()

        try:
            for batch in iterator:
                for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                    if file != now or stream is None:
                        ended()
                        now = file
                        names.append(f"{attempt}/{file}.{context.partitionId():05d}.{len(names)}{self.suffix}")
                        stream = filesystem.open_output_stream(f"{inner}/{names[-1].partition('/')[2]}", compression=None)
                    held += value.encode() + b"\n"
                    while len(held) >= PAYLOAD:
                        stream.write(block(bytes(held[:PAYLOAD])))
                        del held[:PAYLOAD]
        finally:
            ended()
        return Written(names)

    def commit(self, messages):
        filesystem, inner = opened(self.path)
        _, hidden = opened(self.hidden)
        for message in messages:
            for name in message.names if message else []:
                filesystem.move(f"{hidden}/{name}", f"{inner}/{name.partition('/')[2]}")
        self._clear()

    def abort(self, messages):
        self._clear()

    def _clear(self):
        from pyarrow import fs

        filesystem, hidden = opened(self.hidden)
        if filesystem.get_file_info(hidden).type == fs.FileType.Directory:
            filesystem.delete_dir(hidden)


class BlockGzip(DataSource):
    @classmethod
    def name(cls):
        return "block_gzip"

    def schema(self):
        return "file string, value string"

    def reader(self, schema):
        return BlockReader(self.options)

    def writer(self, schema, overwrite):
        return BlockWriter(self.options)


def scan_lines(spark: SparkSession, paths: str | list[str], split_bytes: int = SPLIT_BYTES,
               batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(file, value): every line of gzip files, in ranges of ``split_bytes`` compressed bytes.

    Spark lists the files; their names and lengths are all the driver gets.
    """
    found = [[r.path, r.length] for path in ([paths] if isinstance(paths, str) else paths)
             for r in file_listing(spark, path).where("length > 0").collect()]
    spark.dataSource.register(BlockGzip)
    return spark.read.format("block_gzip").options(
        files=json.dumps(found), split_bytes=split_bytes, batch_bytes=batch_bytes).load()


def scan_fragment_blocks(spark: SparkSession, paths: str | list[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Gzip fragment files, large block gzip files by many tasks; rows as by ``scan_fragments``."""
    kind = schemas.FRAGMENT.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    lines = scan_lines(spark, paths, split_bytes).where("value != ''")
    return lines.select(accession_of(F.col("file")).alias("analysis_set_accession"),
                        F.from_csv("value", kind, {"sep": "\t"}).alias("row")).select("analysis_set_accession", "row.*")


def write_fragment_blocks(fragments: DataFrame, path: str) -> None:
    """Block gzip text, part files named after their accession, in the order of the rows."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schemas.FRAGMENT.names]
    write_lines(fragments.select(F.col("analysis_set_accession").alias("file"), F.concat_ws("\t", *columns).alias("value")), path)


def write_lines(lines: DataFrame, path: str, suffix: str = ".tsv.gz") -> None:
    """Write rows (file, value) as block gzip below ``path``. Rows of a task that follow each
    other under one ``file`` share an output file; sort within partitions to keep these few."""
    lines.sparkSession.dataSource.register(BlockGzip)
    lines.select(F.col("file").cast("string"), F.coalesce(F.col("value"), F.lit("")).alias("value")).write.format(
        "block_gzip").options(path=path, suffix=suffix).mode("append").save()
