"""Block gzip: ranges cut anywhere give every line once."""

import gzip
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from cellbulk import schemas
from cellbulk.sources import block_gzip as bg
from cellbulk.sources.readers import scan_fragments


def packed(text: bytes, sizes) -> bytes:
    """Blocks with contents of the given sizes in turn, and the end mark."""
    out, at, i = [], 0, 0
    while at < len(text):
        size = sizes[i % len(sizes)]
        out.append(bg.block(text[at:at + size]))
        at, i = at + size, i + 1
    return b"".join(out) + bg.block(b"")


def lines_in(data: bytes, start: int, stop: int) -> list[str]:
    pieces = bg.owned_text(bg.Bytes(io.BytesIO(data)), start, stop)
    return [v for b in bg.line_batches(pieces, "f", 40) for v in b.column("value").to_pylist()]


TEXTS = {
    "short lines": "".join(f"line {i}\n" for i in range(400)).encode(),
    "no last line end": "".join(f"{i}\n" for i in range(50)).encode() + b"last",
    "long line over many blocks": b"a\n" + b"x" * 5000 + b"\nb\nc\n",
    "empty lines": b"\n\na\n\n\nb\n",
    "magic inside": (bg.MAGIC + b"\x00BC\x02\x00\xff\x00\n") * 60,
    "carriage returns": b"a\r\nb\r\n",
    "nothing": b"",
}


@pytest.mark.parametrize("name", TEXTS)
@pytest.mark.parametrize("sizes", [[1], [7], [64, 3, 1, 500], [65_280]])
def test_every_cut_gives_every_line_once(name, sizes):
    text = TEXTS[name]
    data = packed(text, sizes)
    whole = text.decode("utf-8", "replace").removesuffix("\n").replace("\r", "").split("\n") if text else []
    assert gzip.decompress(data) == text
    assert lines_in(data, 0, len(data)) == whole
    rng = random.Random(len(data))
    for step in (1 + len(data) // 2, 1 + len(data) // 7, 97, *(rng.randrange(1, len(data) + 2) for _ in range(4))):
        cuts = [(s, min(s + step, len(data))) for s in range(0, len(data), step)][:4000]
        if len(cuts) * len(data) < 40_000_000:
            assert [v for a, b in cuts for v in lines_in(data, a, b)] == whole


def test_bytes_that_do_not_compress():
    noise = random.Random(1).randbytes(bg.PAYLOAD)
    assert gzip.decompress(bg.block(noise)) == noise


def test_plain_gzip_and_several_members():
    data = gzip.compress(b"a\nb\n") + gzip.compress(b"c\n")
    assert lines_in(data, 0, 9) == ["a", "b", "c"] and lines_in(data, 9, len(data)) == []
    with pytest.raises(ValueError, match="ends within"):
        lines_in(data[:-12], 0, 9)


def test_damage_is_an_error():
    data = bytearray(packed(TEXTS["short lines"], [500]))
    data[len(data) // 2] ^= 255
    with pytest.raises(ValueError, match="no whole block"):
        lines_in(bytes(data), 0, len(data))


def fragments(spark, n=30_000):
    return spark.range(n).select(
        F.concat(F.lit("ACC"), (F.col("id") % 2).cast("string")).alias("analysis_set_accession"),
        F.concat(F.lit("chr"), (F.col("id") % 5).cast("string")).alias("contig"), (F.col("id") * 7919 % 99991).alias("frag_start"),
        (F.col("id") * 7919 % 99991 + 150).alias("frag_end"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.md5(F.col("id").cast("string"))).alias("barcode_sample"),
        (1 + F.col("id") % 4).alias("num_reads"))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    folder = f"file://{tmp_path}/blocks"
    rows = fragments(spark)
    bg.write_fragment_blocks(rows.repartition(1).sortWithinPartitions("analysis_set_accession", "contig", "frag_start"), folder)
    names = sorted(os.listdir(tmp_path / "blocks"))
    assert [n.split(".")[0] for n in names] == ["ACC0", "ACC1"]  # nothing hidden stays
    got = bg.scan_fragment_blocks(spark, folder, split_bytes=50_000)
    tasks = got.groupBy("analysis_set_accession", F.spark_partition_id().alias("task")).count().collect()
    assert len({r.task for r in tasks}) > 10 and max(r["count"] for r in tasks) < 5_000
    assert got.dtypes == scan_fragments(spark, folder).dtypes
    for other in (rows, scan_fragments(spark, folder)):
        assert got.exceptAll(other).isEmpty() and other.exceptAll(got).isEmpty()


def test_plain_gzip_file_is_one_task(spark, tmp_path):
    folder = f"file://{tmp_path}/plain"
    fragments(spark, 5000).drop("analysis_set_accession").coalesce(1).write.csv(folder, sep="\t", compression="gzip")
    got = bg.scan_fragment_blocks(spark, folder, split_bytes=10_000)
    assert got.select(F.spark_partition_id()).distinct().count() == 1
    want = spark.read.schema(schemas.FRAGMENT).csv(folder, sep="\t")
    assert got.drop("analysis_set_accession").exceptAll(want).isEmpty() and got.count() == 5000


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    bad = spark.range(10).select(F.lit("f").alias("file"), F.assert_true(F.col("id") < 9).cast("string").alias("value"))
    with pytest.raises(Exception):
        bg.write_lines(bad, f"file://{tmp_path}/out")
    assert not [n for _, _, names in os.walk(tmp_path) for n in names]


def test_no_files(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert bg.scan_lines(spark, f"file://{tmp_path}/none").collect() == []
