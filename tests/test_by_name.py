"""Files with differing headers as one frame."""

import gzip

import pytest
from pyspark.sql import types as T

from cellbulk.sources import by_name

FILES = {
    "a.tsv": "x\ty\tname\n1\t2.5\tone\n2\t\ttwo\n",
    "b.tsv": "﻿name\tx\n three\t3\n",
    "c.tsv": "y\n7\nnot a number\n",
    "d.tsv": "z\tx\n\"q\tq\"\t4\n",
    "e.tsv": "x\ty\tname\n",
    "f.tsv": "",
}
SCHEMA = T.StructType([T.StructField("x", T.LongType()), T.StructField("name", T.StringType()), T.StructField("y", T.DoubleType())])


@pytest.fixture
def folder(tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text)
    return f"file://{tmp_path}"


def rows(frame):
    return sorted(map(str, map(tuple, frame.collect())))


def test_columns_by_name(spark, folder):
    got = by_name.scan_by_name(spark, folder, SCHEMA, sep="\t")
    assert got.schema == SCHEMA
    assert rows(got) == sorted(map(str, [(1, "one", 2.5), (2, "two", None), (3, " three", None), (None, None, 7.0),
                                         (None, None, None), (4, None, None)]))


def test_all_columns_and_found_types(spark, folder):
    text = by_name.scan_by_name(spark, folder, sep="\t")
    assert text.columns == ["x", "y", "name", "z"] and {t for _, t in text.dtypes} == {"string"}
    found = by_name.with_found_types(text.where("x IS NOT NULL"))
    assert dict(found.dtypes) == {"x": "bigint", "y": "double", "name": "string", "z": "string"}
    assert rows(found.where("x = 4")) == [str((4, None, None, "q\tq"))]
    assert by_name.with_found_types(text.where("false")).dtypes == text.dtypes


def test_required_columns(spark, folder):
    with pytest.raises(ValueError, match=r"b\.tsv lacks the columns y"):
        by_name.scan_by_name(spark, [f"{folder}/a.tsv", f"{folder}/b.tsv"], SCHEMA, required=["x", "y"])


def test_repeated_name_is_refused(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b,a\n1,2,3\n")
    with pytest.raises(ValueError, match="repeats a"):
        by_name.scan_by_name(spark, f"file://{tmp_path}/r.csv")


def test_gzip_many_files_and_the_way_through_spark(spark, tmp_path, monkeypatch):
    for i in range(30):
        names = ["k", "v"] if i % 2 else ["v", "w", "k"]
        body = "".join(",".join({"k": str(i), "v": str(r), "w": "w"}[n] for n in names) + "\n" for r in range(50))
        with gzip.open(tmp_path / f"p{i}.csv.gz", "wt") as out:
            out.write(",".join(names) + "\n" + body)
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    want = sorted(str((i, r)) for i in range(30) for r in range(50))
    assert rows(by_name.scan_by_name(spark, f"file://{tmp_path}/*.csv.gz", schema)) == want
    monkeypatch.setattr(by_name, "OPENED_DIRECTLY", ())
    assert rows(by_name.scan_by_name(spark, f"file://{tmp_path}/*.csv.gz", schema)) == want


def test_no_files(spark, tmp_path):
    assert by_name.scan_by_name(spark, f"file://{tmp_path}", SCHEMA, sep="\t").collect() == []
