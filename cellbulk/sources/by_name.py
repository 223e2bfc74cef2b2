"""Delimited files whose columns differ in order and presence, read as one frame.

A first pass reads one line per file and makes a small table: file, and where each column
stands in it. The scan itself is one Spark CSV read over all files with as many unnamed
text columns as the widest header; a join with that table by file picks every column by
name. Columns a file lacks are NULL.
"""

import csv
import sys
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellbulk.session import saved
from cellbulk.sources.readers import file_listing, separator_of

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Path schemes that pyarrow opens; other stores are read through Spark.
OPENED_DIRECTLY = ("file:", "s3://", "gs://", "hdfs://", "/")


def _first_line(path: str) -> str:
    from pyarrow import fs

    local = path.startswith(("file:", "/"))
    filesystem, inner = (fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")) if local else fs.FileSystem.from_uri(path)
    with filesystem.open_input_stream(inner) as stream:
        line = b""
        while b"\n" not in line and (more := stream.read(1 << 12)):
            line += more
    return line.split(b"\n", 1)[0].decode("utf-8", "replace").rstrip("\r")


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, header) of every file. Where pyarrow knows the store, a task reads the start
    of its files only; elsewhere Spark reads them as text."""
    files = None
    for path in paths:
        found = file_listing(spark, path).where("length > 0").select("path")
        files = found if files is None else files.unionAll(found)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(header=[_first_line(p) for p in batch["path"]])

    if all(p.startswith(OPENED_DIRECTLY) for p in paths):
        return files.mapInPandas(run, "path string, header string")
    lines = spark.read.option("recursiveFileLookup", True).text(list(paths)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    return lines.where("block = 0").groupBy("path").agg(F.min_by("value", "at").alias("header"))


def header_names(header: str, sep: str) -> list[str]:
    """Column names of a header line, without byte order mark, quotes and outer spaces."""
    names = [n.strip() for n in next(csv.reader([header.lstrip("﻿")], delimiter=sep), [])]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"the header {header!r} repeats {', '.join(repeated)}")
    return names


def scan_by_name(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None,
                 sep: str | None = None, required: Sequence[str] = ()) -> DataFrame:
    """All rows of the files, also in folders below, columns matched by the name in each
    file's own header.

    With a schema its columns are taken and converted, a value that does not convert is
    NULL, and other columns are left out. Without one, every column that some file has is
    taken as text, in the order of the headers sorted by path. ``required`` names columns
    every file must have. How many headers differ, not how many files there are, decides
    the size of what the driver sees.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    used = sep or separator_of(paths[0])
    heads = saved(first_lines(spark, paths), "headers")
    layouts = [(r.header, header_names(r.header, used), r.path) for r in heads.groupBy("header").agg(
        F.min("path").alias("path")).orderBy("path").collect()]
    for _, names, path in layouts:
        lacking = [c for c in required if c not in names]
        if lacking:
            raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    fields = schema.fields if schema is not None else [
        T.StructField(n, T.StringType()) for n in dict.fromkeys(n for _, names, _ in layouts for n in names)]
    if not layouts:
        return spark.createDataFrame([], T.StructType(fields))
    kinds = spark.createDataFrame(
        [(header, *[names.index(f.name) if f.name in names else None for f in fields]) for header, names, _ in layouts],
        "_header string, " + ", ".join(f"_at{i} int" for i in range(len(fields))))
    places = saved(heads.withColumnsRenamed({"header": "_header"}).join(F.broadcast(kinds), "_header").drop("_header"), "layouts")
    width = max(len(names) for _, names, _ in layouts)
    raw = spark.read.schema(", ".join(f"_c{i} string" for i in range(width))).option("sep", used).option(
        "header", True).option("recursiveFileLookup", True).csv(paths).withColumn("_path", file_key(F.col("_metadata.file_path")))
    values = F.array(*[f"_c{i}" for i in range(width)])
    placed = raw.join(places.withColumn("_path", file_key(F.col("path"))).drop("path"), "_path")
    return placed.select(*[
        F.get(values, F.col(f"_at{i}")).try_cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def file_key(path: Column) -> Column:
    """A path without the slashes that follow a scheme, which Spark writes in several ways."""
    return F.regexp_replace(path, "^([a-z0-9]+:)/+", "$1/")


def with_found_types(frame: DataFrame) -> DataFrame:
    """Text columns as the narrowest of boolean, long and double that holds all their
    values, found in one aggregation; a column without values stays text."""
    texts = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    kinds = ("boolean", "bigint", "double")

    def fits(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        sound = value.try_cast(kind).isNotNull()
        if kind == "boolean":
            sound = F.lower(value).isin("true", "false")
        return F.bool_and(value.isNull() | sound)

    if not texts:
        return frame
    checks = frame.agg(*[F.struct(F.count(f"`{n}`").alias("n"), *[fits(n, k).alias(k) for k in kinds]).alias(n)
                         for n in texts]).first()
    chosen = {n: next((k for k in kinds if checks[n]["n"] and checks[n][k]), "string") for n in texts}
    return frame.select(*[F.col(f"`{c}`").cast(chosen[c]).alias(c) if c in chosen else F.col(f"`{c}`") for c in frame.columns])
