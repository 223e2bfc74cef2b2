"""Scans of delimited text, GTF, count tables and file listings."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellbulk import schemas
from cellbulk.functions.genomics import accession_of
from cellbulk.functions.rows import slot_rows

# The separators of the accepted suffixes.
SEPARATORS = {".tsv": "\t", ".tsv.gz": "\t", ".csv": ",", ".csv.gz": ","}


def separator_of(path: str) -> str:
    for suffix, sep in SEPARATORS.items():
        if path.rstrip("/").endswith(suffix):
            return sep
    raise ValueError(f"no separator known for the suffix of {path}; pass sep")


def _file_name() -> Column:
    return F.col("_metadata.file_name")


def scan_fragments(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Fragment files (tab separated, plain or gzip); the file name gives the accession.

    A gzip file is one task here; ``scan_fragment_blocks`` reads block gzip in ranges.
    """
    raw = spark.read.schema(schemas.FRAGMENT).option("sep", "\t").csv(paths)
    return raw.select(accession_of(_file_name()).alias("analysis_set_accession"),
                      *schemas.FRAGMENT.names)


def read_region(spark: SparkSession, path: str, contig: str, start: int, end: int,
                pseudobulks: Sequence[str] | None = None) -> DataFrame:
    """Fragments of sorted files that overlap [start, end) of a contig.

    The manifest names the files that reach into the region; no other is opened. The driver
    sees their names only.
    """
    manifest = spark.read.parquet(path.rstrip("/") + ".manifest").where(
        (F.col("contig") == contig) & (F.col("first_start") < end) & (F.col("largest_end") > start))
    if pseudobulks is not None:
        manifest = manifest.where(F.col("pseudobulk_id").isin(list(pseudobulks)))
    files = [r.file for r in manifest.select("file").distinct().collect()]
    if not files:
        return spark.createDataFrame([], schemas.SORTED_FRAGMENT)
    rows = spark.read.schema(schemas.SORTED_FRAGMENT).option("sep", "\t").option("basePath", path).csv(files)
    return rows.where((F.col("contig") == contig) & (F.col("frag_start") < end) & (F.col("frag_end") > start))


def scan_table(spark: SparkSession, path: str, sep: str | None = None,
               schema: T.StructType | None = None, header: bool = True,
               required: Iterable[str] = ()) -> DataFrame:
    """Delimited text with a header; without a schema every column is text.

    With a schema the header line of every file must hold its names: columns are taken
    by position, so another header is refused.
    """
    used = sep or separator_of(path)
    reader = spark.read.option("sep", used).option("header", header)
    if header and schema is not None:
        refuse_other_headers(spark, path, used, schema.names)
    table = (reader.schema(schema) if schema is not None else reader).csv(path)
    table = table.toDF(*[c.lstrip("﻿").strip() for c in table.columns])
    missing = [c for c in required if c not in table.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return table


def refuse_other_headers(spark: SparkSession, path: str, sep: str, names: Sequence[str]) -> None:
    """Raise unless the first line of every file below ``path`` names these columns."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")
    first = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "at").alias("header"))
    want = sep.join(names)
    clean = F.regexp_replace(F.regexp_replace("header", "^\ufeff", ""), f' *"?(^|$|{sep})"? *', "$1")
    bad = first.where(~clean.eqNullSafe(F.lit(want))).first()
    if bad:
        raise ValueError(f"{bad.file} has the header {bad.header!r}, expected {want!r}")


def scan_qc(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
            index_col: str | None = None, exclude: Sequence[str] = (), sep: str = "\t"
            ) -> DataFrame:
    """QC tables, plain or gzip, under a declared schema; comma lists may exclude columns.

    The index column always stays.
    """
    if index_col is not None and index_col not in schema.names:
        raise ValueError(f"no index column {index_col}")
    dropped = {name for entry in exclude for name in entry.split(",")} - {index_col}
    table = spark.read.schema(schema).option("sep", sep).option("header", True).csv(paths)
    return table.drop(*dropped)


def read_all(spark: SparkSession, paths: Sequence[str], name_glob: str | None = None,
             file_format: str = "parquet") -> DataFrame:
    """One read over several folders, optionally limited to matching file names."""
    reader = spark.read.format(file_format)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(list(paths))


def paths_in(spark: SparkSession, listing: str) -> list[str]:
    """Input paths from a text file with one path per line."""
    rows = spark.read.text(listing).where(F.trim("value") != "").collect()
    return [row.value.strip() for row in rows]


def scan_counts(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.schema(schemas.COUNTS).parquet(*paths)


def scan_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Contig list with its order in the file.

    Contig lists hold a few thousand lines at most, and their order is the file's,
    so one small window numbers them.
    """
    raw = spark.read.schema(schemas.CHROM_SIZES).option("sep", "\t").csv(path)
    placed = raw.withColumn("_at", F.struct("_metadata.file_block_start",
                                            F.monotonically_increasing_id()))
    return placed.select("chr", "size", F.row_number().over(Window.orderBy("_at"))
                         .alias("chrom_order"))


def scan_gtf(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths)


def load_metadata(spark: SparkSession, path: str, sequence: bool = False) -> DataFrame:
    """Cell metadata; ``sequence`` adds ``_sequence``, the place of each row in the files,
    by which the plans let the last of the rows that repeat a barcode count."""
    table = scan_table(spark, path, required=schemas.METADATA_REQUIRED)
    if not sequence:
        return table
    return table.withColumn("_sequence", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at")))


def scan_inputs(spark: SparkSession, where: str, file_format: str = "parquet",
                listing: bool = False, name_glob: str | None = None) -> DataFrame:
    """Tables found by a path pattern, or named line by line in a listing file."""
    return read_all(spark, paths_in(spark, where) if listing else [where], name_glob, file_format)


def load_atac_qc(spark: SparkSession, path: str, where: Column | str | None = None,
                 columns: Sequence[str] | None = None, need_tss: str | None = None):
    """Barcode QC of all accessions, stored partitioned by accession.

    ``need_tss`` names the folder of the TSS profiles; the result is then the pair of the
    QC rows and the profile rows of their barcodes.

    Row filters and column choices reach the scan: the accession prunes folders,
    the rest prunes row groups and columns.
    """
    table = spark.read.parquet(path)
    if where is not None:
        table = table.where(where)
    chosen = table if columns is None else table.select([f"`{c}`" for c in columns])
    return (chosen, tss_rows_of(spark.read.parquet(need_tss), table)) if need_tss else chosen


def tss_rows_of(profile: DataFrame, kept: DataFrame) -> DataFrame:
    """TSS profile rows of the barcodes kept by a QC filter, from long form or from lists."""
    keys = ["analysis_set_accession", "barcode_sample"]
    rows = profile.join(kept.select(*keys), keys, "left_semi")
    return slot_rows(rows) if "slots" in rows.columns else rows


def file_listing(spark: SparkSession, path: str, name_glob: str | None = None) -> DataFrame:
    """Path, name and length of files; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")
