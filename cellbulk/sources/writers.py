"""Sinks. Each spreads large partitions over several files and packs small ones.

``rebalance`` lets adaptive execution size the output tasks by measured bytes, so
one pseudobulk holding a large share of the rows becomes several files instead of
one long task.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk import schemas
from cellbulk.functions import genomics as G
from cellbulk.functions.rows import unfold
from cellbulk.operators.intervals import in_genome_order


def write_partitioned(frame: DataFrame, path: str, by: Sequence[str], file_format: str = "parquet",
                      mode: str = "overwrite", **options: str) -> None:
    writer = frame.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).partitionBy(*by)
    writer.options(**options).format(file_format).save(path)


def write_tsv(frame: DataFrame, path: str, by: Sequence[str]) -> None:
    """Gzip TSV with a header, one folder per partition value."""
    write_partitioned(frame, path, by, "csv", sep="\t", header="true", compression="gzip")


def write_split_fragments(members: DataFrame, path: str) -> None:
    """Fragments and insertions per pseudobulk and accession, in four streams.

    ``members`` is read once: every fragment unfolds into its own row and its
    insertions, which go to the pooled stream and to one replicate stream. It is shuffled
    before that, as one row.
    """
    by = ["pseudobulk_id", "analysis_set_accession"]
    cut = G.insertion_sites(F.col("frag_start"), F.col("frag_end"))
    rep_stream = F.concat(F.lit("rep"), F.col("rep"))

    rows = unfold(
        ["stream", "start", "end"],
        ["fragments", F.col("frag_start"), F.col("frag_end")],
        *[[stream, cut[i], cut[i] + 1] for stream in ("repT", rep_stream) for i in (0, 1)],
    )
    placed = members.select(*by, "contig", "frag_start", "frag_end", "barcode_sample", "num_reads", "rep").hint(
        "rebalance", *[F.col(c) for c in by])
    placed.select(*by, "contig", "barcode_sample", "num_reads", rows).select(
        "contig", "start", "end", "barcode_sample", "num_reads", "stream", *by).write.mode(
        "overwrite").partitionBy("stream", *by).parquet(path)


def write_sorted_fragments(members: DataFrame, chrom_sizes: DataFrame, path: str) -> None:
    """Genome-sorted gzip fragment text per pseudobulk.

    Range partitioning on (pseudobulk, contig order, start) cuts large
    pseudobulks; the part files of a folder are in order by their names.
    """
    order = chrom_sizes.select(F.col("chr").alias("contig"), "chrom_order")
    placed = members.join(order, "contig", "left")
    columns = ["contig", "frag_start", "frag_end", "barcode_sample", "num_reads"]
    key = [F.col("pseudobulk_id"), F.col("chrom_order").asc_nulls_last(), F.col("frag_start"),
           F.col("frag_end"), F.col("barcode_sample"), F.col("num_reads").cast("string")]
    (placed.repartitionByRange(*key).sortWithinPartitions(*key)
     .select(*columns, "pseudobulk_id")
     .write.mode("overwrite").partitionBy("pseudobulk_id")
     .csv(path, sep="\t", compression="gzip"))
    write_manifest(members.sparkSession, path)


def write_manifest(spark: SparkSession, path: str) -> None:
    """(file, pseudobulk_id, contig, first_start, largest_end, rows) of sorted fragment files,
    next to them. One scan; what it shuffles is a row per file and contig."""
    rows = spark.read.schema(schemas.SORTED_FRAGMENT).csv(path, sep="\t").select(
        file_path(F.col("_metadata.file_path")).alias("file"), "pseudobulk_id", "contig", "frag_start", "frag_end")
    rows.groupBy("file", "pseudobulk_id", "contig").agg(
        F.min("frag_start").alias("first_start"), F.max("frag_end").alias("largest_end"),
        F.count("*").alias("rows")).write.mode("overwrite").parquet(manifest_of(path))


def manifest_of(path: str) -> str:
    return path.rstrip("/") + ".manifest"


def file_path(uri: Column) -> Column:
    """The path that a file's URI stands for."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def write_bedgraph(track: DataFrame, chrom_sizes: DataFrame, path: str,
                   by: Sequence[str] = ("pseudobulk_id",)) -> None:
    """Sorted bedGraph table per pseudobulk, in Parquet.

    A track that has ``chrom_order`` lies in partitions as of ``in_genome_order`` already.
    """
    placed = track if "chrom_order" in track.columns else in_genome_order(track, chrom_sizes, by)
    (placed.sortWithinPartitions(*by, "chrom_order", "start").drop("chrom_order")
     .write.mode("overwrite").partitionBy(*by).parquet(path))
