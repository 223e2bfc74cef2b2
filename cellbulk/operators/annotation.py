"""Cell metadata, annotation ids, TSS sites and gene tables."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellbulk import constants as C
from cellbulk import schemas
from cellbulk.functions.genomics import has_prefix


def with_pseudobulk_ids(metadata: DataFrame) -> DataFrame:
    """Add annotation (rank of the cell name, from 0) and pseudobulk_id.

    The rank window runs over the distinct names only and joins back.
    """
    names = metadata.select("cell_name").distinct()
    ranked = names.select(
        "cell_name",
        F.concat(F.lit("annotation_"),
                 F.dense_rank().over(Window.orderBy("cell_name")) - 1).alias("annotation"),
    )
    return metadata.join(ranked, "cell_name").select(
        *metadata.columns, "annotation",
        F.concat_ws("-", "annotation", "subsample").alias("pseudobulk_id"),
    )


def cell_name_mapping(annotated: DataFrame) -> DataFrame:
    return annotated.select(*schemas.MAPPING_COLUMNS).distinct()


def barcode_assignments(annotated: DataFrame, sequence: str | None = None) -> DataFrame:
    """One pseudobulk per (accession, barcode); the row with the highest sequence wins."""
    order = F.struct(F.col(sequence)) if sequence else F.struct("pseudobulk_id")
    return annotated.groupBy("analysis_set_accession", "barcode_sample").agg(
        F.max_by(F.struct("pseudobulk_id", "subsample", "cell_name"), order).alias("_row")
    ).select("analysis_set_accession", "barcode_sample", "_row.*")


def tss_sites(tss: DataFrame) -> DataFrame:
    """0-based, signed, distinct sites."""
    return tss.select(
        F.col("chro").alias("contig"),
        (F.col("TSS") - 1).cast("long").alias("tss0"),
        F.when(F.col("strand") == "+", 1).otherwise(-1).cast("long").alias("strand"),
    ).distinct()


def gtf_records(lines: DataFrame, *carry: str) -> DataFrame:
    """Feature rows of a GTF text; comment lines are dropped, ``carry`` columns kept."""
    field = F.split("value", "\t")
    return lines.where(~F.col("value").startswith("#")).select(
        field[0].alias("contig"), field[2].alias("feature"),
        field[3].cast("long").alias("start"), field[4].cast("long").alias("end"),
        field[6].alias("strand"), field[8].alias("attributes"), *carry,
    )


def _quoted(attributes: str, key: str):
    return F.nullif(F.regexp_extract(attributes, f'{key} "([^"]+)"', 1), F.lit(""))


def gtf_genes(records: DataFrame, sequence: str | None = None) -> DataFrame:
    """gene_id, gene_name, mt, ribo; of rows with one id the last in ``sequence`` counts."""
    genes = records.where(F.col("feature") == "gene").withColumn(
        "gene_id", _quoted("attributes", "gene_id")).where(F.col("gene_id").isNotNull())
    name = F.struct(F.coalesce(_quoted("attributes", "gene_name"), "gene_id").alias("gene_name"))
    order = F.col(sequence) if sequence else name
    return with_gene_classes(
        genes.groupBy("gene_id").agg(F.max_by(name, order).alias("_row"))
        .select("gene_id", "_row.gene_name")
    )


def with_gene_classes(genes: DataFrame) -> DataFrame:
    return genes.select(
        "gene_id", "gene_name",
        has_prefix(F.col("gene_name"), C.MITO_PREFIXES).alias("mt"),
        has_prefix(F.col("gene_name"), C.RIBO_PREFIXES).alias("ribo"),
    )


def attribute_map(attributes: str):
    """GTF attributes as a map; the last of equal keys wins, a value ends at its first space."""
    pairs = F.filter(F.split(F.trim(attributes), "; "), lambda p: F.size(F.split(p, " ")) > 1)
    entries = F.transform(pairs, lambda p: F.struct(
        F.split(p, " ")[0].alias("key"),
        F.regexp_replace(F.split(p, " ")[1], '^"(.*).$', "$1").alias("value"),
    ))
    last_only = F.filter(entries, lambda e, i: ~F.exists(
        F.slice(entries, i + 2, F.greatest(F.size(entries) - i - 1, F.lit(0))),
        lambda later: later["key"] == e["key"]))
    return F.map_from_entries(last_only)


def gtf_tss(records: DataFrame) -> DataFrame:
    """One TSS row per transcript: its start on the plus strand, its end on the minus strand."""
    attrs = attribute_map("attributes")
    return records.where(F.col("feature") == "transcript").select(
        attrs["gene_name"].alias("gene"), attrs["transcript_name"].alias("transcript"),
        F.col("contig").alias("chro"),
        F.when(F.col("strand") == "+", F.col("start")).otherwise(F.col("end")).alias("TSS"),
        "strand",
    )
