"""Count tables to cell QC, the name mapping and pooled expression."""

from pyspark.sql import DataFrame, SparkSession

from cellbulk import checks
from cellbulk.operators import annotation, rna
from cellbulk.sources import writers


def pseudobulk_rna(
    spark: SparkSession, counts: DataFrame, gene_universe: DataFrame, gene_info: DataFrame,
    metadata: DataFrame, output: str, cells: DataFrame | None = None, genes: str = "inner",
) -> dict[str, str]:
    """Write the RNA results of all accessions and pseudobulks; returns the folders."""
    paths = {name: f"{output}/{name}" for name in (
        "cell_name_mapping", "rna_assignments", "rna_qc", "pseudobulk_counts", "expression")}
    named = annotation.with_pseudobulk_ids(checks.checked_metadata(metadata))
    annotation.cell_name_mapping(named).write.mode("overwrite").csv(
        paths["cell_name_mapping"], sep="\t", header=True)
    annotation.barcode_assignments(
        named, "_sequence" if "_sequence" in named.columns else None).write.mode("overwrite").parquet(
        paths["rna_assignments"])
    assigned = spark.read.parquet(paths["rna_assignments"])

    writers.write_partitioned(rna.rna_cell_qc(counts, gene_info, assigned, cells),
                              paths["rna_qc"], ["analysis_set_accession"])
    writers.write_partitioned(rna.rna_subset(counts, assigned), paths["pseudobulk_counts"],
                              ["pseudobulk_id"])
    kept = spark.read.parquet(paths["pseudobulk_counts"])
    writers.write_tsv(
        rna.pseudobulk_expression(counts, gene_universe, gene_info, assigned, genes, kept),
        paths["expression"], ["pseudobulk_id"])
    return paths
