"""Per-pseudobulk and per-accession quality tables, and the report statistics."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk import checks
from cellbulk.operators import qc, report
from cellbulk.sources import writers


def summarize_pseudobulks(
    spark: SparkSession, assignments: DataFrame, atac_qc: DataFrame, rna_qc: DataFrame,
    expression: DataFrame | None, frip: DataFrame | None, output: str,
    on_mismatch: Sequence[str] = ("warning", "sentinel"),
) -> dict[str, str]:
    """Write per-cell QC and the summary; differing cell sets are acted upon."""
    paths = {name: f"{output}/{name}" for name in (
        "per_cell_qc", "pseudobulk_qc", "cell_set_mismatch")}
    differing = qc.cell_set_check(rna_qc, atac_qc).where("mismatch")
    checks.act_on(differing, on_mismatch, paths["cell_set_mismatch"])
    cells = qc.per_cell_qc(rna_qc, atac_qc, frip, assignments)
    writers.write_tsv(cells, paths["per_cell_qc"], ["pseudobulk_id"])
    counted = spark.read.schema(cells.schema).csv(paths["per_cell_qc"], sep="\t", header=True)
    qc.pseudobulk_summary(assignments, counted, atac_qc, expression, frip).orderBy(
        "directory_name").write.mode("overwrite").csv(
        paths["pseudobulk_qc"], sep="\t", header=True, compression="gzip")
    return paths


def combine_accessions(rna_qc: DataFrame, atac_qc: DataFrame, output: str) -> str:
    """Write the combined QC of every accession; returns the folder."""
    path = f"{output}/accession_qc"
    writers.write_tsv(qc.accession_qc(rna_qc, atac_qc), path, ["analysis_set_accession"])
    return path


def report_statistics(table: DataFrame, index: str, exclude: Sequence[str] = (),
                      most_outliers: int = 5) -> dict[str, DataFrame]:
    """Boxes and outliers of the numeric columns, shares of the others.

    ``table`` may be one QC table or the union of many.
    """
    left_out = {name for entry in exclude for name in entry.split(",")} | {index}
    fields = [f for f in table.schema.fields if f.name not in left_out]
    numbers = [f.name for f in fields if f.dataType.typeName() in (
        "double", "float", "long", "integer", "short", "byte")]
    others = [f.name for f in fields if f.name not in numbers]
    long = report.to_long(table.withColumn("_index", F.col(index)), ["_index"], numbers)
    return {
        "boxes": report.box_stats(long),
        "outliers": report.outliers(long, "_index", most_outliers),
        "categories": report.category_pct(table, others),
    }
