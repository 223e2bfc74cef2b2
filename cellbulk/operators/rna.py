"""Count-matrix operators in coordinate form (accession, barcode, gene, count)."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellbulk.functions import stats as S

BARCODE = ["analysis_set_accession", "barcode_sample"]


def annotate_genes(rows: DataFrame, gene_info: DataFrame) -> DataFrame:
    """Left lookup of gene_symbol, mt and ribo; an unknown gene is neither."""
    info = gene_info.select("gene_id", F.col("gene_name").alias("gene_symbol"), "mt", "ribo")
    return rows.join(info, "gene_id", "left").select(
        *rows.columns, "gene_symbol",
        F.coalesce("mt", F.lit(False)).alias("mt"),
        F.coalesce("ribo", F.lit(False)).alias("ribo"),
    )


def rna_cell_qc(counts: DataFrame, gene_info: DataFrame, assignments: DataFrame,
                cells: DataFrame | None = None) -> DataFrame:
    """Counts, genes and class shares per cell, with the annotation flag.

    ``cells`` lists all barcodes of the matrix; those without a count get zeros.
    """
    count = F.col("count")
    # Only genes of a class are looked up; any other is neither.
    per_cell = annotate_genes(counts, gene_info.where("mt OR ribo")).groupBy(*BARCODE).agg(
        F.sum("count").alias("rna_read_count"),
        F.count_if(count > 0).alias("gene_count"),
        F.sum(F.when(F.col("mt"), count).otherwise(0)).alias("_mt"),
        F.sum(F.when(F.col("ribo"), count).otherwise(0)).alias("_ribo"),
    )
    if cells is not None:
        per_cell = cells.select(*BARCODE).distinct().join(per_cell, BARCODE, "left").na.fill(0)
    known = assignments.select(*BARCODE, "pseudobulk_id")
    total = F.col("rna_read_count")
    return per_cell.join(known, BARCODE, "left").select(
        *BARCODE, F.col("pseudobulk_id").isNotNull().alias("annotated"), "pseudobulk_id",
        "rna_read_count", "gene_count",
        S.percent(F.col("_mt"), total).alias("pct_mito"),
        S.percent(F.col("_ribo"), total).alias("pct_ribo"),
    )


def rna_gene_qc(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Per (accession, gene): cells with the gene, mean, total, dropout share."""
    per_accession = cells.groupBy("analysis_set_accession").agg(
        F.count_distinct("barcode_sample").alias("_cells"))
    per_gene = counts.groupBy("analysis_set_accession", "gene_id").agg(
        F.count_if(F.col("count") > 0).alias("n_cells_by_counts"),
        F.sum("count").alias("total_counts"),
    )
    return per_gene.join(per_accession, "analysis_set_accession").select(
        "analysis_set_accession", "gene_id", "n_cells_by_counts",
        S.ratio(F.col("total_counts"), F.col("_cells")).alias("mean_counts"),
        S.percent(F.col("_cells") - F.col("n_cells_by_counts"), F.col("_cells"))
        .alias("pct_dropout_by_counts"),
        "total_counts",
    )


def rna_subset(counts: DataFrame, assignments: DataFrame) -> DataFrame:
    """Counts of annotated cells with their pseudobulk."""
    return counts.join(assignments.select(*BARCODE, "pseudobulk_id"), BARCODE).select(
        "pseudobulk_id", *counts.columns)


def shared_genes(gene_universe: DataFrame, assignments: DataFrame,
                 genes: str = "inner") -> DataFrame:
    """Genes per pseudobulk: those all its accessions list, or any of them."""
    if genes not in ("inner", "outer"):
        raise ValueError(f"genes must be 'inner' or 'outer', not {genes!r}")
    lists = gene_universe.select("analysis_set_accession", "gene_id").distinct()
    with_matrix = lists.select("analysis_set_accession").distinct()
    members = assignments.select("pseudobulk_id", "analysis_set_accession").distinct().join(
        with_matrix, "analysis_set_accession", "left_semi")
    needed = members.groupBy("pseudobulk_id").agg(F.count("*").alias("_needed"))
    having = members.join(lists, "analysis_set_accession").groupBy(
        "pseudobulk_id", "gene_id").agg(F.count("*").alias("_having"))
    joined = having.join(needed, "pseudobulk_id")
    if genes == "inner":
        joined = joined.where(F.col("_having") == F.col("_needed"))
    return joined.select("pseudobulk_id", "gene_id")


def pseudobulk_expression(counts: DataFrame, gene_universe: DataFrame, gene_info: DataFrame,
                          assignments: DataFrame, genes: str = "inner",
                          subset: DataFrame | None = None) -> DataFrame:
    """Pooled counts, CPM and log10(CPM + 1) for every shared gene of a pseudobulk.

    ``subset`` takes what ``rna_subset`` made of the counts, where that is stored.
    """
    member = rna_subset(counts, assignments) if subset is None else subset
    sums = member.groupBy("pseudobulk_id", "gene_id").agg(
        F.sum("count").alias("counts"))
    listed = shared_genes(gene_universe, assignments, genes)
    pooled = listed.join(sums, ["pseudobulk_id", "gene_id"], "left").na.fill(0, ["counts"])
    total = F.sum("counts").over(Window.partitionBy("pseudobulk_id"))
    scaled = pooled.withColumn("CPM", S.ratio(F.col("counts"), total) * 1e6)
    return annotate_genes(scaled, gene_info).select(
        "pseudobulk_id", "gene_id", "gene_symbol", "mt", "ribo", "counts", "CPM",
        F.log10(F.col("CPM") + 1).alias("log10CPM"),
    )
