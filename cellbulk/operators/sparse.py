"""Count matrices with one row per cell: sorted gene numbers and their counts.

Genes of an accession are numbered by a dictionary, mitochondrial and ribosomal ones first,
so the class of a gene follows from its number and two limits per accession. Everything
that is asked of a cell is then in its row: no shuffle by cell, no join per count. Cells
and genes without counts stay. The length of a row is bounded by the genes of an accession.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellbulk.functions import stats as S
from cellbulk.operators.rna import BARCODE

ACCESSION = "analysis_set_accession"


def gene_dictionary(genes: DataFrame, gene_info: DataFrame) -> DataFrame:
    """(accession, gene_id, gene_no, gene_class) of distinct (accession, gene_id) rows.

    Numbers start at 0 in each accession. Classes: 0 both, 1 mitochondrial, 2 ribosomal,
    3 neither or unknown; numbers ascend with the class, then with the id.
    """
    info = gene_info.groupBy("gene_id").agg(F.bool_or("mt").alias("mt"), F.bool_or("ribo").alias("ribo"))
    mt, ribo = (F.coalesce(c, F.lit(False)) for c in ("mt", "ribo"))
    kind = F.when(mt & ribo, 0).when(mt, 1).when(ribo, 2).otherwise(3)
    rows = genes.select(ACCESSION, "gene_id").where(F.col("gene_id").isNotNull()).distinct().join(
        info, "gene_id", "left").select(ACCESSION, "gene_id", kind.alias("gene_class"))
    order = Window.partitionBy(ACCESSION).orderBy("gene_class", "gene_id")
    return rows.withColumn("gene_no", F.row_number().over(order) - 1).select(ACCESSION, "gene_id", "gene_no", "gene_class")


def to_sparse(counts: DataFrame, dictionary: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """(accession, barcode, genes array<int>, counts array<long>), one row per cell.

    Counts of a cell and gene that come in several rows are added up; zeros that are
    written stay. ``cells`` lists cells that may have no counts. A count whose gene the
    dictionary lacks is an error.
    """
    known = dictionary.select(ACCESSION, "gene_id", "gene_no")
    number = F.when(F.col("gene_no").isNull(), F.raise_error(F.concat_ws(
        " ", F.lit("no number for gene"), F.coalesce("gene_id", F.lit("NULL")), F.lit("of"), ACCESSION)).cast("int")).otherwise(F.col("gene_no"))
    numbered = counts.join(known, [ACCESSION, "gene_id"], "left").select(*BARCODE, number.alias("gene_no"), "count")
    # Placed by cell once; both aggregations then stay where the rows are.
    per_cell = numbered.repartition(*BARCODE).groupBy(*BARCODE, "gene_no").agg(F.sum("count").alias("count")).groupBy(
        *BARCODE).agg(F.array_sort(F.collect_list(F.struct("gene_no", "count"))).alias("_row"))
    rows = per_cell.select(*BARCODE, F.col("_row.gene_no").alias("genes"), F.col("_row.count").alias("counts"))
    if cells is None:
        return rows
    return cells.select(*BARCODE).distinct().join(rows, BARCODE, "left").select(
        *BARCODE, F.coalesce("genes", F.array().cast("array<int>")).alias("genes"),
        F.coalesce("counts", F.array().cast("array<bigint>")).alias("counts"))


def from_sparse(sparse: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(accession, barcode, gene_id, count): the long form again."""
    long = sparse.select(*BARCODE, F.inline(F.arrays_zip("genes", "counts"))).withColumnsRenamed(
        {"genes": "gene_no", "counts": "count"})
    return long.join(dictionary.select(ACCESSION, "gene_no", "gene_id"), [ACCESSION, "gene_no"]).select(
        *BARCODE, "gene_id", "count")


def class_limits(dictionary: DataFrame) -> DataFrame:
    """(accession, both, mito, ribo): how many numbers lie below the end of each class."""
    return dictionary.groupBy(ACCESSION).agg(*[
        F.count_if(F.col("gene_class") <= k).cast("int").alias(name) for k, name in enumerate(("both", "mito", "ribo"))])


def _sum_where(test) -> Column:
    return F.aggregate(F.arrays_zip("genes", "counts"), F.lit(0).cast("long"),
                       lambda total, e: total + F.when(test(e["genes"]), e["counts"]).otherwise(0))


def sparse_cell_qc(sparse: DataFrame, dictionary: DataFrame, assignments: DataFrame) -> DataFrame:
    """What ``rna_cell_qc`` computes, from within the row of each cell."""
    rows = sparse.join(class_limits(dictionary), ACCESSION, "left")
    totals = rows.select(
        *BARCODE, _sum_where(lambda g: F.lit(True)).alias("rna_read_count"),
        F.size(F.filter("counts", lambda c: c > 0)).cast("long").alias("gene_count"),
        _sum_where(lambda g: g < F.col("mito")).alias("_mt"),
        _sum_where(lambda g: (g < F.col("both")) | ((g >= F.col("mito")) & (g < F.col("ribo")))).alias("_ribo"))
    total = F.col("rna_read_count")
    return totals.join(assignments.select(*BARCODE, "pseudobulk_id"), BARCODE, "left").select(
        *BARCODE, F.col("pseudobulk_id").isNotNull().alias("annotated"), "pseudobulk_id",
        "rna_read_count", "gene_count", S.percent(F.col("_mt"), total).alias("pct_mito"),
        S.percent(F.col("_ribo"), total).alias("pct_ribo"))
