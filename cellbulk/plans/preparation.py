"""Reference tables from a gene annotation."""

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellbulk.operators import annotation
from cellbulk.sources import readers


def prepare_annotation(spark: SparkSession, gtf: str, output: str) -> dict[str, str]:
    """Write gene_info (CSV) and tss (TSV) from GTF text; returns the folders."""
    paths = {"gene_info": f"{output}/gene_info.csv", "tss": f"{output}/tss.tsv"}
    lines = readers.scan_gtf(spark, gtf).withColumn("_seq", F.monotonically_increasing_id())
    records = annotation.gtf_records(lines, "_seq")
    annotation.gtf_genes(records, "_seq").write.mode("overwrite").csv(
        paths["gene_info"], header=True)
    annotation.gtf_tss(records).write.mode("overwrite").csv(
        paths["tss"], sep="\t", header=True)
    return paths
