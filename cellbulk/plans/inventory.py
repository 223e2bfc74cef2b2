"""Inventory of written outputs: classes, checksums, reconciliation, lineage."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk.operators import inventory
from cellbulk.sources.checksums import file_md5


def output_inventory(spark: SparkSession, folder: str, mapping: DataFrame, records: DataFrame
                     ) -> dict[str, DataFrame]:
    """Tables describing a folder of per-pseudobulk outputs.

    ``mapping`` lists the known pseudobulks, ``records`` the file-set records.
    """
    files = file_md5(spark, folder).withColumn(
        "folder", F.element_at(F.split("path", "/"), -2))
    listing = files.select("folder", "name")
    return {
        "files": inventory.classify_files(files),
        "expected": inventory.expected_files(
            listing, folders=mapping.select(F.col("pseudobulk_id").alias("folder"))),
        "pseudobulks": inventory.id_reconcile(
            listing.select(F.col("folder").alias("pseudobulk_id")),
            mapping.select("pseudobulk_id"), "pseudobulk_id"),
        "lineage": inventory.lineage(records),
        "fragment_sources": inventory.joined_aliases(
            inventory.derived_from(records, "fragments"), "accession"),
        "matrix_sources": inventory.joined_aliases(
            inventory.derived_from(records, "cell by gene matrix"), "accession"),
    }
