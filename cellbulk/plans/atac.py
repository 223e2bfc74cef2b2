"""Fragments to barcode QC and per-pseudobulk fragment tables."""

from pyspark.sql import DataFrame, SparkSession

from cellbulk import checks
from cellbulk import constants as C
from cellbulk.operators import annotation, atac
from cellbulk.session import saved
from cellbulk.sources import writers


def assignments_of(metadata: DataFrame, sequence: str | None = None) -> DataFrame:
    """Checked metadata as one row per (accession, barcode)."""
    named = annotation.with_pseudobulk_ids(checks.checked_metadata(metadata))
    return annotation.barcode_assignments(named, sequence)


def split_fragments(
    spark: SparkSession, fragments: DataFrame, metadata: DataFrame, chrom_sizes: DataFrame,
    tss: DataFrame, output: str, half_window: int = C.TSS_HALF_WINDOW,
    half_smooth: int = C.TSS_HALF_SMOOTH, seed: int = 42, sort: bool = True,
) -> dict[str, str]:
    """Write barcode QC, split streams and sorted fragments of all accessions.

    Returns the written folders. ``members``, the annotated fragments with their
    replicate, is the table the peak plan starts from. ``tss_profile`` holds lists per barcode,
    which ``readers.load_atac_qc`` gives back as rows.
    """
    paths = {name: f"{output}/{name}" for name in (
        "assignments", "atac_qc", "tss_profile", "tss_profile_pseudobulk", "members", "streams", "sorted_fragments")}
    assignments_of(metadata, "_sequence" if "_sequence" in metadata.columns else None).write.mode("overwrite").parquet(paths["assignments"])
    assigned = spark.read.parquet(paths["assignments"])

    watch = checks.placed(fragments, ["contig", "frag_start", "frag_end"], "the fragments")
    sites = annotation.tss_sites(tss)
    bands = saved(atac.tss_band_weights(sites, half_window, half_smooth), "tss-bands")
    counters = atac.barcode_counters(watch.rows, chrom_sizes, tss, half_window, half_smooth, bands=bands)
    writers.write_partitioned(atac.barcode_qc(counters, assigned, half_smooth),
                              paths["atac_qc"], ["analysis_set_accession"])
    watch.act(["exception"])

    # The whole profile, so that other smoothing and flanks can be tried afterwards. It is written
    # as the tasks that make it hold it, a row with lists per barcode.
    lists = atac.tss_profile_lists(atac.insertions(fragments), sites, half_window=half_window)
    lists.write.mode("overwrite").partitionBy("analysis_set_accession").parquet(paths["tss_profile"])
    profile = spark.read.schema(lists.schema).parquet(paths["tss_profile"])
    atac.tss_profile_of_lists(profile, assigned, half_window).write.mode(
        "overwrite").parquet(paths["tss_profile_pseudobulk"])

    members = atac.pseudobulk_fragments(fragments, assigned, chrom_sizes, seed)
    writers.write_partitioned(members, paths["members"], ["pseudobulk_id"])
    kept = spark.read.parquet(paths["members"])
    writers.write_split_fragments(kept, paths["streams"])
    if sort:
        writers.write_sorted_fragments(kept, chrom_sizes, paths["sorted_fragments"])
    return paths
