"""Merging RNA and ATAC quality tables, and totals per pseudobulk."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellbulk import constants as C
from cellbulk import schemas
from cellbulk.functions import stats as S
from cellbulk.operators.intervals import levels_of, overlap_flag

BARCODE = ["analysis_set_accession", "barcode_sample"]


def front_first(columns: list[str]) -> list[str]:
    front = [c for c in schemas.FRONT_COLUMNS if c in columns]
    return front + [c for c in columns if c not in front]


def without_raw(frame: DataFrame) -> DataFrame:
    return frame.select([f"`{c}`" for c in frame.columns if not c.startswith("raw-")])


def frip_per_cell(members: DataFrame, peaks: DataFrame) -> DataFrame:
    """Fragments, fragments in peaks and their share per cell of a pseudobulk.

    ``members`` is best a stored table: it is read for the lengths that occur, for the load of
    the bins and for the join.
    """
    # Peaks are spread over the bins of every level, so only those of lengths that occur.
    levels = levels_of(members, "frag_start", "frag_end")
    flagged = overlap_flag(members, "frag_start", "frag_end", peaks, "pk_start", "pk_end",
                           ["pseudobulk_id", "contig"], "_in_peak", levels=levels)
    counted = flagged.groupBy("pseudobulk_id", *BARCODE).agg(
        F.count("*").alias("num_fragments"),
        F.count_if("_in_peak").alias("num_fragments_in_peaks"),
    )
    return counted.withColumn(
        "frip", S.ratio(F.col("num_fragments_in_peaks"), F.col("num_fragments")))


def atac_with_frip(atac_qc: DataFrame, frip: DataFrame | None) -> DataFrame:
    """Full join on (accession, barcode); without peak results frip is NULL."""
    if frip is None:
        return atac_qc.withColumn("frip", F.lit(None).cast("double"))
    return atac_qc.join(frip.select(*BARCODE, "frip"), BARCODE, "full")


def merge_cell_qc(rna_qc: DataFrame, atac_qc: DataFrame, split_on_annotated: bool = True
                  ) -> DataFrame:
    """Full join of both sides with presence flags and front columns first.

    ``annotated`` may differ between the sides. It is part of the key by default;
    otherwise one row per barcode is made and either side's flag suffices.
    """
    keys = [*BARCODE, "annotated"] if split_on_annotated else BARCODE
    shared = ["pseudobulk_id"] if split_on_annotated else ["pseudobulk_id", "annotated"]

    def side(frame: DataFrame, tag: str) -> DataFrame:
        renamed = frame.withColumnsRenamed({c: f"_{tag}_{c}" for c in shared})
        return renamed.withColumn(f"found_in_{tag}", F.lit(True))

    merged = side(rna_qc, "rna").join(side(atac_qc, "atac"), keys, "full")
    merged = merged.withColumn(
        "pseudobulk_id", F.coalesce("_rna_pseudobulk_id", "_atac_pseudobulk_id"))
    if not split_on_annotated:
        merged = merged.withColumn(
            "annotated", F.coalesce("_rna_annotated", F.lit(False))
            | F.coalesce("_atac_annotated", F.lit(False)))
    merged = merged.na.fill(False, ["found_in_rna", "found_in_atac"]).na.fill(
        0, ["rna_read_count", "gene_count"])
    kept = [c for c in merged.columns if not c.startswith(("_rna_", "_atac_"))]
    return merged.select([f"`{c}`" for c in front_first(kept)])


def accession_qc(rna_qc: DataFrame, atac_qc: DataFrame) -> DataFrame:
    """Every barcode seen on either side, without the raw counters."""
    return merge_cell_qc(rna_qc, without_raw(atac_qc))


def per_cell_qc(rna_qc: DataFrame, atac_qc: DataFrame, frip: DataFrame | None,
                pseudobulks: DataFrame) -> DataFrame:
    """The per-cell table of every pseudobulk.

    ATAC-only and RNA-only cells both take the subsample of their pseudobulk.
    """
    atac = atac_with_frip(
        without_raw(atac_qc.where(F.col("pseudobulk_id").isNotNull())), frip)
    rna = rna_qc.where(F.col("pseudobulk_id").isNotNull())
    merged = merge_cell_qc(rna, atac)
    names = pseudobulks.select("pseudobulk_id", "subsample").distinct()
    return merged.join(names, "pseudobulk_id").select(
        "pseudobulk_id", *schemas.PER_CELL_COLUMNS)


def cell_set_check(rna_qc: DataFrame, atac_qc: DataFrame) -> DataFrame:
    """Cells per pseudobulk on each side and combined, with a mismatch flag."""
    key = [*BARCODE, "annotated", "pseudobulk_id"]
    rna = rna_qc.where(F.col("pseudobulk_id").isNotNull()).select(*key)
    atac = atac_qc.where(F.col("pseudobulk_id").isNotNull()).select(*key)
    tagged = rna.withColumn("_rna", F.lit(1)).withColumn("_atac", F.lit(0)).unionByName(
        atac.withColumn("_rna", F.lit(0)).withColumn("_atac", F.lit(1)))
    cells = tagged.groupBy(*key).agg(F.sum("_rna").alias("_rna"), F.sum("_atac").alias("_atac"))
    counted = cells.groupBy("pseudobulk_id").agg(
        F.sum("_rna").alias("rna_cells"), F.sum("_atac").alias("atac_cells"),
        F.count("*").alias("combined_cells"),
    )
    differs = (F.col("rna_cells") != F.col("atac_cells")) | (
        F.col("rna_cells") != F.col("combined_cells"))
    return counted.withColumn(
        "mismatch", (F.col("rna_cells") > 0) & (F.col("atac_cells") > 0) & differs)


def pseudobulk_summary(pseudobulks: DataFrame, cells: DataFrame, atac_qc: DataFrame,
                       expression: DataFrame | None, frip: DataFrame | None,
                       half_smooth: int = C.TSS_HALF_SMOOTH) -> DataFrame:
    """One row per pseudobulk, from sums of additive counters, never means of cells."""
    key = "pseudobulk_id"
    named = pseudobulks.select(key, "cell_name", "subsample").distinct()
    num_cells = cells.groupBy(key).agg(F.count("*").alias("num_cells"))
    atac = atac_qc.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum("num_frags").alias("num_frags"),
        F.sum("raw-num_reads").alias("_reads"),
        F.sum("raw-mono_nucleosomal_frags").alias("_mono"),
        F.sum("raw-nucleosome_free_frags").alias("_free"),
        F.sum("raw-tss_center").alias("_center"),
        F.sum("raw-tss_flank").alias("_flank"),
    )
    joined = num_cells.join(named, key, "left").join(atac, key, "left").na.fill(
        0, ["num_frags", "_reads", "_mono", "_free", "_center", "_flank"])
    if expression is None:
        joined = joined.withColumns({"_rna": F.lit(0), "_genes": F.lit(0),
                                     "_mt": F.lit(0), "_ribo": F.lit(0)})
    else:
        counts = F.col("counts")
        rna = expression.groupBy(key).agg(
            F.sum("counts").alias("_rna"), F.count_if(counts > 0).alias("_genes"),
            F.sum(F.when(F.col("mt"), counts).otherwise(0)).alias("_mt"),
            F.sum(F.when(F.col("ribo"), counts).otherwise(0)).alias("_ribo"),
        )
        joined = joined.join(rna, key, "left").na.fill(0, ["_rna", "_genes", "_mt", "_ribo"])
    if frip is None:
        joined = joined.withColumn("frip", F.lit(None).cast("double"))
    else:
        shares = frip.groupBy(key).agg(S.ratio(
            F.sum("num_fragments_in_peaks"), F.sum("num_fragments")).alias("frip"))
        joined = joined.join(shares, key, "left")
    return joined.select(
        F.col(key).alias("directory_name"),
        F.concat_ws("-", "cell_name", "subsample").alias("pseudobulk"),
        "cell_name", "subsample", "num_cells",
        F.col("_rna").cast("long").alias("rna_read_count"),
        F.col("_genes").cast("long").alias("gene_count"),
        S.percent(F.col("_mt"), F.col("_rna")).alias("pct_mito"),
        S.percent(F.col("_ribo"), F.col("_rna")).alias("pct_ribo"),
        "num_frags",
        S.duplicated_pct(F.col("_reads"), F.col("num_frags")).alias("pct_duplicated_reads"),
        S.nucleosomal_signal(F.col("_mono"), F.col("_free")).alias("nucleosomal_signal"),
        S.tss_enrichment(F.col("_center"), F.col("_flank"), half_smooth).alias("tss_enrichment"),
        "frip",
    )
