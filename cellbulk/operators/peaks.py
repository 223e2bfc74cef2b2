"""Peak calling as table operators: pile-up, background, score, regions, summits."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellbulk import constants as C
from cellbulk.functions import stats as S
from cellbulk.operators.intervals import clip_to_contigs, in_genome_order, levels_of, overlap_filter, with_chrom_order
from cellbulk.operators.ranking import top_n
from cellbulk.operators.tracks import (
    coverage,
    depth_zooms,
    number_islands,
    overlay,
    runs_end_near,
    shared_depths,
    window_depths,
)

SET = ("pseudobulk_id", "rep")
TRACK = (*SET, "contig")


def tag_totals(counts: DataFrame) -> DataFrame:
    """One row per set, that is three per pseudobulk: few enough to be broadcast."""
    return counts.groupBy(*SET).agg(F.sum("n").alias("tags"))


def treatment_pileup(counts: DataFrame, extension: int = C.TAG_EXTENSION,
                     per_million: bool = True) -> DataFrame:
    """Depth of tags widened around their insertion, optionally per million tags."""
    depth = window_depths(counts, "pos", "n", {"depth": extension}, TRACK)
    if not per_million:
        return depth.withColumnRenamed("depth", "value")
    return depth.join(F.broadcast(tag_totals(counts)), [*SET]).select(
        *TRACK, "start", "end", (F.col("depth") * 1e6 / F.col("tags")).alias("value"))


def pileup_zooms(counts: DataFrame, extension: int = C.TAG_EXTENSION, **levels: int) -> DataFrame:
    """Zoom levels of the depth of tags widened around their insertion."""
    return depth_zooms(counts, "pos", "n", extension, TRACK, **levels)


def _genome_rate(extension: int, genome_size: int) -> Column:
    return F.col("tags") * float(extension) / float(genome_size)


def control_lambda(counts: DataFrame, genome_size: int, extension: int = C.TAG_EXTENSION,
                   window: int = C.CONTROL_WINDOW) -> DataFrame:
    """Expected depth where tags are near: the larger of local and genome-wide rate."""
    depth = window_depths(counts, "pos", "n", {"depth": window}, TRACK)
    return depth.join(F.broadcast(tag_totals(counts)), [*SET]).select(
        *TRACK, "start", "end",
        F.greatest(F.col("depth") * float(extension) / float(window),
                   _genome_rate(extension, genome_size)).alias("value"))


def scored_segments(counts: DataFrame, genome_size: int, extension: int = C.TAG_EXTENSION,
                    window: int = C.CONTROL_WINDOW, ahead: int = 0) -> DataFrame:
    """Pile-up, background and -log10 p on common segments.

    Narrow and wide tags are two depths of one pass, so the tracks need no alignment
    afterwards. ``ahead`` is what ``segments_end_near`` found, if that was asked.
    """
    rated = counts.join(F.broadcast(tag_totals(counts)), [*SET])
    return window_depths(
        rated, "pos", "n", {"pileup": extension, "near": window}, TRACK, carry=["tags"], ahead=ahead,
        derive=S.segment_scores(extension, window, genome_size),
        values=T.StructType().add("pileup", "long").add("lambda", "double").add("score", "double"))


def regions(segments: DataFrame, cutoff: float = C.SCORE_CUTOFF, max_gap: int = C.MAX_PEAK_GAP,
            keys: Sequence[str] = TRACK) -> DataFrame:
    """Segments that reach the cutoff, numbered by the region they chain to."""
    return number_islands(
        segments.where(F.col("score") >= cutoff), keys,
        lambda previous, current: current["start"] - previous["end"] <= max_gap,
    )


def call_regions(segments: DataFrame, cutoff: float = C.SCORE_CUTOFF,
                 max_gap: int = C.MAX_PEAK_GAP, min_length: int = C.MIN_PEAK_LENGTH,
                 keys: Sequence[str] = TRACK) -> DataFrame:
    """One row per region: extent and the values at its highest segment.

    Among equal pile-ups the better score counts, then the leftmost segment.
    """
    best = F.struct("pileup", "score", (-F.col("start")).alias("_left"))
    at = F.max_by(F.struct("start", "end", "pileup", "lambda", "score"), best)
    called = regions(segments, cutoff, max_gap, keys).groupBy(*keys, "island").agg(
        F.min("start").alias("pk_start"), F.max("end").alias("pk_end"), at.alias("_at"))
    return called.where(F.col("pk_end") - F.col("pk_start") >= min_length).select(
        *keys, "pk_start", "pk_end",
        F.floor((F.col("_at.start") + F.col("_at.end")) / 2).cast("long").alias("summit"),
        F.col("_at.pileup").alias("pileup"),
        S.ratio(F.col("_at.pileup"), F.col("_at.lambda")).alias("signal_value"),
        F.col("_at.score").alias("neg_log10_p"),
    )


def summits(segments: DataFrame, cutoff: float = C.SCORE_CUTOFF, max_gap: int = C.MAX_PEAK_GAP,
            min_length: int = C.MIN_PEAK_LENGTH, keys: Sequence[str] = TRACK) -> DataFrame:
    """One row per local maximum of the pile-up inside each called region."""
    chained = regions(segments, cutoff, max_gap, keys)
    region = [*keys, "island"]
    along = Window.partitionBy(*region).orderBy("start")
    # Runs of equal pile-up may be cut where only the background changes.
    stepped = chained.withColumn(
        "_step", F.when(F.lag("pileup").over(along).eqNullSafe(F.col("pileup")), 0).otherwise(1)
    ).withColumn("_run", F.sum("_step").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    runs = stepped.groupBy(*region, "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.max("pileup").alias("pileup"),
        F.max_by(F.struct("score", "lambda"), F.struct("score", (-F.col("start")).alias("_left")))
        .alias("_at"),
    )
    whole = Window.partitionBy(*region)
    order = whole.orderBy("_run")
    below_left = F.coalesce(F.lag("pileup").over(order) < F.col("pileup"), F.lit(True))
    below_right = F.coalesce(F.lead("pileup").over(order) < F.col("pileup"), F.lit(True))
    marked = runs.select(
        *keys, F.min("start").over(whole).alias("pk_start"),
        F.max("end").over(whole).alias("pk_end"), "start", "end", "pileup", "_at",
        (below_left & below_right).alias("_peak"),
    )
    return marked.where(
        F.col("_peak") & (F.col("pk_end") - F.col("pk_start") >= min_length)
    ).select(
        *keys, "pk_start", "pk_end",
        F.floor((F.col("start") + F.col("end")) / 2).cast("long").alias("summit"), "pileup",
        S.ratio(F.col("pileup"), F.col("_at.lambda")).alias("signal_value"),
        F.col("_at.score").alias("neg_log10_p"),
    )


def narrow_peaks(peaks: DataFrame, keys: Sequence[str] = TRACK) -> DataFrame:
    """The ten narrowPeak columns; with a p cutoff no q value is made (-1)."""
    return peaks.select(
        *[k for k in keys if k != "contig"], "contig", "pk_start", "pk_end",
        F.concat_ws("_", *[k for k in keys], "summit").alias("name"),
        F.floor(F.col("neg_log10_p") * 10).cast("long").alias("score"),
        F.lit(".").alias("strand"), "signal_value", "neg_log10_p",
        F.lit(-1.0).alias("neg_log10_q"),
        (F.col("summit") - F.col("pk_start")).alias("summit_offset"),
    )


def top_peaks(peaks: DataFrame, n: int = C.TOP_PEAKS, group: Sequence[str] = SET) -> DataFrame:
    """The n most significant peaks per set."""
    return top_n(peaks, group, "neg_log10_p", n, ties=["contig", "pk_start", "pk_end"])


def reproducible_peaks(peaks: DataFrame, min_overlap: float = C.MIN_OVERLAP,
                       group: Sequence[str] = ("pseudobulk_id",)) -> DataFrame:
    """Pooled peaks that overlap a peak of replicate 1 and one of replicate 2."""
    kept = peaks.where(F.col("rep") == "t")
    # Every row of the other replicates is a partner on each level, so only those in use.
    levels = levels_of(kept, "pk_start", "pk_end")
    for rep in ("1", "2"):
        kept = overlap_filter(kept, "pk_start", "pk_end", peaks.where(F.col("rep") == rep),
                              "pk_start", "pk_end", [*group, "contig"], "semi", min_overlap, levels=levels)
    return kept


def blacklist_filter(peaks: DataFrame, blacklist: DataFrame) -> DataFrame:
    return overlap_filter(peaks, "pk_start", "pk_end", blacklist, "bl_start", "bl_end",
                          ["contig"], "anti")


def fragments_in_peaks(members: DataFrame, peaks: DataFrame) -> DataFrame:
    """Fragments that overlap a peak of their own pseudobulk."""
    return overlap_filter(members, "frag_start", "frag_end", peaks, "pk_start", "pk_end",
                          ["pseudobulk_id", "contig"], "semi")


def fisher_track(segments: DataFrame, chrom_sizes: DataFrame | None = None,
                 reps: Sequence[str] = ("1", "2", "t")) -> DataFrame:
    """-log10 p of the replicate scores combined, where all replicates have one."""
    track = segments.select(*TRACK, "start", "end", "score")
    if chrom_sizes is not None:
        track = clip_to_contigs(track, "contig", "start", "end", chrom_sizes)
    keys = ["pseudobulk_id", "contig"]
    aligned = overlay(track, "rep", reps, keys, "score")
    return aligned.select(*keys, "start", "end",
                          S.fisher_combine(*[F.col(r) for r in reps]).alias("value"))


def segments_end_near(counts: DataFrame, extension: int = C.TAG_EXTENSION, window: int = C.CONTROL_WINDOW,
                      tile: int = C.POINT_TILE) -> int:
    """How far behind a tile the segments that leave it end at most; 0 where some reach farther."""
    return runs_end_near(counts, "pos", "n", {"pileup": extension, "near": window}, TRACK, tile=tile)


def fisher_track_of_counts(counts: DataFrame, genome_size: int, chrom_sizes: DataFrame,
                           extension: int = C.TAG_EXTENSION, window: int = C.CONTROL_WINDOW,
                           ahead: int | None = None, in_order: bool = False, tile: int = C.POINT_TILE) -> DataFrame:
    """What ``fisher_track`` makes of ``scored_segments``, without segments of replicates.

    The pooled set is the sum of replicates 1 and 2, so only these are shuffled. ``counts`` is best a stored table.
    ``ahead`` is what ``segments_end_near`` found, if that was asked; where segments reach
    farther, they are made and overlaid. ``in_order`` asks for partitions that are ranges of the
    genome, pseudobulk by pseudobulk, and for ``chrom_order``.
    """
    if ahead is None:
        ahead = segments_end_near(counts, extension, window, tile)
    if not ahead:
        track = fisher_track(scored_segments(counts, genome_size, extension, window), chrom_sizes)
        return track if not in_order else in_genome_order(track, chrom_sizes)
    reps = ("1", "2")
    halves = counts.where(F.col("rep").isin(*reps))
    tags = [F.sum(F.when(F.col("rep") == r, F.col("n")).otherwise(0)).alias(f"_tags_{r}") for r in reps]
    totals = halves.groupBy("pseudobulk_id").agg(*tags, F.sum("n").alias("_tags_t"))
    sizes = chrom_sizes.select(F.col("chr").alias("contig"), F.col("size").alias("_size"), "chrom_order")
    order = ["pseudobulk_id", "chrom_order"] if in_order else []
    return shared_depths(
        halves.join(F.broadcast(totals), "pseudobulk_id").join(sizes, "contig"), "pos", "n", "rep", reps,
        {"pileup": extension, "near": window}, ["pseudobulk_id", "contig", *order[-1:]], ahead,
        S.fisher_scores(extension, window, genome_size), T.StructType().add("value", "double"), F.col("_size"),
        carry=[*[f"_tags_{r}" for r in reps], "_tags_t"], tile=tile, order=order)


def raw_insertion_track(counts: DataFrame) -> DataFrame:
    """Depth of the pooled one-base insertions."""
    return window_depths(counts.where(F.col("rep") == "t"), "pos", "n", {"depth": 1},
                         ["pseudobulk_id", "contig"], clip=False)


def raw_insertion_track_in_order(counts: DataFrame, chrom_sizes: DataFrame) -> DataFrame:
    """``raw_insertion_track`` in partitions as of ``in_genome_order``. ``counts`` is best a stored table."""
    whole = counts.where(F.col("rep") == "t")
    by, ahead = ["pseudobulk_id", "contig"], C.CONTROL_WINDOW
    if not runs_end_near(whole, "pos", "n", {"depth": 1}, by, clip=False, ahead=ahead):
        return in_genome_order(raw_insertion_track(counts), chrom_sizes)
    return window_depths(with_chrom_order(whole, chrom_sizes), "pos", "n", {"depth": 1}, [*by, "chrom_order"],
                         clip=False, ahead=ahead, order=["pseudobulk_id", "chrom_order"])


def peak_coverage_track(peaks: DataFrame) -> DataFrame:
    """Depth of the pooled peaks."""
    return coverage(peaks.where(F.col("rep") == "t"), "pk_start", "pk_end",
                    ["pseudobulk_id", "contig"])
