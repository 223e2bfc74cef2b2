"""Fragment operators: insertions, assignment, barcode QC, TSS profile, replicates."""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellbulk import constants as C
from cellbulk import schemas
from cellbulk.functions import genomics as G
from cellbulk.functions import stats as S
from cellbulk.functions.profiles import CONTIG, count_slots, list_slots, sum_lists, sum_slots
from cellbulk.functions.rows import slot_rows, unfold
from cellbulk.operators.annotation import tss_sites
from cellbulk.operators.intervals import (
    broadcast_limit,
    heavy_bins,
    joined_with_bins,
    points_in_intervals,
    spread_over_bins,
)
from cellbulk.operators.tracks import coverage
from cellbulk.session import saved, saved_bytes

BARCODE = ["analysis_set_accession", "barcode_sample"]
PARTS = "pseudobulk_id string, slots array<int>, n array<long>"


def shift_fragments(fragments: DataFrame) -> DataFrame:
    return fragments.withColumns({
        "frag_start": G.shifted_start(F.col("frag_start")),
        "frag_end": G.shifted_end(F.col("frag_end")),
    })


def insertions(fragments: DataFrame) -> DataFrame:
    """Two one-base rows per fragment, at its shifted ends; other columns pass through."""
    rest = [c for c in fragments.columns if c not in ("frag_start", "frag_end")]
    return fragments.select(
        *rest, F.explode(G.insertion_sites(F.col("frag_start"), F.col("frag_end"))).alias("pos")
    )


def with_size_class(fragments: DataFrame) -> DataFrame:
    start, end = F.col("frag_start"), F.col("frag_end")
    return fragments.withColumn(
        "size_class",
        F.when(G.is_nucleosome_free(start, end), "nucleosome_free")
        .when(G.is_mono_nucleosomal(start, end), "mono_nucleosomal").otherwise("other"),
    )


def contig_gate(fragments: DataFrame, chrom_sizes: DataFrame) -> DataFrame:
    """Fragments on a listed contig."""
    return fragments.join(chrom_sizes.select(F.col("chr").alias("contig")), "contig",
                          "left_semi").select(*fragments.columns)


def assign_pseudobulk(fragments: DataFrame, assignments: DataFrame) -> DataFrame:
    """Left lookup of the pseudobulk on (accession, barcode)."""
    return fragments.join(assignments.select(*BARCODE, "pseudobulk_id"), BARCODE, "left").select(
        *fragments.columns, "pseudobulk_id")


def pseudobulk_fragments(fragments: DataFrame, assignments: DataFrame,
                         chrom_sizes: DataFrame, seed: int = 42) -> DataFrame:
    """Annotated fragments on listed contigs with their pseudobulk and replicate."""
    gated = contig_gate(fragments, chrom_sizes)
    member = gated.join(assignments.select(*BARCODE, "pseudobulk_id"), BARCODE)
    return member.select(
        *fragments.columns, "pseudobulk_id",
        G.pseudo_replicate(seed, *[F.col(c) for c in (
            "analysis_set_accession", "contig", "frag_start", "frag_end", "barcode_sample",
            "num_reads")]).alias("rep"),
    )


def insertion_counts(members: DataFrame) -> DataFrame:
    """Insertions per (pseudobulk, rep, contig, pos); rep 't' pools reps '1' and '2'.

    Both replicates are counted in one aggregation and unfolded afterwards, so the
    pooled set costs no second pass over the fragments.
    """
    sites = members.select(
        "pseudobulk_id", "contig", "rep",
        F.explode(G.insertion_sites(F.col("frag_start"), F.col("frag_end"))).alias("pos"),
    )
    wide = sites.groupBy("pseudobulk_id", "contig", "pos").agg(
        F.count_if(F.col("rep") == "1").alias("n1"), F.count_if(F.col("rep") == "2").alias("n2"))
    return wide.select(
        "pseudobulk_id", "contig", "pos",
        unfold(["rep", "n"], ["t", F.col("n1") + F.col("n2")], ["1", F.col("n1")],
               ["2", F.col("n2")]),
    ).where("n > 0").select("pseudobulk_id", "rep", "contig", "pos", "n")


# --- TSS -------------------------------------------------------------------


def _sites_off_mito(sites: DataFrame) -> DataFrame:
    return sites.where(F.col("contig") != C.MITO_CONTIG)


def tss_pairs(points: DataFrame, sites: DataFrame, half_window: int = C.TSS_HALF_WINDOW,
              salt: int | None = None) -> DataFrame:
    """Every (insertion, TSS) pair within the window, with its strand-aware slot."""
    windows = _sites_off_mito(sites).select(
        "contig", "tss0", "strand", (F.col("tss0") - half_window).alias("_lo"),
        (F.col("tss0") + half_window + 1).alias("_hi"),
    )
    pairs = points_in_intervals(points, "pos", windows, "_lo", "_hi", ["contig"],
                                width=2 * half_window + 1, salt=salt)
    return pairs.withColumn(
        "slot", half_window + (F.col("pos") - F.col("tss0")) * F.col("strand")
    ).drop("_lo", "_hi")


def tss_profile(points: DataFrame, sites: DataFrame, keys: list[str] = BARCODE,
                half_window: int = C.TSS_HALF_WINDOW, heavy_rows: int = C.HEAVY_ROWS) -> DataFrame:
    """Insertions per slot around all TSS, in long form."""
    return slot_rows(tss_profile_lists(points, sites, keys, half_window, heavy_rows))


def tss_profile_lists(points: DataFrame, sites: DataFrame, keys: list[str] = BARCODE,
                      half_window: int = C.TSS_HALF_WINDOW, heavy_rows: int = C.HEAVY_ROWS) -> DataFrame:
    """Insertions per slot around all TSS, one row per key with two lists, ``slots`` in order and
    ``n``. A profile has about a row per insertion and site in reach; kept as lists it is neither
    hashed nor sorted nor shuffled in that form.

    An insertion is shuffled once, as one number, and meets the sites afterwards, where these are
    few enough to be broadcast; else with its slots. Keys of more than ``heavy_rows`` insertions
    are summed before they are shuffled instead, so that none of them meets in one task.
    """
    heavy = heavy_bins(points, keys, heavy_rows)
    held = _held_sites(sites)
    schema = T.StructType([*[points.schema[k] for k in keys], T.StructField("slots", T.ArrayType(T.IntegerType())),
                           T.StructField("n", T.ArrayType(T.LongType()))])

    def slots(some: DataFrame) -> DataFrame:
        return tss_slots(some.select(*keys, "contig", "pos"), sites, half_window)

    def counted(some: DataFrame) -> DataFrame:
        if held is not None:
            placed = _placed(some, held[0], keys).withColumn("_key", F.xxhash64(*keys))
            return placed.repartition("_key").sortWithinPartitions("_key").mapInArrow(list_slots(*held[1:], half_window), schema)
        listed = slots(some).repartition(*keys).groupBy(*keys).agg(F.flatten(F.collect_list("slots")).alias("slots"))
        return listed.mapInArrow(count_slots(2 * half_window + 1), schema)

    if heavy.isEmpty():
        return counted(points)
    named = F.broadcast(heavy.select(*keys))
    summed = slots(points.join(named, keys, "left_semi")).select(*keys, F.explode("slots").alias("slot")).groupBy(
        *keys, "slot").agg(F.count("*").alias("n"))
    lists = summed.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("slot", "n"))).alias("_rows")).select(
        *keys, F.col("_rows.slot").alias("slots"), F.col("_rows.n").alias("n"))
    return counted(points.join(named, keys, "left_anti")).unionByName(lists)


def _held_sites(sites: DataFrame) -> tuple[DataFrame, np.ndarray, np.ndarray] | None:
    """(contig, _code) and, ascending, the places (see ``profiles.CONTIG``) and strands of all
    sites, for functions over Arrow batches; None where the table is too large to be broadcast."""
    table = saved(_sites_off_mito(sites).select("contig", _coded_site()).na.drop(), "sites", plain=True)
    if saved_bytes(table) > broadcast_limit(table):
        return None
    found = table.toArrow()
    contigs = found["contig"].combine_chunks().dictionary_encode()
    names = [(name, i + 1) for i, name in enumerate(contigs.dictionary.to_pylist())]
    coded = found["_site"].to_numpy()
    places = ((contigs.indices.to_numpy().astype(np.int64) + 1) << CONTIG) + (coded >> 1)
    order = np.argsort(places, kind="stable")
    codes = sites.sparkSession.createDataFrame(names, "contig string, _code long")
    return codes, places[order], (coded[order] & 1) * 2 - 1


def _placed(points: DataFrame, codes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, _at) of the points on contigs that have sites; a row per such contig is broadcast."""
    return points.join(F.broadcast(codes), "contig").where(F.col("pos").isNotNull()).select(
        *keys, (F.shiftleft("_code", CONTIG) + F.col("pos")).alias("_at"))


def tss_slots(points: DataFrame, sites: DataFrame, half_window: int = C.TSS_HALF_WINDOW,
              heavy_rows: int = C.HEAVY_ROWS) -> DataFrame:
    """Points near some TSS with the array of their slots, one for each TSS in reach."""
    near = F.filter(F.transform("_sites", lambda site: _slot(site, half_window)),
                    lambda at: at.between(0, 2 * half_window))
    return _with_sites(points, sites, half_window, heavy_rows).select(
        *points.columns, near.cast("array<int>").alias("slots")).where(F.size("slots") > 0)


def _coded_site() -> Column:
    """Position and, in the last bit, strand of a site."""
    return (F.col("tss0") * 2 + (F.col("strand") > 0).cast("int")).cast("long").alias("_site")


def _slot(coded, half_window: int):
    return half_window + (F.col("pos") - F.shiftright(coded, 1)) * (coded.bitwiseAND(F.lit(1)) * 2 - 1)


def _with_sites(points: DataFrame, sites: DataFrame, half_window: int, heavy_rows: int = C.HEAVY_ROWS) -> DataFrame:
    """Points with the sites that reach into their bin.

    The sites of a bin are one row, a number each, so the table that may be broadcast is
    much smaller than one row per site. ``strand`` is 1 or -1.
    """
    width = 2 * half_window + 1
    site = F.col("tss0")
    lists = spread_over_bins(
        _sites_off_mito(sites).select("contig", _coded_site(),
                                      (site - half_window).alias("_lo"), (site + half_window + 1).alias("_hi")),
        F.col("_lo"), F.col("_hi"), width).groupBy("contig", "_bin").agg(F.collect_list("_site").alias("_sites"))
    return joined_with_bins(points, "pos", lists, ["contig"], width, heavy_rows)


def enrichment_from_profile(profile: DataFrame, keys: list[str] = BARCODE,
                            half_window: int = C.TSS_HALF_WINDOW,
                            half_smooth: int = C.TSS_HALF_SMOOTH,
                            flank: int = C.TSS_FLANK) -> DataFrame:
    """Enrichment from a slot profile; a key without central or flank slots gets 0."""
    slot = F.col("slot")
    center = slot.between(half_window - half_smooth, half_window + half_smooth)
    edges = (slot < flank) | (slot > 2 * half_window - flank)
    return profile.groupBy(*keys).agg(
        F.sum(F.when(center, F.col("n")).otherwise(0)).alias("center"),
        F.sum(F.when(edges, F.col("n")).otherwise(0)).alias("flank"),
    ).withColumn("tss_enrichment",
                 S.tss_enrichment(F.col("center"), F.col("flank"), half_smooth, flank))


def tss_profile_pseudobulk(profile: DataFrame, assignments: DataFrame) -> DataFrame:
    """Slot profile of every pseudobulk: the sum over its barcodes."""
    known = assignments.select(*BARCODE, "pseudobulk_id")
    return profile.join(known, BARCODE).groupBy("pseudobulk_id", "slot").agg(F.sum("n").alias("n"))


def tss_profile_of_pseudobulks(points: DataFrame, sites: DataFrame, assignments: DataFrame,
                               half_window: int = C.TSS_HALF_WINDOW) -> DataFrame:
    """What ``tss_profile_pseudobulk`` makes of the barcodes' profile, without that profile:
    few groups, so slots are summed before they are shuffled."""
    known = assignments.select(*BARCODE, "pseudobulk_id")
    members = points.select(*BARCODE, "contig", "pos").join(known, BARCODE).select("pseudobulk_id", "contig", "pos")
    held = _held_sites(sites)
    if held is not None:
        placed = _placed(members.where("pseudobulk_id IS NOT NULL"), held[0], ["pseudobulk_id"])
        return _summed_parts(placed.mapInArrow(sum_slots(*held[1:], half_window), PARTS))
    each = _with_sites(members, sites, half_window).select("pseudobulk_id", "pos", F.explode("_sites").alias("_site"))
    return each.select("pseudobulk_id", _slot(F.col("_site"), half_window).alias("slot")).where(
        F.col("slot").between(0, 2 * half_window)).groupBy("pseudobulk_id", "slot").agg(F.count("*").alias("n"))


def tss_profile_of_lists(lists: DataFrame, assignments: DataFrame, half_window: int = C.TSS_HALF_WINDOW) -> DataFrame:
    """What ``tss_profile_pseudobulk`` makes of the profile, from its lists per barcode: a row per
    barcode is joined, and every task sums its lists up before anything is shuffled."""
    known = assignments.select(*BARCODE, "pseudobulk_id").where("pseudobulk_id IS NOT NULL")
    named = lists.join(known, BARCODE).select("pseudobulk_id", "slots", "n")
    return _summed_parts(named.mapInArrow(sum_lists(2 * half_window + 1), PARTS))


def _summed_parts(parts: DataFrame) -> DataFrame:
    return slot_rows(parts).groupBy("pseudobulk_id", "slot").agg(F.sum("n").alias("n"))


def _bands(half_window: int, half_smooth: int, flank: int) -> tuple:
    site = F.col("tss0")
    return (
        (site - half_smooth, site + half_smooth + 1, 1, 0),
        (site - half_window, site - half_window + flank, 0, 1),
        (site + half_window - flank + 1, site + half_window + 1, 0, 1),
    )


def tss_band_weights(sites: DataFrame, half_window: int = C.TSS_HALF_WINDOW,
                     half_smooth: int = C.TSS_HALF_SMOOTH,
                     flank: int = C.TSS_FLANK) -> DataFrame:
    """Disjoint runs (contig, start, end, center, flank): in how many bands a base lies.

    The enrichment only needs how many central and flank bands cover an insertion.
    Both bands are symmetric around the site, so the strand plays no part, and
    counting them per base beforehand means an insertion meets at most one run
    however densely the sites lie.
    """
    spans = _sites_off_mito(sites).select(
        "contig", unfold(["start", "end", "c", "f"], *_bands(half_window, half_smooth, flank)))
    return coverage(spans, "start", "end", weights={"center": F.col("c"), "flank": F.col("f")})


def tss_enrichment(points: DataFrame, sites: DataFrame, keys: Sequence[str] = BARCODE,
                   half_window: int = C.TSS_HALF_WINDOW, half_smooth: int = C.TSS_HALF_SMOOTH,
                   flank: int = C.TSS_FLANK) -> DataFrame:
    """What ``enrichment_from_profile`` makes of the profile, without a row per slot.

    A further depth counts the windows over a base, so keys whose insertions all lie
    between the bands keep their row.
    """
    spans = _sites_off_mito(sites).select("contig", unfold(
        ["start", "end", "c", "f", "w"], *[(*band, 0) for band in _bands(half_window, half_smooth, flank)],
        (F.col("tss0") - half_window, F.col("tss0") + half_window + 1, 0, 0, 1)))
    runs = coverage(spans, "start", "end", weights={"center": F.col("c"), "flank": F.col("f"), "_near": F.col("w")})
    met = points_in_intervals(points.select(*keys, "contig", "pos"), "pos", runs, "start", "end", ["contig"], width=256)
    return met.groupBy(*keys).agg(F.sum("center").alias("center"), F.sum("flank").alias("flank")).withColumn(
        "tss_enrichment", S.tss_enrichment(F.col("center"), F.col("flank"), half_smooth, flank))


# --- barcode QC ------------------------------------------------------------


def barcode_counters(fragments: DataFrame, chrom_sizes: DataFrame, tss: DataFrame,
                     half_window: int = C.TSS_HALF_WINDOW,
                     half_smooth: int = C.TSS_HALF_SMOOTH, gate_qc: bool = False,
                     bands: DataFrame | None = None) -> DataFrame:
    """Additive counters per (accession, barcode), from one scan of the fragments.

    Each fragment yields its two insertions; the first of them also carries the
    fragment's own counters. An insertion meets at most one band run, so the left
    join copies nothing, and map-side combination shrinks a barcode that holds a
    large share of the fragments before it is shuffled. Contigs off the list count
    unless ``gate_qc``. ``bands`` takes ``tss_band_weights`` made, and best written, before.
    """
    listed = chrom_sizes.select(F.col("chr").alias("contig"), F.lit(True).alias("_listed"))
    source = contig_gate(fragments, chrom_sizes) if gate_qc else fragments
    start, end = F.col("frag_start"), F.col("frag_end")
    one = F.lit(1).cast("long")
    none = F.lit(0).cast("long")
    points = source.join(listed, "contig", "left").select(
        *BARCODE, "contig", "_listed",
        unfold(
            ["pos", "_frags", "_reads", "_mono", "_free"],
            [G.shifted_start(start), one, F.col("num_reads").cast("long"),
             G.is_mono_nucleosomal(start, end).cast("long"),
             G.is_nucleosome_free(start, end).cast("long")],
            [G.shifted_end(end) - 1, none, none, none, none],
        ),
    )
    if bands is None:
        bands = tss_band_weights(tss_sites(tss), half_window, half_smooth)
    met = points_in_intervals(points, "pos", bands, "start", "end", ["contig"], width=256,
                              how="left")
    return met.groupBy(*BARCODE).agg(
        F.sum("_frags").alias("num_frags"),
        F.sum("_reads").alias("raw-num_reads"),
        F.sum("_mono").alias("raw-mono_nucleosomal_frags"),
        F.sum("_free").alias("raw-nucleosome_free_frags"),
        F.coalesce(F.sum("center"), none).alias("raw-tss_center"),
        F.coalesce(F.sum("flank"), none).alias("raw-tss_flank"),
        F.coalesce(F.bool_or("_listed"), F.lit(False)).alias("_on_listed_contig"),
    )


def barcode_qc(counters: DataFrame, assignments: DataFrame,
               half_smooth: int = C.TSS_HALF_SMOOTH) -> DataFrame:
    """Published barcode metrics; the metadata lookup happens after aggregation."""
    known = assignments.select(*BARCODE, "pseudobulk_id")
    reads, frags = F.col("raw-num_reads"), F.col("num_frags")
    return counters.join(known, BARCODE, "left").select(
        *BARCODE, "pseudobulk_id",
        (F.col("pseudobulk_id").isNotNull() & F.col("_on_listed_contig")).alias("annotated"),
        "num_frags",
        S.duplicated_pct(reads, frags).alias("pct_duplicated_reads"),
        S.nucleosomal_signal(F.col("raw-mono_nucleosomal_frags"),
                             F.col("raw-nucleosome_free_frags")).alias("nucleosomal_signal"),
        S.tss_enrichment(F.col("raw-tss_center"), F.col("raw-tss_flank"), half_smooth)
        .alias("tss_enrichment"),
        "raw-num_reads", (reads - frags).alias("raw-num_dup_reads"),
        "raw-mono_nucleosomal_frags", "raw-nucleosome_free_frags",
        *schemas.ATAC_TSS_COLUMNS,
    )
