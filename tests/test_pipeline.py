"""Pipelines end to end, decisions on ambiguous rules, and invariance."""

import pytest
from pyspark.sql import functions as F

from cellbulk import checks, schemas
from cellbulk.catalog import Study, fragment_files
from cellbulk.operators import annotation, atac, qc, report, rna
from cellbulk.operators import peaks as peak_ops
from cellbulk.operators.intervals import levels_of
from cellbulk.plans import atac as atac_plan
from cellbulk.plans import peaks as peak_plan
from cellbulk.plans import rna as rna_plan
from cellbulk.plans import summary as summary_plan
from cellbulk.plans.inventory import output_inventory
from cellbulk.plans.preparation import prepare_annotation
from cellbulk.session import new_folder
from cellbulk.sources import readers
from cellbulk.streaming import ingest

SF_DIR = "/root/testdata/sf0.001"
META = ("barcode_sample string, cell_name string, cell_description string, CL_id string, "
        "CL_term_name string, subsample string, analysis_set_accession string")


@pytest.fixture(scope="module")
def study(spark):
    return Study(spark, SF_DIR)


def meta(spark, *rows):
    return spark.createDataFrame([(b, c, c, "CL", "t", s, a) for b, c, s, a in rows], META)


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    quoted = [f"`{c}`" for c in columns]
    left, right = a.select(quoted), b.select(quoted)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_annotation_ids_follow_sorted_names(spark):
    cells = annotation.with_pseudobulk_ids(meta(
        spark, ("B1", "zeta", "S1", "A"), ("B2", "alpha", "S2", "A"), ("B3", "Beta", "S1", "C")))
    got = {r.barcode_sample: r.pseudobulk_id for r in cells.collect()}
    assert got == {"B1": "annotation_2-S1", "B2": "annotation_1-S2", "B3": "annotation_0-S1"}


def test_last_metadata_row_wins(spark):
    cells = annotation.with_pseudobulk_ids(meta(
        spark, ("B1", "x", "S1", "A"), ("B1", "y", "S1", "A"))).withColumn(
        "seq", F.when(F.col("cell_name") == "x", 2).otherwise(1))
    assert annotation.barcode_assignments(cells, "seq").first().cell_name == "x"


def test_separator_stops_and_is_reported(spark):
    bad = meta(spark, ("B1", "x", "S-1", "A"))
    with pytest.raises(Exception, match="subsample contains"):
        checks.checked_metadata(bad).collect()
    assert checks.metadata_violations(bad).first().item == "S-1"
    with pytest.raises(ValueError, match="lacks"):
        checks.metadata_violations(bad.drop("CL_id"))


def test_failure_actions(spark, caplog):
    bad = spark.createDataFrame([("r", "i")], "rule string, item string")
    path = new_folder(spark, "sentinel")
    with caplog.at_level("WARNING"):
        assert not checks.act_on(bad, ["warning", "sentinel"], path)
    assert "checks failed" in caplog.text and spark.read.parquet(path).count() == 1
    with pytest.raises(RuntimeError):
        checks.act_on(bad, ["exception"])
    assert checks.act_on(bad.where("false"), ["exception"])


def test_suffix_decides_separator(spark):
    assert readers.separator_of("a/b.tsv.gz") == "\t" and readers.separator_of("x.csv") == ","
    with pytest.raises(ValueError):
        readers.separator_of("x.bed")


def test_merge_keeps_or_joins_annotated(spark):
    rna_qc = spark.createDataFrame([("A", "B1", True, "p", 5, 2, 1.0, 0.0)],
                                   "analysis_set_accession string, barcode_sample string, "
                                   "annotated boolean, pseudobulk_id string, rna_read_count long, "
                                   "gene_count long, pct_mito double, pct_ribo double")
    atac_qc = spark.createDataFrame([("A", "B1", "p", False, 3)],
                                    "analysis_set_accession string, barcode_sample string, "
                                    "pseudobulk_id string, annotated boolean, num_frags long")
    assert qc.merge_cell_qc(rna_qc, atac_qc).count() == 2
    joined = qc.merge_cell_qc(rna_qc, atac_qc, split_on_annotated=False).collect()
    assert len(joined) == 1 and joined[0].annotated and joined[0].found_in_atac
    empty = qc.merge_cell_qc(rna_qc.where("false"), atac_qc.where("false"))
    assert empty.count() == 0 and set(schemas.FRONT_COLUMNS) <= set(empty.columns)
    only = qc.merge_cell_qc(rna_qc.where("false"), atac_qc).first()
    assert only.rna_read_count == 0 and only.pct_mito is None and not only.found_in_rna


def test_missing_peaks_give_null_frip(spark, study):
    assert qc.atac_with_frip(study.atac_qc, None).where("frip IS NOT NULL").count() == 0


def test_gene_sets(spark):
    universe = spark.createDataFrame([("A", "g1"), ("A", "g2"), ("B", "g1")],
                                     "analysis_set_accession string, gene_id string")
    assigned = spark.createDataFrame([("A", "x", "p"), ("B", "y", "p"), ("C", "z", "p")],
                                     "analysis_set_accession string, barcode_sample string, "
                                     "pseudobulk_id string")
    got = {m: sorted(r.gene_id for r in rna.shared_genes(universe, assigned, m).collect())
           for m in ("inner", "outer")}
    assert got == {"inner": ["g1"], "outer": ["g1", "g2"]}


def test_gated_qc_drops_unlisted_contigs(spark, study):
    args = (study.fragments, study.chrom_sizes, study.tss)
    free = atac.barcode_counters(*args).agg(F.sum("num_frags")).first()[0]
    gated = atac.barcode_counters(*args, gate_qc=True).agg(F.sum("num_frags")).first()[0]
    assert free == study.fragments.count()
    assert gated == atac.contig_gate(study.fragments, study.chrom_sizes).count() < free


def test_partitioning_does_not_matter(spark, study):
    shuffled = study.fragments.repartition(7, "frag_start")
    args = (study.chrom_sizes, study.tss)
    assert same_rows(atac.barcode_counters(study.fragments, *args),
                     atac.barcode_counters(shuffled, *args))
    one = atac.pseudobulk_fragments(study.fragments, study.assignments, study.chrom_sizes)
    two = atac.pseudobulk_fragments(shuffled, study.assignments, study.chrom_sizes)
    assert same_rows(one, two)


def test_one_barcode_with_most_fragments(spark, study):
    hot = study.fragments.withColumn("barcode_sample", F.when(
        F.col("num_reads") > 1, "HOT").otherwise(F.col("barcode_sample")))
    got = atac.barcode_counters(hot, study.chrom_sizes, study.tss)
    assert got.agg(F.sum("num_frags")).first()[0] == study.fragments.count()
    want = hot.where("barcode_sample = 'HOT'").groupBy("analysis_set_accession").count().collect()
    rows = {r.analysis_set_accession: r.num_frags
            for r in got.where("barcode_sample = 'HOT'").collect()}
    assert rows == {r.analysis_set_accession: r["count"] for r in want}


def test_replicates_partition_the_pool(spark, study):
    totals = {r.rep: r.n for r in study.insertion_counts.groupBy("rep").agg(
        F.sum("n").alias("n")).collect()}
    assert totals["t"] == totals["1"] + totals["2"] == 2 * study.members.count()


def test_two_batches_equal_one(spark, study):
    folder = fragment_files(study).rsplit("/", 1)[0]
    results = []
    for files in (1, 100):
        partials, state = new_folder(spark, "partials"), new_folder(spark, "state")
        ingest.start_counting(ingest.fragment_stream(spark, folder, files), study.chrom_sizes,
                              study.tss, partials, state).awaitTermination()
        results.append(ingest.counters_so_far(spark, partials))
    assert same_rows(*results)
    assert same_rows(results[0], atac.barcode_counters(study.fragments, study.chrom_sizes, study.tss))


def test_box_and_outliers_on_ties(spark):
    rows = [("m", 1.0, f"c{i:02}") for i in range(20)] + [("m", 9.0, f"d{i:02}") for i in range(6)]
    long = spark.createDataFrame(rows, "metric string, value double, cell string")
    box = report.box_stats(long).first()
    assert (box.q1, box.median, box.q3, box.high, box.max_val) == (1.0, 1.0, 1.0, 1.0, 9.0)
    picked = report.outliers(long, "cell").collect()
    assert sorted(r.cell for r in picked) == [f"d{i:02}" for i in range(5)]


def test_approximate_quartiles_are_close(spark):
    long = spark.range(1000).select(F.lit("m").alias("metric"), F.col("id").cast("double").alias("value"))
    row = report.box_stats_approx(long).first()
    assert abs(row.median - 500) <= 2


def test_whole_pipeline(spark, study):
    out = new_folder(spark, "pipeline")
    split = atac_plan.split_fragments(spark, study.fragments, study.metadata, study.chrom_sizes,
                                      study.tss, out)
    sequenced = rna_plan.pseudobulk_rna(spark, study.counts, study.gene_universe, study.gene_info,
                                        study.metadata, out)
    members = spark.read.parquet(split["members"])
    peaks = peak_plan.call_peaks(spark, members, study.chrom_sizes, study.blacklist, out,
                                 genome_size=100_000_000)
    assigned = spark.read.parquet(split["assignments"])
    atac_qc = spark.read.parquet(split["atac_qc"])
    rna_qc = spark.read.parquet(sequenced["rna_qc"])
    expression = spark.read.option("header", True).option("sep", "\t").schema(
        study.expression.schema).csv(sequenced["expression"])
    frip = spark.read.parquet(peaks["frip_per_cell"])
    done = summary_plan.summarize_pseudobulks(spark, assigned, atac_qc, rna_qc, expression, frip, out)
    summary = spark.read.csv(done["pseudobulk_qc"], sep="\t", header=True).collect()
    assert len(summary) == members.select("pseudobulk_id").distinct().count()
    assert all(0 <= float(r.frip) <= 1 for r in summary)
    assert spark.read.parquet(done["cell_set_mismatch"]).count() > 0

    combined = summary_plan.combine_accessions(rna_qc, atac_qc, out)
    table = spark.read.csv(combined, sep="\t", header=True, schema=schemas.ACCESSION_QC)
    stats = summary_plan.report_statistics(table, "barcode_sample",
                                           ["analysis_set_accession,pseudobulk_id"])
    assert stats["boxes"].count() == 8 and stats["categories"].count() == 6

    lines = spark.read.text(split["sorted_fragments"] + "/pseudobulk_id=annotation_0-SM0")
    order = {r.chr: r.chrom_order for r in study.chrom_sizes.collect()}
    keys = [(order[c[0]], int(c[1]), int(c[2]), c[3], c[4])
            for c in (r.value.split("\t") for r in lines.orderBy("_metadata.file_name").collect())]
    assert keys == sorted(keys) and keys

    inventory = output_inventory(spark, split["sorted_fragments"], assigned.withColumn(
        "pseudobulk_id", F.concat(F.lit("pseudobulk_id="), "pseudobulk_id")),
        spark.createDataFrame([], schemas.FILE_SET_RECORD))
    assert {r.status for r in inventory["pseudobulks"].collect()} <= {"both", "left_only", "right_only"}


def test_annotation_preparation(spark, study):
    source, out = new_folder(spark, "gtf"), new_folder(spark, "reference")
    study.gtf_lines.write.text(source)
    paths = prepare_annotation(spark, source, out)
    genes = readers.scan_table(spark, paths["gene_info"], schema=schemas.GENE_INFO)
    sites = readers.scan_table(spark, paths["tss"], schema=schemas.TSS)
    assert genes.count() == sites.count() == study.part.count()
    assert annotation.tss_sites(sites).where("tss0 < 0").count() == 0


def test_frip_reads_stored_members_and_spreads_peaks_on_used_levels(spark, study):
    files = study.frip.inputFiles()
    bins = {f.rsplit("/", 1)[0] for f in files if "/bins-" in f}
    assert any("/members-" in f for f in files) and len(bins) == 1
    used = {r[0] for r in spark.read.parquet(*bins).select("_level").distinct().collect()}
    assert used and used <= set(levels_of(study.members, "frag_start", "frag_end"))


def test_expression_comes_from_the_stored_subset(spark, study):
    whole = rna.pseudobulk_expression(study.counts, study.gene_universe, study.gene_info, study.assignments)
    kept = rna.rna_subset(study.counts, study.assignments)
    again = rna.pseudobulk_expression(study.counts.limit(0), study.gene_universe, study.gene_info, study.assignments, subset=kept)
    assert same_rows(whole, again) and whole.count() > 0
    apart = Study(spark, SF_DIR)
    apart.store_counts()
    assert all("/counts-" in f for f in apart.gene_universe.inputFiles()) and same_rows(apart.counts, study.counts)


def test_peak_plan_makes_tracks_from_counts_in_genome_order(spark, study, monkeypatch):
    out = new_folder(spark, "peaks")
    with monkeypatch.context() as patch:
        patch.setattr(peak_ops, "overlay", None)  # segments are neither overlaid nor shuffled to be written
        patch.setattr(peak_plan.writers, "in_genome_order", None)
        paths = peak_plan.call_peaks(spark, study.members, study.chrom_sizes, study.blacklist, out, genome_size=100_000_000)
    counts, segments = (spark.read.parquet(paths[name]) for name in ("insertion_counts", "segments"))
    assert same_rows(counts, study.insertion_counts)
    assert same_rows(segments, peak_ops.scored_segments(counts, 100_000_000).select(segments.columns))
    wanted = {"pvalue_track": peak_ops.fisher_track(segments, study.chrom_sizes).withColumn("value", F.round("value", 8)),
              "raw_insertions": peak_ops.raw_insertion_track(counts)}
    order = {r.chr: r.chrom_order for r in study.chrom_sizes.collect()}
    for name, want in wanted.items():
        got = spark.read.parquet(paths[name])
        rounded = got.withColumn("value", F.round("value", 8)) if name == "pvalue_track" else got
        assert same_rows(rounded, want)
        rows = got.where("pseudobulk_id = 'annotation_0-SM0'").select(
            "contig", "start", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at")).collect()
        keys = [(order[r.contig], r.start) for r in sorted(rows, key=lambda r: (r.file, r.at))]
        assert keys == sorted(keys) and len(keys) > 20


def test_raw_track_in_order_where_a_run_passes_tiles(spark, study):
    flat = spark.range(1 << 20, (1 << 20) + 40_000).select(
        F.lit("p").alias("pseudobulk_id"), F.lit("t").alias("rep"), F.lit("chr2").alias("contig"),
        (F.col("id") - 20_000).alias("pos"), F.lit(1).cast("long").alias("n"))
    ends = [(1 << 20) - 20_000, (1 << 20) + 20_000]
    for counts, want in ((flat, [("p", "chr2", *ends, 1)]), (flat.where(f"pos <> {(1 << 20) + 50}"), 2)):
        got = peak_ops.raw_insertion_track_in_order(counts, study.chrom_sizes).drop("chrom_order")
        assert [tuple(r) for r in got.collect()] == want if isinstance(want, list) else got.count() == want
        assert same_rows(got, peak_ops.raw_insertion_track(counts))
