"""Every operator as a query over the driver's tables."""

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk import checks, schemas
from cellbulk.adapters import GENOME_SIZE, Tables
from cellbulk.functions import stats as S
from cellbulk.operators import annotation, atac, inventory, peaks, qc, report, rna, sparse
from cellbulk.operators.intervals import clip_to_contigs, genome_sorted
from cellbulk.operators.tracks import coverage, overlay
from cellbulk.plans import atac as atac_plan
from cellbulk.plans import inventory as inventory_plan
from cellbulk.plans import peaks as peak_plan
from cellbulk.plans import preparation as preparation_plan
from cellbulk.plans import rna as rna_plan
from cellbulk.plans import summary as summary_plan
from cellbulk.session import new_folder, saved
from cellbulk.sources import block_gzip, by_name, checksums, readers, writers
from cellbulk.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PB_CONTIG = ["pseudobulk_id", "contig"]
TOP_N = 25
METRICS = ["num_frags", "pct_duplicated_reads", "nucleosomal_signal", "tss_enrichment"]


class Study(Tables):
    """The adapter tables with the frames most queries start from."""

    @cached_property
    def cells(self) -> DataFrame:
        return annotation.with_pseudobulk_ids(checks.checked_metadata(self.metadata))

    @cached_property
    def assignments(self) -> DataFrame:
        """Written once: it is looked up often, and its size decides those joins."""
        return saved(annotation.barcode_assignments(self.cells), "assignments", plain=True)

    @cached_property
    def sites(self) -> DataFrame:
        return annotation.tss_sites(self.tss)

    @cached_property
    def bands(self) -> DataFrame:
        return saved(atac.tss_band_weights(self.sites), "tss-bands", plain=True)

    @cached_property
    def members(self) -> DataFrame:
        return atac.pseudobulk_fragments(self.fragments, self.assignments, self.chrom_sizes)

    @cached_property
    def insertion_counts(self) -> DataFrame:
        return atac.insertion_counts(self.members)

    @cached_property
    def segments(self) -> DataFrame:
        return peaks.scored_segments(self.insertion_counts, GENOME_SIZE)

    @cached_property
    def atac_qc(self) -> DataFrame:
        counters = atac.barcode_counters(self.fragments, self.chrom_sizes, self.tss, bands=self.bands)
        return atac.barcode_qc(counters, self.assignments)

    @cached_property
    def rna_qc(self) -> DataFrame:
        return rna.rna_cell_qc(self.counts, self.gene_info, self.assignments)

    @cached_property
    def expression(self) -> DataFrame:
        return rna.pseudobulk_expression(self.counts, self.gene_universe, self.gene_info,
                                         self.assignments)

    @cached_property
    def final_peaks(self) -> DataFrame:
        """Saved like the pipeline's peak table, so joins see its measured size."""
        kept = peaks.reproducible_peaks(self.peaks_by_rep)
        return saved(peaks.blacklist_filter(kept, self.blacklist), "peaks")

    @cached_property
    def frip(self) -> DataFrame:
        """From members written once: finding them takes a join of all fragments."""
        found = self.members.select(*atac.BARCODE, "contig", "frag_start", "frag_end", "pseudobulk_id")
        return qc.frip_per_cell(saved(found, "members"), self.final_peaks)

    def store_counts(self) -> None:
        """Write the counts once, for queries that read them, or what derives from them, repeatedly."""
        self._made["counts"] = saved(self.counts, "counts")

    def folder(self, name: str) -> str:
        return new_folder(self.spark, name)


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at a fixed number of digits: two engines add in different orders."""
    return frame.select([
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if f.dataType.typeName() == "double" else F.col(f"`{f.name}`")
        for f in frame.schema.fields])


def query(fn: Callable[[Study], DataFrame]) -> Callable[[Study], DataFrame]:
    """Register under the function's name; a trailing underscore frees a taken name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(fn(Study(spark, sf_dir)))

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


# --- scans and sinks -----------------------------------------------------------


def fragment_files(s: Study) -> str:
    """A folder of block gzip fragment text whose file names start with the accession."""
    folder = s.folder("fragments")
    by = "analysis_set_accession"
    block_gzip.write_fragment_blocks(s.fragments.hint("rebalance", F.col(by)).sortWithinPartitions(by), folder)
    return f"{folder}/*.tsv.gz"


@query
def scan_fragments(s: Study) -> DataFrame:
    return readers.scan_fragments(s.spark, fragment_files(s))


@query
def scan_fragment_blocks(s: Study) -> DataFrame:
    """The same files, of which every task inflates a range of blocks."""
    return block_gzip.scan_fragment_blocks(s.spark, fragment_files(s), split_bytes=1 << 18)


@query
def scan_table(s: Study) -> DataFrame:
    path = s.folder("tss") + ".tsv.gz"
    s.tss.write.csv(path, sep="\t", header=True, compression="gzip")
    return readers.scan_table(s.spark, path, schema=schemas.TSS, required=["chro", "TSS"])


@query
def scan_qc(s: Study) -> DataFrame:
    path = s.folder("accession-qc")
    s.combined_qc().write.csv(path, sep="\t", header=True, compression="gzip")
    return readers.scan_qc(s.spark, path, schemas.ACCESSION_QC, index_col="barcode_sample",
                           exclude=["analysis_set_accession,pseudobulk_id", "subsample"])


def _mixed_headers(s: Study) -> str:
    """The accession table in one file format per accession: columns permuted, some left out."""
    path, whole = s.folder("mixed-headers"), saved(s.combined_qc(), "accession-qc")
    names = whole.columns
    layouts = {"ACC0": names, "ACC1": names[::-1], "ACC2": [c for c in names if not c.startswith("pct_")],
               "ACC3": [*names[8:], *names[:6]]}
    for accession, columns in layouts.items():
        whole.where(F.col("analysis_set_accession") == accession).select(*columns).write.csv(
            f"{path}/{accession}", sep="\t", header=True, compression="gzip")
    return path


@query
def scan_by_name(s: Study) -> DataFrame:
    return by_name.scan_by_name(s.spark, _mixed_headers(s), schemas.ACCESSION_QC, sep="\t")


@query
def scan_relaxed(s: Study) -> DataFrame:
    """The same files without a schema; types follow from the values."""
    return by_name.with_found_types(by_name.scan_by_name(s.spark, _mixed_headers(s), sep="\t"))


@query
def load_metadata(s: Study) -> DataFrame:
    path = s.folder("metadata") + ".tsv"
    s.metadata.write.csv(path, sep="\t", header=True)
    table = readers.load_metadata(s.spark, path)
    return annotation.with_pseudobulk_ids(checks.checked_metadata(table))


@query
def metadata_violations(s: Study) -> DataFrame:
    """The accession left out, most barcodes repeat: the rule must find them all."""
    return checks.metadata_violations(s.metadata.withColumn(
        "analysis_set_accession", F.lit("ACC")))


@query
def load_tss(s: Study) -> DataFrame:
    return s.sites


@query
def load_chrom_sizes(s: Study) -> DataFrame:
    """Contig extents of the fragments, written in name order and scanned as a contig list."""
    path = s.folder("sizes")
    extents = s.fragments.groupBy("contig").agg(F.max("frag_end").alias("size"))
    extents.orderBy("contig").coalesce(1).write.csv(path, sep="\t")
    return readers.scan_chrom_sizes(s.spark, path)


@query
def load_atac_qc(s: Study) -> DataFrame:
    path = s.folder("atac-qc")
    writers.write_partitioned(s.atac_qc, path, ["analysis_set_accession"])
    return readers.load_atac_qc(
        s.spark, path, where=F.col("pseudobulk_id").isNotNull(),
        columns=["analysis_set_accession", "barcode_sample", "pseudobulk_id", "num_frags",
                 "tss_enrichment"])


@query
def scan_counts(s: Study) -> DataFrame:
    path = s.folder("counts")
    s.counts.write.parquet(path)
    return readers.scan_counts(s.spark, [path])


def _gtf(s: Study) -> DataFrame:
    path = s.folder("gtf")
    s.gtf_lines.write.text(path)
    return annotation.gtf_records(readers.scan_gtf(s.spark, path))


@query
def gtf_scan(s: Study) -> DataFrame:
    return _gtf(s).drop("attributes")


@query
def gtf_genes(s: Study) -> DataFrame:
    return annotation.gtf_genes(_gtf(s))


@query
def gtf_tss(s: Study) -> DataFrame:
    return annotation.gtf_tss(_gtf(s))


@query
def split_fragments(s: Study) -> DataFrame:
    path = s.folder("split")
    writers.write_split_fragments(s.members, path)
    return s.spark.read.parquet(path).groupBy(
        "stream", "pseudobulk_id", "analysis_set_accession").agg(
        F.count("*").alias("n"), F.sum("start").alias("sum_start"), F.sum("end").alias("sum_end"),
        F.sum("num_reads").alias("sum_reads"))


@query
def sort_fragments(s: Study) -> DataFrame:
    path = s.folder("sorted")
    writers.write_sorted_fragments(s.members, s.chrom_sizes, path)
    return s.spark.read.schema(schemas.SORTED_FRAGMENT).csv(path, sep="\t")


@query
def sorted_region(s: Study) -> DataFrame:
    """Fragments of part of a contig, from the files that reach into it."""
    path = s.folder("sorted")
    writers.write_sorted_fragments(s.members, s.chrom_sizes, path)
    return readers.read_region(s.spark, path, "chr3", 4_000_000, 9_000_000)


@query
def accession_qc_sink(s: Study) -> DataFrame:
    path = s.folder("accession-qc")
    writers.write_tsv(s.combined_qc(), path, ["analysis_set_accession"])
    return s.spark.read.schema(schemas.ACCESSION_QC).csv(path, sep="\t", header=True)


@query
def expression_sink(s: Study) -> DataFrame:
    path = s.folder("expression")
    writers.write_tsv(s.expression, path, ["pseudobulk_id"])
    return s.spark.read.schema(s.expression.schema).csv(path, sep="\t", header=True)


@query
def counts_sink(s: Study) -> DataFrame:
    path = s.folder("pseudobulk-counts")
    writers.write_partitioned(rna.rna_subset(s.counts, s.assignments), path, ["pseudobulk_id"])
    return s.spark.read.parquet(path)


@query
def bedgraph_sink(s: Study) -> DataFrame:
    path = s.folder("bedgraph")
    writers.write_bedgraph(peaks.raw_insertion_track(s.insertion_counts), s.chrom_sizes, path)
    return s.spark.read.parquet(path)


@query
def text_md5(s: Study) -> DataFrame:
    """MD5 of every document's text."""
    docs = s.spark.read.parquet(f"{s.sf_dir}/documents.parquet")
    return docs.select("doc_id", checksums.text_md5(F.col("text")).alias("md5"))


@query
def file_md5(s: Study) -> DataFrame:
    return checksums.file_md5(s.spark, s.sf_dir, "*.parquet").drop("path")


# --- fragments ------------------------------------------------------------------


@query
def shift_fragments(s: Study) -> DataFrame:
    return atac.shift_fragments(s.fragments)


@query
def insertions(s: Study) -> DataFrame:
    return atac.insertions(s.fragments)


@query
def size_class(s: Study) -> DataFrame:
    return atac.with_size_class(s.fragments).groupBy("analysis_set_accession", "size_class").agg(
        F.count("*").alias("n"))


@query
def contig_gate(s: Study) -> DataFrame:
    return atac.contig_gate(s.fragments, s.chrom_sizes)


@query
def cell_name_mapping(s: Study) -> DataFrame:
    return annotation.cell_name_mapping(s.cells)


@query
def assign_pseudobulk(s: Study) -> DataFrame:
    return atac.assign_pseudobulk(s.fragments, s.assignments)


@query
def pseudoreps(s: Study) -> DataFrame:
    return s.members


@query
def barcode_qc(s: Study) -> DataFrame:
    return s.atac_qc


@query
def tss_pairs(s: Study) -> DataFrame:
    points = atac.insertions(s.fragments).select(*atac.BARCODE, "contig", "pos")
    return atac.tss_pairs(points, s.sites)


@query
def tss_profile(s: Study) -> DataFrame:
    return atac.tss_profile(atac.insertions(s.fragments), s.sites)


@query
def tss_profile_pseudobulk(s: Study) -> DataFrame:
    return atac.tss_profile_of_pseudobulks(atac.insertions(s.fragments), s.sites, s.assignments)


@query
def tss_rows(s: Study) -> DataFrame:
    """Profile rows of the barcodes with at least five fragments, from stored tables."""
    profile, table = s.folder("tss-profile"), s.folder("atac-qc")
    atac.tss_profile_lists(atac.insertions(s.fragments), s.sites).write.parquet(profile)
    s.atac_qc.write.parquet(table)
    return readers.load_atac_qc(s.spark, table, F.col("num_frags") >= 5, need_tss=profile)[1]


@query
def assign_repeated(s: Study) -> DataFrame:
    """Barcodes listed twice, the second time under another cell name: the last row counts."""
    first = s.metadata.withColumn("_sequence", F.lit(1))
    last = s.metadata.withColumns({"_sequence": F.lit(2), "cell_name": F.concat("cell_name", F.lit(" again"))})
    named = annotation.with_pseudobulk_ids(first.unionByName(last))
    return annotation.barcode_assignments(named, "_sequence").select(*atac.BARCODE, "cell_name")


@query
def scan_inputs(s: Study) -> DataFrame:
    """Count tables found by a pattern and by a listing file; both name the same rows."""
    folder = s.folder("inputs")
    for i in range(2):
        s.counts.where(F.abs(F.hash("barcode_sample")) % 2 == i).write.parquet(f"{folder}/set{i}/counts")
    listing = s.folder("listing")
    s.spark.sql("SELECT explode(array('set0', 'set1')) AS name").select(
        F.concat(F.lit(f"{folder}/"), "name", F.lit("/counts"))).coalesce(1).write.text(listing)
    found = readers.scan_inputs(s.spark, f"{folder}/*/counts")
    return found.intersectAll(readers.scan_inputs(s.spark, listing, listing=True))


# --- whole plans, written and read back ---------------------------------------------


@query
def plan_split_fragments(s: Study) -> DataFrame:
    paths = atac_plan.split_fragments(s.spark, s.fragments, s.metadata, s.chrom_sizes, s.tss, s.folder("plan"))
    return s.spark.read.parquet(paths["atac_qc"])


@query
def plan_rna(s: Study) -> DataFrame:
    s.store_counts()
    paths = rna_plan.pseudobulk_rna(s.spark, s.counts, s.gene_universe, s.gene_info, s.metadata, s.folder("plan"))
    return s.spark.read.parquet(paths["rna_qc"])


@query
def plan_call_peaks(s: Study) -> DataFrame:
    members = saved(s.members, "members")
    paths = peak_plan.call_peaks(s.spark, members, s.chrom_sizes, s.blacklist, s.folder("plan"),
                                 genome_size=GENOME_SIZE)
    return s.spark.read.parquet(paths["peaks"]).drop("name")


@query
def plan_summary(s: Study) -> DataFrame:
    # The plan reads each of them several times.
    s.store_counts()
    rna_qc, atac_qc = saved(s.rna_qc, "rna-qc"), saved(s.atac_qc, "atac-qc")
    frip, expression = saved(s.frip, "frip"), s.expression
    whole = qc.pseudobulk_summary(
        s.assignments, qc.per_cell_qc(rna_qc, atac_qc, frip, s.assignments), atac_qc, expression, frip)
    paths = summary_plan.summarize_pseudobulks(
        s.spark, s.assignments, atac_qc, rna_qc, expression, frip, s.folder("plan"))
    return s.spark.read.csv(paths["pseudobulk_qc"], sep="\t", header=True, schema=whole.schema)


@query
def plan_combine(s: Study) -> DataFrame:
    path = summary_plan.combine_accessions(s.rna_qc, s.atac_qc, s.folder("plan"))
    return s.spark.read.csv(path, sep="\t", header=True, schema=schemas.ACCESSION_QC).select(
        *schemas.ACCESSION_QC.names)


@query
def plan_report_boxes(s: Study) -> DataFrame:
    return _report(s)["boxes"]


@query
def plan_report_outliers(s: Study) -> DataFrame:
    return _report(s)["outliers"].withColumnRenamed("_index", "cell")


@query
def plan_report_categories(s: Study) -> DataFrame:
    """Shares of the columns of the accession table that are no numbers."""
    return summary_plan.report_statistics(s.combined_qc(), "barcode_sample", ["analysis_set_accession"])["categories"]


def _report(s: Study) -> dict[str, DataFrame]:
    cells = rounded(s.atac_qc.select(F.concat_ws("/", *atac.BARCODE).alias("cell"), "pseudobulk_id", *METRICS))
    return summary_plan.report_statistics(cells, "cell", ["pseudobulk_id"])


def _prepared(s: Study) -> dict[str, str]:
    lines = s.folder("gtf")
    s.gtf_lines.write.text(lines)
    return preparation_plan.prepare_annotation(s.spark, lines, s.folder("reference"))


@query
def plan_gene_info(s: Study) -> DataFrame:
    return readers.scan_table(s.spark, _prepared(s)["gene_info"], schema=schemas.GENE_INFO)


@query
def plan_tss(s: Study) -> DataFrame:
    return readers.scan_table(s.spark, _prepared(s)["tss"], schema=schemas.TSS)


@query
def plan_inventory(s: Study) -> DataFrame:
    """States of the files expected of every pseudobulk in a folder that holds other files."""
    names = annotation.cell_name_mapping(s.cells).select("pseudobulk_id")
    tables = inventory_plan.output_inventory(s.spark, s.sf_dir, names, _records(s))
    states = tables["expected"].join(names.withColumnRenamed("pseudobulk_id", "folder"), "folder")
    alone = tables["pseudobulks"].withColumnRenamed("pseudobulk_id", "folder")
    return states.join(alone, "folder").select("folder", "pattern", "content_type", "state", "status")


@query
def inventory_folders(s: Study) -> DataFrame:
    """Expected files of listed folders and of folders that have none."""
    empty = s.supplier.select(F.concat(F.lit("empty_"), F.col("s_suppkey").cast("string")).alias("folder"))
    return inventory.expected_files(s.file_listing, folders=empty)


@query
def gtf_genes_repeated(s: Study) -> DataFrame:
    """Gene rows that come again under another name: the last one in the sequence counts."""
    again = s.gtf_lines.select(F.replace("value", F.lit("GENE"), F.lit("LATE")).alias("value"), F.lit(2).alias("_seq"))
    lines = again.unionByName(s.gtf_lines.withColumn("_seq", F.lit(1)))
    return annotation.gtf_genes(annotation.gtf_records(lines, "_seq"), "_seq")


@query
def tss_enrichment(s: Study) -> DataFrame:
    return atac.tss_enrichment(atac.insertions(s.fragments), s.sites)


@query
def stream_barcode_qc(s: Study) -> DataFrame:
    partials, state = s.folder("partials"), s.folder("stream-state")
    source = fragment_files(s).rsplit("/", 1)[0]
    stream = ingest.fragment_stream(s.spark, source)
    ingest.start_counting(stream, s.chrom_sizes, s.tss, partials, state).awaitTermination()
    return atac.barcode_qc(ingest.counters_so_far(s.spark, partials), s.assignments)


@query
def accession_list(s: Study) -> DataFrame:
    return s.metadata.select(F.trim("analysis_set_accession").alias("analysis_set_accession")
                             ).distinct().orderBy("analysis_set_accession")


@query
def sort_intervals(s: Study) -> DataFrame:
    return genome_sorted(s.fragments, "contig", "frag_start", "frag_end", s.chrom_sizes,
                         ["barcode_sample", "num_reads"])


@query
def clip_intervals(s: Study) -> DataFrame:
    return clip_to_contigs(s.fragments, "contig", "frag_start", "frag_end", s.chrom_sizes)


@query
def trim_intervals(s: Study) -> DataFrame:
    return clip_to_contigs(s.fragments, "contig", "frag_start", "frag_end", s.chrom_sizes, "trim")


@query
def coverage_(s: Study) -> DataFrame:
    return coverage(s.fragments, "frag_start", "frag_end")


# --- RNA ------------------------------------------------------------------------


@query
def rna_cell_qc(s: Study) -> DataFrame:
    return s.rna_qc


def _sparse(s: Study) -> tuple[DataFrame, DataFrame]:
    """The stored count matrix, one row per cell, and its gene dictionary."""
    genes = s.gene_universe.unionByName(s.counts.select("analysis_set_accession", "gene_id"))
    dictionary = saved(sparse.gene_dictionary(genes, s.gene_info), "gene-dictionary")
    path = s.folder("matrix")
    writers.write_partitioned(sparse.to_sparse(s.counts, dictionary), path, ["analysis_set_accession"])
    return s.spark.read.parquet(path), dictionary


@query
def sparse_counts(s: Study) -> DataFrame:
    """The long form of the stored matrix."""
    return sparse.from_sparse(*_sparse(s))


@query
def sparse_cell_qc(s: Study) -> DataFrame:
    return sparse.sparse_cell_qc(*_sparse(s), s.assignments)


@query
def rna_gene_qc(s: Study) -> DataFrame:
    return rna.rna_gene_qc(s.counts, s.counts.select(*atac.BARCODE).distinct())


@query
def rna_subset(s: Study) -> DataFrame:
    return rna.rna_subset(s.counts, s.assignments)


@query
def annotate_genes(s: Study) -> DataFrame:
    return rna.annotate_genes(s.gene_universe, s.gene_info)


@query
def shared_genes(s: Study) -> DataFrame:
    return rna.shared_genes(s.gene_universe, s.assignments)


@query
def pseudobulk_expression(s: Study) -> DataFrame:
    return s.expression


# --- peaks ------------------------------------------------------------------------


@query
def treatment_pileup(s: Study) -> DataFrame:
    return peaks.treatment_pileup(s.insertion_counts)


@query
def control_lambda(s: Study) -> DataFrame:
    return peaks.control_lambda(s.insertion_counts, GENOME_SIZE)


@query
def overlay_tracks(s: Study) -> DataFrame:
    """Raw pile-ups of both replicates and the pooled set, where all three have one."""
    track = peaks.treatment_pileup(s.insertion_counts, per_million=False)
    return overlay(track, "rep", ["1", "2", "t"], PB_CONTIG).withColumnsRenamed(
        {"1": "rep_1", "2": "rep_2", "t": "rep_t"})


@query
def poisson_score(s: Study) -> DataFrame:
    return s.segments


@query
def poisson_score_native(s: Study) -> DataFrame:
    """Scores by expressions alone, on the distinct (pile-up, background) pairs."""
    pairs = s.segments.select("pileup", "lambda").distinct()
    return pairs.withColumn("score", S.poisson_score(F.col("pileup"), F.col("lambda")))


@query
def poisson_score_deep(s: Study) -> DataFrame:
    """Scores of every customer's pair, with backgrounds from 0.01 to a million."""
    number = F.col("c_custkey").cast("long")
    lam = F.pow(F.lit(10.0), (number * 7919 % 801) / 100.0 - 2.0)
    pairs = s.spark.read.parquet(f"{s.sf_dir}/customer.parquet").select(
        "c_custkey", lam.alias("background"),
        F.floor(lam * (0.9 + (number % 21) / 100.0)).cast("long").alias("pileup"))
    return pairs.withColumn(
        "score", S.poisson_score_arrow(F.col("pileup").cast("double"), F.col("background")))


@query
def fisher_combine(s: Study) -> DataFrame:
    counts = saved(s.insertion_counts, "insertion-counts")
    return peaks.fisher_track_of_counts(counts, GENOME_SIZE, s.chrom_sizes)


@query
def call_regions(s: Study) -> DataFrame:
    return peaks.call_regions(s.segments)


@query
def summits(s: Study) -> DataFrame:
    return peaks.summits(s.segments)


@query
def narrow_peaks(s: Study) -> DataFrame:
    return peaks.narrow_peaks(peaks.summits(s.segments))


@query
def raw_insertions(s: Study) -> DataFrame:
    return peaks.raw_insertion_track(s.insertion_counts)


@query
def track_zooms(s: Study) -> DataFrame:
    """The tag pile-up of every set in windows of 64 bases to 16 million."""
    return peaks.pileup_zooms(s.insertion_counts)


@query
def peak_coverage(s: Study) -> DataFrame:
    return peaks.peak_coverage_track(s.peaks_by_rep)


@query
def top_peaks(s: Study) -> DataFrame:
    return peaks.top_peaks(s.peaks_by_rep, TOP_N)


@query
def reproducible_peaks(s: Study) -> DataFrame:
    return peaks.reproducible_peaks(s.peaks_by_rep)


@query
def blacklist_filter(s: Study) -> DataFrame:
    return peaks.blacklist_filter(s.peaks_by_rep, s.blacklist)


@query
def fragments_in_peaks(s: Study) -> DataFrame:
    return peaks.fragments_in_peaks(s.members, s.final_peaks)


@query
def frip_per_cell(s: Study) -> DataFrame:
    return s.frip


@query
def called_peaks(s: Study) -> DataFrame:
    """From insertions to the reproducible, filtered peak set."""
    called = peaks.narrow_peaks(peaks.summits(s.segments)).drop("name")
    top = peaks.top_peaks(called)
    return peaks.blacklist_filter(peaks.reproducible_peaks(saved(top, "top-peaks")), s.blacklist)


# --- QC tables ----------------------------------------------------------------------


def _combined(self: Study) -> DataFrame:
    return qc.accession_qc(self.rna_qc, self.atac_qc).select(*schemas.ACCESSION_QC.names)


Study.combined_qc = _combined


@query
def atac_with_frip(s: Study) -> DataFrame:
    return qc.atac_with_frip(s.atac_qc, s.frip)


@query
def combined_cell_qc(s: Study) -> DataFrame:
    return s.combined_qc()


@query
def per_cell_qc(s: Study) -> DataFrame:
    return qc.per_cell_qc(s.rna_qc, s.atac_qc, s.frip, s.assignments)


@query
def pseudobulk_summary(s: Study) -> DataFrame:
    s.store_counts()
    atac_qc = saved(s.atac_qc, "atac-qc")
    frip = saved(s.frip, "frip")
    cells = qc.per_cell_qc(s.rna_qc, atac_qc, frip, s.assignments)
    return qc.pseudobulk_summary(s.assignments, cells, atac_qc, s.expression, frip).orderBy(
        "directory_name")


@query
def cell_set_check(s: Study) -> DataFrame:
    return qc.cell_set_check(s.rna_qc, s.atac_qc)


@query
def union_relaxed(s: Study) -> DataFrame:
    """Accession and per-cell tables of differing columns in one frame of doubles."""
    cell = s.rna_qc.drop("annotated")
    fragment = s.atac_qc.select(
        *atac.BARCODE, "pseudobulk_id", F.col("num_frags").cast("double").alias("num_frags"),
        F.lit(None).cast("double").alias("rna_read_count"))
    return report.union_relaxed(cell, fragment)


# --- report ---------------------------------------------------------------------------


def _long(s: Study) -> DataFrame:
    return report.to_long(s.atac_qc, atac.BARCODE, METRICS)


@query
def box_stats(s: Study) -> DataFrame:
    return report.box_stats(rounded(_long(s)))


@query
def sketched_quantiles(s: Study) -> DataFrame:
    """Quantiles from sketches added accession by accession, and whether their rank errors
    stay below one per cent of the values."""
    folder, long = s.folder("sketches"), saved(rounded(_long(s)), "metrics")
    for accession in ("ACC0", "ACC1", "ACC2", "ACC3"):
        report.metric_sketches(long.where(F.col("analysis_set_accession") == accession)).write.mode("append").parquet(folder)
    found = report.sketched_quantiles(s.spark.read.parquet(folder), (0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0))
    checked = report.rank_errors(saved(found, "quantiles"), long)
    return checked.select("metric", "n", "quantile", (F.col("error") < 0.01).alias("within"))


@query
def outliers(s: Study) -> DataFrame:
    long = rounded(_long(s)).withColumn("cell", F.concat_ws("/", *atac.BARCODE))
    return report.outliers(long.drop(*atac.BARCODE), "cell")


@query
def category_pct(s: Study) -> DataFrame:
    return report.category_pct(s.combined_qc(), ["annotated", "found_in_rna", "found_in_atac",
                                                 "pseudobulk_id"])


@query
def input_presence(s: Study) -> DataFrame:
    """Barcodes take the part of accessions, which all have both inputs here."""

    def ids(frame: DataFrame) -> DataFrame:
        return frame.select(F.col("barcode_sample").alias("accession")).distinct()

    return report.input_presence(ids(s.metadata), ids(s.fragments), ids(s.counts))


# --- inventory --------------------------------------------------------------------------


def _records(s: Study) -> DataFrame:
    return inventory.parse_json(s.file_set_json, schemas.FILE_SET_RECORD)


@query
def lineage(s: Study) -> DataFrame:
    return inventory.lineage(_records(s))


@query
def route_files(s: Study) -> DataFrame:
    return inventory.route_files(_records(s))


@query
def derived_from(s: Study) -> DataFrame:
    return inventory.derived_from(_records(s), "fragments")


@query
def alias_lists(s: Study) -> DataFrame:
    return inventory.joined_aliases(inventory.derived_from(_records(s), "fragments"), "accession")


@query
def controlled_access(s: Study) -> DataFrame:
    records = _records(s)
    return inventory.controlled_access(records, inventory.lineage(records))


@query
def nested_lookup(s: Study) -> DataFrame:
    steps = inventory.parse_json(s.step_json, schemas.STEP_RECORD)
    return inventory.nested_lookup(steps, "tool-v2")


@query
def file_classes(s: Study) -> DataFrame:
    return inventory.classify_files(s.file_listing)


@query
def inventory_(s: Study) -> DataFrame:
    return inventory.expected_files(s.file_listing)


@query
def id_reconcile(s: Study) -> DataFrame:
    folders = s.fragments.select("barcode_sample")
    return inventory.id_reconcile(folders, s.metadata.select("barcode_sample"), "barcode_sample")
