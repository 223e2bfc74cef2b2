"""Zoom levels of tracks, region reads of sorted files, quantile sketches."""

import random

from pyspark.sql import functions as F

from cellbulk.operators import report
from cellbulk.operators.tracks import zoom_levels, zoom_view
from cellbulk.plans import summary
from cellbulk.session import new_folder
from cellbulk.sources import readers, writers


def runs(seed, n=300):
    rng, at, made = random.Random(seed), 0, []
    for _ in range(n):
        at += rng.choice([0, 0, 3, 70, 1000])
        end = at + rng.choice([1, 5, 64, 129, 2000, 40_000])
        made.append((rng.choice(["c1", "c2"]), at, end, rng.random() * 9))
        at = end
    return made


def test_every_zoom_level_is_a_direct_aggregation(spark):
    made = runs(1)
    got = zoom_levels(spark.createDataFrame(made, "contig string, start long, end long, value double"),
                      finest=5, step=3, levels=4).collect()
    want = {}
    for contig, start, end, value in made:
        for level in (5, 8, 11, 14):
            for w in range(start >> level, ((end - 1) >> level) + 1):
                n = min(end, (w + 1) << level) - max(start, w << level)
                total, low, high, covered = want.get((contig, level, w), (0.0, value, value, 0))
                want[contig, level, w] = (total + n * value, min(low, value), max(high, value), covered + n)
    assert {(r.contig, r.level, r.window): (round(r.value_sum, 4), r.min_value, r.max_value, r.covered) for r in got} == {
        k: (round(v[0], 4), *v[1:]) for k, v in want.items()}
    assert len({(r.contig, r.level, r.window) for r in got}) == len(got)


def test_a_view_takes_the_coarsest_level_that_will_do(spark):
    track = spark.createDataFrame([("c1", 0, 1 << 20, 2.0), ("c1", 1 << 20, 1 << 21, 4.0)], "contig string, start long, end long, value double")
    zooms = zoom_levels(track, finest=6, step=2, levels=8)
    view = zoom_view(zooms, 0, 1 << 20, 60, F.col("contig") == "c1").collect()
    assert {r.level for r in view} == {14} and len(view) == 64 and {r.value_sum / r.covered for r in view} == {2.0}
    assert {r.level for r in zoom_view(zooms, 0, 100, 60).collect()} == {6}
    assert zoom_levels(track.limit(0)).collect() == [] and zoom_view(zooms.limit(0), 0, 10, 5).collect() == []


def test_a_region_opens_only_files_that_reach_it(spark):
    sizes = spark.createDataFrame([(f"chr{i}", 100_000, i) for i in range(1, 6)], "chr string, size long, chrom_order int")
    members = spark.range(40_000).select(
        F.concat(F.lit("pb +%"), (F.col("id") % 3).cast("string")).alias("pseudobulk_id"),
        F.concat(F.lit("chr"), (1 + F.col("id") * 31 % 5).cast("string")).alias("contig"), (F.col("id") * 7919 % 99_000).alias("frag_start"),
        (F.col("id") * 7919 % 99_000 + 1 + F.col("id") % 900).alias("frag_end"), F.md5(F.col("id").cast("string")).alias("barcode_sample"),
        (F.col("id") % 4).alias("num_reads"))
    path = new_folder(spark, "sorted")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        writers.write_sorted_fragments(members, sizes, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = spark.read.parquet(writers.manifest_of(path)).select("file").distinct().count()
    got = readers.read_region(spark, path, "chr2", 20_000, 30_000)
    want = members.where("contig = 'chr2' AND frag_start < 30000 AND frag_end > 20000").select(*got.columns)
    assert files >= 24 and 3 <= len(got.inputFiles()) <= files // 3
    assert got.count() == want.count() > 500 and got.exceptAll(want).isEmpty()
    one = readers.read_region(spark, path, "chr2", 20_000, 30_000, ["pb +%1"])
    assert len(one.inputFiles()) <= 3 and one.select("pseudobulk_id").distinct().collect() == [("pb +%1",)]
    assert readers.read_region(spark, path, "chr9", 0, 10).columns == got.columns


def test_merged_sketches_keep_their_bound(spark):
    values = spark.range(60_000).select(
        (F.col("id") % 7).alias("analysis_set_accession"), F.lit("m").alias("metric"),
        F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.pow(F.col("id") * 7919 % 60_013, F.lit(2.0))).alias("value"))
    odd = spark.createDataFrame([(9, "m", float("nan")), (9, "m", None), (9, "alone", 3.0), (9, "empty", None)],
                                "analysis_set_accession long, metric string, value double")
    path = new_folder(spark, "sketches")
    for accession in range(7):
        report.metric_sketches(values.where(F.col("analysis_set_accession") == accession)).write.mode("append").parquet(path)
    report.metric_sketches(odd).write.mode("append").parquet(path)
    found = report.sketched_quantiles(spark.read.parquet(path), [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0])
    rows = {(r.metric, r.quantile): r for r in report.rank_errors(found, values.unionAll(odd)).collect()}
    assert {m for m, _ in rows} == {"m", "alone"} and rows["m", 0.5].n == 60_000
    assert all(r.error < 0.01 for r in rows.values())
    assert rows["m", 0.0].value == values.agg(F.min("value")).first()[0] and rows["m", 0.25].value == 1.0
    assert rows["m", 1.0].value == values.agg(F.max("value")).first()[0] and rows["alone", 0.5].value == 3.0


def test_reports_of_tables_with_one_kind_of_column(spark):
    numbers = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "cell string, x double")
    stats = summary.report_statistics(numbers, "cell")
    assert stats["categories"].collect() == [] and stats["boxes"].first().n == 2
    texts = spark.createDataFrame([("a", "u"), ("b", "v")], "cell string, x string")
    stats = summary.report_statistics(texts, "cell")
    assert stats["categories"].count() == 2 and stats["boxes"].collect() == [] and stats["outliers"].collect() == []


def test_summary_plan_gets_stored_tables(spark, monkeypatch):
    from cellbulk import catalog
    given = []

    def stop(spark, assignments, atac_qc, rna_qc, expression, frip, output):
        given.extend([atac_qc, rna_qc, frip])
        raise InterruptedError

    monkeypatch.setattr(catalog.summary_plan, "summarize_pseudobulks", stop)
    try:
        catalog.QUERIES["plan_summary"](spark, "/root/testdata/sf0.001")
    except InterruptedError:
        pass
    assert len(given) == 3 and not any("lineitem" in f for frame in given for f in frame.inputFiles())
