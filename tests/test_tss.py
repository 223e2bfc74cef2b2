"""Slot profiles against hand-counted vectors."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellbulk.functions.profiles import CONTIG, list_slots
from cellbulk.operators import atac

# Expected slots, position, sites and strands, half window 3.
VECTORS = [
    ([0, 0, 1, 1, 1, 1, 0], 100, [5, 98, 99, 100, 101, 500], [1, 1, 1, 1, 1, -1]),
    ([0, 0, 0, 1, 2, 1, 0], 100, [5, 98, 99, 100, 101, 500], [1, 1, 1, 1, -1, -1]),
    ([0, 0, 0, 1, 3, 1, 0], 100, [5, 98, 99, 100, 101, 101, 500], [1, 1, 1, 1, -1, -1, -1]),
    ([0, 0, 1, 1, 2, 1, 0], 100, [5, 98, 99, 100, 101, 101, 500], [1, 1, 1, 1, -1, 1, -1]),
    ([0] * 7, -100, [5, 98, 99, 100, 101, 101, 500], [1, 1, 1, 1, -1, 1, -1]),
    ([0] * 7, 999, [5, 98, 99, 100, 101, 101, 500], [1, 1, 1, 1, -1, 1, -1]),
]


@pytest.mark.parametrize("expected, position, sites, strands", VECTORS)
@pytest.mark.parametrize("salt", [1, 4])
def test_slots(spark, expected, position, sites, strands, salt):
    points = spark.createDataFrame([("A", "B", "chr1", position)],
                                   "analysis_set_accession string, barcode_sample string, "
                                   "contig string, pos long")
    frame = spark.createDataFrame([("chr1", t, s) for t, s in zip(sites, strands)],
                                  "contig string, tss0 long, strand long")
    pairs = atac.tss_pairs(points, frame, half_window=3, salt=salt)
    counts = {r.slot: r["count"] for r in pairs.groupBy("slot").count().collect()}
    assert [counts.get(i, 0) for i in range(7)] == expected


def test_band_weights_equal_profile_enrichment(spark):
    """Counting bands per base gives what the full slot profile gives."""
    import random
    rng = random.Random(3)
    sites = spark.createDataFrame(
        [("chr1", rng.randrange(0, 30_000), rng.choice([-1, 1])) for _ in range(60)],
        "contig string, tss0 long, strand long")
    points = spark.createDataFrame(
        [("A", f"B{i % 5}", "chr1", rng.randrange(0, 30_000)) for i in range(3000)],
        "analysis_set_accession string, barcode_sample string, contig string, pos long")
    profile = atac.tss_profile(points, sites)
    want = {r.barcode_sample: (r.center, r.flank)
            for r in atac.enrichment_from_profile(profile).collect()}
    bands = atac.tss_band_weights(sites)
    met = atac.points_in_intervals(points, "pos", bands, "start", "end", ["contig"], width=256)
    got = {r.barcode_sample: (r.c, r.f) for r in met.groupBy("barcode_sample").agg(
        F.sum("center").alias("c"), F.sum("flank").alias("f")).collect()}
    assert got == want


@pytest.mark.parametrize("heavy_rows", [10, 10_000])
def test_profile_equals_pairs_and_shuffles_no_row_per_slot(spark, heavy_rows):
    """Whether or not some barcode is heavy; a third of the sites lies twice."""
    sites = spark.range(900).select(F.lit("chr1").alias("contig"), (F.col("id") % 600 * 17 - 300).alias("tss0"),
                                    F.when(F.col("id") % 2 == 0, 1).otherwise(-1).cast("long").alias("strand"))
    points = spark.range(60).select(F.lit("A").alias("analysis_set_accession"), F.lit("chr1").alias("contig"),
                                    F.concat(F.lit("B"), F.floor(F.sqrt("id")).cast("string")).alias("barcode_sample"),
                                    (F.col("id") * 211 - 500).alias("pos"))
    pairs = atac.tss_pairs(points, sites)
    want = pairs.groupBy(*atac.BARCODE, "slot").agg(F.count("*").alias("n"))
    got = atac.tss_profile(points, sites, heavy_rows=heavy_rows)
    assert got.schema == want.schema and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert atac.tss_slots(points, sites).count() <= 60 < pairs.count()
    lists = atac.tss_profile_lists(points, sites, heavy_rows=heavy_rows)
    assert lists.count() == want.select("barcode_sample").distinct().count()
    assert lists.where("array_sort(slots) != slots OR size(slots) != size(n)").isEmpty()
    plan = got._jdf.queryExecution().optimizedPlan().toString()  # in long form only above all exchanges
    assert plan.index("posexplode") < plan.index("RepartitionByExpression")
    known = spark.createDataFrame([("A", f"B{i}", f"p{i % 2}") for i in range(6)], [*atac.BARCODE, "pseudobulk_id"])
    summed = atac.tss_profile_of_pseudobulks(points, sites, known)
    kept = atac.tss_profile_pseudobulk(want, known)
    assert summed.exceptAll(kept).isEmpty() and kept.exceptAll(summed).isEmpty()


def test_points_meet_sites_after_their_shuffle(spark):
    """Slots are found behind the exchange, in Arrow batches, and neither joined nor collected."""
    sites = spark.createDataFrame([("chr1", 5000, 1), ("chr2", 100, -1), ("chrM", 7, 1)], "contig string, tss0 long, strand long")
    points = spark.range(30_000).select(F.lit("A").alias("analysis_set_accession"), (F.col("id") % 7).cast("string").alias("barcode_sample"),
                                        F.concat(F.lit("chr"), (1 + F.col("id") % 3).cast("string")).alias("contig"), F.col("id").alias("pos"))
    lists = atac.tss_profile_lists(points, sites)
    plan = lists._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "collect_list" not in plan and "_bin" not in plan
    want = atac.tss_pairs(points, sites).groupBy(*atac.BARCODE, "slot").agg(F.count("*").alias("n"))
    got = atac.slot_rows(lists)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and got.count() > 1000
    known = points.select(*atac.BARCODE).distinct().withColumn("pseudobulk_id", F.lit("p"))
    assert "_bin" not in atac.tss_profile_of_pseudobulks(points, sites, known)._jdf.queryExecution().optimizedPlan().toString()
    sums, direct = (f.orderBy("pseudobulk_id", "slot").collect() for f in (
        atac.tss_profile_of_lists(lists, known), atac.tss_profile_of_pseudobulks(points, sites, known)))
    assert sums == direct and len(sums) > 2000
    none = sites.where("contig = 'chrM'")
    assert atac.tss_profile_lists(points, none).count() == atac.tss_profile_of_pseudobulks(points, none, known).count() == 0


def test_tables_of_sites_too_large_to_broadcast(spark, monkeypatch):
    sites = spark.createDataFrame([("chr1", 17 * i, 1 - 2 * (i % 2)) for i in range(300)], "contig string, tss0 long, strand long")
    points = spark.range(400).select(F.lit("A").alias("analysis_set_accession"), (F.col("id") % 7).cast("string").alias("barcode_sample"),
                                     F.lit("chr1").alias("contig"), (F.col("id") * 11).alias("pos"))
    want = atac.tss_profile(points, sites).collect()
    monkeypatch.setattr(atac, "broadcast_limit", lambda frame: -1)
    assert "_sites" in atac.tss_profile(points, sites)._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(want) == sorted(atac.tss_profile(points, sites).collect()) and len(want) > 1000


def test_keys_that_share_a_number_keep_their_own_slots():
    run = list_slots(np.array([(1 << CONTIG) + 10]), np.array([-1]), 3)
    at = [(1 << CONTIG) + p for p in (8, 9, 9, 50, 10, 10, 13, 14)]
    table = pa.table({"k": ["a", "b", "a", "b", None, None, "c", "d"], "_at": at, "_key": [1, 1, 1, 1, 5, 5, 6, 7]})
    for size in (1, 3, 8):
        rows = [r for b in run(iter(table.to_batches(size))) for r in b.to_pylist()]
        assert sorted(rows, key=str) == sorted([
            {"k": "a", "slots": [4, 5], "n": [1, 1]}, {"k": "b", "slots": [4], "n": [1]},
            {"k": None, "slots": [3], "n": [2]}, {"k": "c", "slots": [0], "n": [1]}], key=str)
