"""Depths of windows around points, tile by tile, against the general coverage."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cellbulk.catalog import QUERIES
from cellbulk.functions import depths
from cellbulk.operators.peaks import fisher_track, fisher_track_of_counts, scored_segments
from cellbulk.operators.tracks import coverage, depth_zooms, overlay, runs_end_near, window_depths, zoom_levels

ROWS = [("a", 10_000 * i, 2) for i in range(1, 9)]  # one run over eight windows
ROWS += [("a", 300_000, 1), ("b", 0, 3), ("b", 0, 1), ("b", 4096, 1), ("b", 12_288, 5), ("c", 5, 7)]
ROWS += [("d", random.Random(1).randrange(200_000) + i, i % 3 + 1) for i in range(400)]


@pytest.mark.parametrize("tile", [1 << 12, 10_000, 1 << 20])
def test_window_depths_equal_coverage(spark, tile):
    points = spark.createDataFrame(ROWS, "contig string, pos long, n long")
    none = F.lit(0).cast("long")
    wide = F.greatest(F.col("pos") - 5000, F.lit(0)), F.col("pos") + 5000
    near = F.greatest(F.col("pos") - 75, F.lit(0)), F.col("pos") + 75
    tags = points.select("contig", F.col("n").alias("p"), none.alias("c"), near[0].alias("lo"), near[1].alias("hi")).union(
        points.select("contig", none, "n", *wide))
    want = coverage(tags, "lo", "hi", weights={"p": F.col("p"), "c": F.col("c")})
    got = window_depths(points, "pos", "n", {"p": 150, "c": 10_000}, tile=tile)
    assert got.columns == want.columns and got.count() == want.count() > 500
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    alone = window_depths(points, "pos", "n", {"c": 10_000}, tile=tile).where("contig = 'a' AND c = 2")
    assert [tuple(r) for r in alone.collect()] == [("a", 5000, 85_000, 2)]


@pytest.mark.parametrize("tile", [1 << 6, 1 << 12, 1 << 20])
def test_depth_zooms_equal_zooms_of_the_runs(spark, tile):
    points = spark.createDataFrame(ROWS, "contig string, pos long, n long")
    want = zoom_levels(window_depths(points, "pos", "n", {"d": 150}), value="d", finest=4, levels=8)
    got = depth_zooms(points, "pos", "n", 150, finest=4, levels=8, tile=tile)
    assert got.columns == want.columns and got.dtypes == want.dtypes and got.count() == want.count() > 130
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert depth_zooms(points.limit(0), "pos", "n", 150).collect() == []
    with pytest.raises(ValueError):
        depth_zooms(points, "pos", "n", 150, finest=13, tile=1 << 12)


def test_depth_zooms_shuffle_points_and_not_their_runs(spark):
    points = spark.createDataFrame(ROWS, "contig string, pos long, n long")
    plan = depth_zooms(points, "pos", "n", 150, levels=8)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and "Aggregate" not in plan
    assert plan.index("FlatMapGroupsInArrow") < plan.index("RepartitionByExpression") < plan.index("Generate")


def test_groups_that_share_a_number_are_told_apart():
    schema = pa.schema([("contig", pa.string()), ("level", pa.int32()), ("window", pa.int64()), ("value_sum", pa.float64()),
                        ("min_value", pa.float64()), ("max_value", pa.float64()), ("covered", pa.int64())])
    run = depths.windows_in_slice(["contig"], 4, 64, True, [3, 6], schema)
    mixed = pa.table({"contig": ["a", "b", "a"], "_tile": [0, 0, 1], "_at": [2, 2, 66], "_n": [1, 2, 3]})
    assert sorted(tuple(r.values()) for r in run(mixed).to_pylist()) == [
        ("a", 3, 0, 4, 1, 1, 4), ("a", 3, 8, 12, 3, 3, 4), ("a", 6, 0, 4, 1, 1, 4), ("a", 6, 1, 12, 3, 3, 4),
        ("b", 3, 0, 8, 2, 2, 4), ("b", 6, 0, 8, 2, 2, 4)]


def test_segments_shuffle_points_and_not_their_edges(spark):
    counts = spark.createDataFrame([("x", r, "chr1", 1000 * i, 1) for i in range(2000) for r in ("t", "1")],
                                   "pseudobulk_id string, rep string, contig string, pos long, n long")
    found = scored_segments(counts, 100_000_000)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and plan.count("FlatMapGroupsInArrow") == 2
    assert found.where("score IS NULL OR end IS NULL OR lambda <= 0").isEmpty() and found.count() > 4000


def test_no_points(spark):
    assert window_depths(spark.createDataFrame([], "contig string, pos long, n long"), "pos", "n", {"d": 3}).collect() == []


def test_overlay_shuffles_runs_and_not_their_ends(spark):
    track = spark.createDataFrame([("c", r, 10 * i, 10 * i + 9, float(i)) for i in range(50) for r in "ab"],
                                  "contig string, rep string, start long, end long, value double")
    found = overlay(track, "rep", ["a", "b"], tile=64)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate inline") < plan.index("RepartitionByExpression")  # above it, so after the exchange
    assert [(r.start, r.end) for r in found.orderBy("start").collect()] == [(10 * i, 10 * i + 9) for i in range(50)]


@pytest.mark.parametrize("clip", [True, False])
@pytest.mark.parametrize("widths", [[1], [150, 10_000], [7, 2]])
def test_depths_base_by_base_equal_edges(monkeypatch, widths, clip):
    draw = np.random.default_rng(3)
    for points in (draw.integers(0, 900, 700), draw.integers(0, 20_000, 300), np.arange(0, 500), np.array([4, 4, 4])):
        weights = draw.integers(1, 4, len(points))
        got = []
        for dense in (0, 1 << 40):
            monkeypatch.setattr(depths, "DENSE", dense)
            got.append(depths.changes(points, weights, widths, clip))
        assert got[0][0].tolist() == got[1][0].tolist() and len(got[0][0])
        assert [d.tolist() for d in got[0][1]] == [d.tolist() for d in got[1][1]]


REP_COUNTS = "pseudobulk_id string, rep string, contig string, pos long, n long"


def pooled(rows):
    """Counts of both replicates with those of the pooled set."""
    total = {}
    for p, _, c, at, n in rows:
        total[p, c, at] = total.get((p, c, at), 0) + n
    return rows + [(p, "t", c, at, n) for (p, c, at), n in total.items()]


@pytest.mark.parametrize("tile", [1 << 12, 10_000, 1 << 20])
def test_fisher_of_counts_equals_overlaid_segments(spark, tile):
    draw, seen = random.Random(5), {}
    for p, c, top, n in (("x", "a", 60_000, 300), ("x", "b", 9000, 40), ("y", "a", 200_000, 60), ("y", "off", 500, 9)):
        for _ in range(n):
            key = p, draw.choice("12"), c, draw.randrange(top)
            seen[key] = seen.get(key, 0) + 1
    rows = [(*k, n) for k, n in seen.items()] + [("x", "1", "d", 70, 2), ("x", "2", "d", 100, 2), ("z", "1", "a", 5, 1)]
    counts = spark.createDataFrame(pooled(rows), REP_COUNTS)
    sizes = spark.createDataFrame([("a", 50_000, 1), ("b", 20_000, 2), ("d", 100_000, 3)], "chr string, size long, chrom_order int")
    want = fisher_track(scored_segments(counts, 1_000_000), sizes).withColumn("value", F.round("value", 8))
    for in_order in (False, True):
        got = fisher_track_of_counts(counts, 1_000_000, sizes, in_order=in_order, tile=tile).withColumn("value", F.round("value", 8))
        assert got.columns == want.columns and got.count() == want.count() > 500
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_fisher_of_counts_where_runs_never_end_near(spark):
    rows = [("x", r, "a", 50 * i, 1) for i in range(2000) for r in "12"]
    counts = spark.createDataFrame(pooled(rows), REP_COUNTS)
    widths, keys, tile = {"p": 150, "c": 10_000}, ["pseudobulk_id", "rep", "contig"], 1 << 14
    assert runs_end_near(counts, "pos", "n", widths, keys, tile=tile) == 0
    assert runs_end_near(counts.where("pos < 40000 OR pos % 800 = 0"), "pos", "n", widths, keys, tile=tile) == 0
    assert runs_end_near(counts.where("pos < 2000"), "pos", "n", widths, keys, tile=tile) == 10_000
    sizes = spark.createDataFrame([("a", 200_000, 1)], "chr string, size long, chrom_order int")
    want = fisher_track(scored_segments(counts, 1_000_000), sizes)
    got = fisher_track_of_counts(counts, 1_000_000, sizes, tile=tile)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count() > 100
    assert not want.where("end - start > 16384").isEmpty()


@pytest.mark.parametrize("tile", [1 << 12, 1 << 20])
def test_depths_that_look_ahead_equal_those_of_two_passes(spark, tile):
    points = spark.createDataFrame(ROWS[8:], "contig string, pos long, n long")
    widths = {"p": 150, "c": 10_000}
    ahead = runs_end_near(points, "pos", "n", widths, tile=tile)
    want = window_depths(points, "pos", "n", widths, tile=tile)
    got = window_depths(points, "pos", "n", widths, tile=tile, ahead=ahead)
    assert ahead == 10_000 and got.columns == want.columns and got.count() == want.count() > 400
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_fisher_query_shuffles_counts_and_not_segments(spark):
    plan = QUERIES["fisher_combine"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("FlatMapGroupsInArrow") == plan.count("RepartitionByExpression") == 1
