"""Binned interval operators against nested loops on small random tables."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cellbulk.operators import intervals
from cellbulk.operators.intervals import heavy_bins, overlap_filter, overlap_flag, points_in_intervals
from cellbulk.operators.ranking import top_n
from cellbulk.operators.tracks import (
    coverage,
    merge_equal_neighbours,
    number_islands,
    overlay_frames,
)
from cellbulk.session import saved, saved_bytes

ROW = "contig string, start long, end long, id long"


def random_rows(rng, n, long_share=0.1):
    rows = []
    for i in range(n):
        start = rng.randrange(0, 3000)
        length = rng.randrange(1, 2500) if rng.random() < long_share else rng.randrange(1, 40)
        rows.append((rng.choice(["c1", "c2"]), start, start + length, i))
    return rows


def overlaps(a, b, share=None):
    shared = min(a[2], b[2]) - max(a[1], b[1])
    if a[0] != b[0] or shared <= 0:
        return False
    return share is None or shared >= share * (a[2] - a[1]) or shared >= share * (b[2] - b[1])


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("share", [None, 0.5])
@pytest.mark.parametrize("salt", [1, 3])
def test_semi_anti_flag(spark, seed, share, salt):
    rng = random.Random(seed)
    a, b = random_rows(rng, 80), random_rows(rng, 12)
    left, right = spark.createDataFrame(a, ROW), spark.createDataFrame(b, ROW)
    options = dict(min_overlap=share, width=16, salt=salt)
    hit = {row[3] for row in a if any(overlaps(row, other, share) for other in b)}
    args = (left, "start", "end", right, "start", "end", ["contig"])
    semi = [r.id for r in overlap_filter(*args, how="semi", **options).collect()]
    anti = [r.id for r in overlap_filter(*args, how="anti", **options).collect()]
    flag = {r.id: r.hit for r in overlap_flag(*args, out="hit", **options).collect()}
    assert sorted(semi) == sorted(hit)
    assert sorted(semi + anti) == list(range(80))
    assert flag == {i: i in hit for i in range(80)}


def test_shuffled_path_gives_the_same(spark):
    """With broadcasting off the joins are salted; results stay the same."""
    rng = random.Random(11)
    a, b = random_rows(rng, 120), random_rows(rng, 15)
    left, right = spark.createDataFrame(a, ROW), spark.createDataFrame(b, ROW)
    args = (left, "start", "end", right, "start", "end", ["contig"])
    hit = sorted(row[3] for row in a if any(overlaps(row, other) for other in b))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(r.id for r in overlap_filter(*args).collect()) == hit
        flagged = overlap_flag(*args, out="hit").where("hit")
        assert sorted(r.id for r in flagged.collect()) == hit
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_one_locus_holding_everything(spark):
    """All rows at one position: rows stay whole and are not multiplied."""
    left = spark.range(3000).select(F.lit("c1").alias("contig"), F.lit(100).cast("long").alias("start"),
                                    F.lit(180).cast("long").alias("end"), "id")
    right = left.limit(500)
    args = (left, "start", "end", right, "start", "end", ["contig"])
    assert overlap_filter(*args, salt=4).count() == 3000
    assert overlap_filter(*args, how="anti", salt=4).count() == 0


@pytest.fixture
def shuffled(spark):
    """No broadcasts, and as many tasks as there are shuffle partitions."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in held}
    for key, value in held.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def hot_rows(spark):
    """A third of the rows at one locus, the rest over 2,000 bins."""
    return spark.range(60_000).select(
        F.lit("c1").alias("contig"), F.when(F.col("id") % 3 == 0, F.lit(100)).otherwise(1000 + F.col("id") * 67).alias("start"),
        "id").withColumn("end", F.col("start") + 20)


def loads(frame):
    """Largest and median number of rows a task of the join gives."""
    n = sorted(r["count"] for r in frame.groupBy(F.spark_partition_id()).count().collect())
    return n[-1], n[len(n) // 2], len(n)


@pytest.mark.parametrize("kind", ["semi", "flag", "points"])
def test_a_hot_bin_is_split_by_its_load(spark, shuffled, kind):
    left = hot_rows(spark)
    spans = left.groupBy("contig", "start").agg(F.max("end").alias("end"))
    args = (left, "start", "end", spans, "start", "end", ["contig"])
    points = (left.withColumnsRenamed({"start": "pos"}).drop("end"), "pos", spans, "start", "end", ["contig"])

    def run(rows):
        if kind == "points":
            return points_in_intervals(*points, heavy_rows=rows)
        if kind == "flag":
            return overlap_flag(*args, out="hit", heavy_rows=rows).where("hit")
        return overlap_filter(*args, heavy_rows=rows)

    split, whole = run(500), run(10**9)
    largest, median, tasks = loads(split)
    assert tasks == 16 and largest < 3 * median
    assert loads(whole)[0] > 5 * loads(whole)[1]
    assert split.count() == 60_000 and split.select("id").distinct().count() == 60_000
    if kind == "semi":
        assert overlap_filter(*args, how="anti", heavy_rows=500).isEmpty()


def test_heavy_bins_stay_few(spark):
    rows = spark.range(10_000).select((F.col("id") % 100).alias("bin"))
    assert heavy_bins(rows, ["bin"], rows=10).count() == 100
    few = heavy_bins(rows.unionAll(rows.where("bin = 7")), ["bin"], rows=10, most=60)
    assert [(r.bin, r._fan) for r in few.collect()] == [(7, 2)]
    assert heavy_bins(rows.limit(0), ["bin"]).isEmpty()


def test_points_left_join_keeps_every_point(spark):
    points = spark.createDataFrame([("c1", p) for p in (5, 10, 300, 9999)], "contig string, pos long")
    spans = spark.createDataFrame([("c1", 0, 10), ("c1", 300, 301)], "contig string, s long, e long")
    got = {r.pos: r.s for r in points_in_intervals(
        points, "pos", spans, "s", "e", ["contig"], width=8, how="left").collect()}
    assert got == {5: 0, 10: None, 300: 300, 9999: None}


@pytest.mark.parametrize("tile", [8, 64, 1 << 16])
@pytest.mark.parametrize("distinct", [False, True])
def test_coverage_is_depth_per_base(spark, tile, distinct):
    rows = random_rows(random.Random(tile), 60, 0.05)
    depth = {}
    for contig, start, end, _ in rows:
        for base in range(start, end):
            depth[contig, base] = depth.get((contig, base), 0) + 1
    runs = coverage(spark.createDataFrame(rows, ROW), "start", "end", tile=tile,
                    distinct=distinct).collect()
    got = {(r.contig, base): r.depth for r in runs for base in range(r.start, r.end)}
    assert got == depth
    ordered = sorted((r.contig, r.start, r.end, r.depth) for r in runs)
    assert all(x[:1] + x[2:3] != y[:2] or x[3] != y[3] for x, y in zip(ordered, ordered[1:]))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 300), st.integers(1, 90)), min_size=1, max_size=20))
def test_total_length_is_kept(spark, pieces):
    frame = spark.createDataFrame([("c1", s, s + n, i) for i, (s, n) in enumerate(pieces)], ROW)
    runs = coverage(frame, "start", "end", tile=32)
    total = runs.agg(F.sum((F.col("end") - F.col("start")) * F.col("depth"))).first()[0]
    assert total == sum(n for _, n in pieces)


@pytest.mark.parametrize("cover", ["all", "any"])
@pytest.mark.parametrize("tile", [8, 1 << 16])
def test_overlay_per_base(spark, cover, tile):
    rng = random.Random(7)
    tracks, base_values = {}, {}
    for name in ("x", "y", "z"):
        at, runs = 0, []
        while at < 120:
            start = at + rng.randrange(0, 9)
            end = start + rng.randrange(1, 12)
            runs.append(("c1", start, end, float(rng.randrange(1, 5))))
            at = end
        tracks[name] = spark.createDataFrame(runs, "contig string, start long, end long, value double")
        base_values[name] = {b: v for _, s, e, v in runs for b in range(s, e)}
    rows = overlay_frames(tracks, cover=cover, fill=0.0 if cover == "any" else None, tile=tile).collect()
    got = {b: (r.x, r.y, r.z) for r in rows for b in range(r.start, r.end)}
    keep = all if cover == "all" else any
    want = {b: tuple(base_values[n].get(b, 0.0) for n in "xyz") for b in range(200)
            if keep(b in base_values[n] for n in "xyz")}
    assert got == want


@pytest.mark.parametrize("tile", [10, 1 << 16])
def test_islands_across_tiles(spark, tile):
    runs = [(0, 4), (4, 12), (14, 15), (40, 41), (42, 95), (96, 130), (200, 201)]
    frame = spark.createDataFrame([("c1", s, e) for s, e in runs], "contig string, start long, end long")
    for gap, want in ((0, [1, 1, 2, 3, 4, 5, 6]), (1, [1, 1, 2, 3, 3, 3, 4]), (2, [1, 1, 1, 2, 2, 2, 3])):
        got = number_islands(frame, ["contig"], lambda p, c: c["start"] - p["end"] <= gap, tile)
        assert [r.island for r in got.orderBy("start").collect()] == want


def test_merge_equal_neighbours(spark):
    frame = spark.createDataFrame([("c1", 0, 5, 1.0), ("c1", 5, 9, 1.0), ("c1", 9, 10, 2.0),
                                   ("c1", 11, 12, 2.0)], "contig string, start long, end long, v double")
    got = merge_equal_neighbours(frame, ["v"], tile=4).orderBy("start").collect()
    assert [(r.start, r.end, r.v) for r in got] == [(0, 9, 1.0), (9, 10, 2.0), (11, 12, 2.0)]


@pytest.mark.parametrize("n", [1, 7, 100, 1000])
def test_top_n(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice("ab"), float(rng.choice([0, 0.5, 3, 3.0001, 70])), i) for i in range(300)]
    got = top_n(spark.createDataFrame(rows, "g string, s double, i long"), ["g"], "s", n, ["i"])
    want = [r for g in "ab" for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[:n]]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_any_overlap_on_all_levels(spark):
    """Lengths from one base to far beyond the coarsest bins, against a nested loop."""
    pick = random.Random(7)
    a = [("c", s, s + n) for n in (1, 8, 9, 16, 17, 64, 65, 500, 513, 4000, 30_000, 300_000) for s in
         (pick.randrange(2_000_000) for _ in range(25))]
    b = [("c", s, s + pick.choice((0, 1, 3, 40, 900))) for s in (pick.randrange(2_000_000) for _ in range(40))]
    fa, fb = (spark.createDataFrame(r, "contig string, s long, e long").withColumnsRenamed(n)
              for r, n in ((a, {}), (b, {"s": "bs", "e": "be"})))
    want = sorted(r for r in a if any(min(r[2], x[2]) > max(r[1], x[1]) for x in b))
    for levels in (None, intervals.levels_of(fa, "s", "e", width=8)):
        got = intervals.overlap_filter(fa, "s", "e", fb, "bs", "be", ["contig"], width=8, levels=levels)
        assert sorted(tuple(r) for r in got.collect()) == want and 20 < len(want) < 280


def test_partners_stay_few_and_plain(spark):
    b = spark.range(20_000).select(F.lit("c").alias("contig"), F.col("id").alias("s"), (F.col("id") + 1).alias("e"))
    rows = intervals._partners(b, "s", "e", ["contig"], 64, True)
    assert rows.where("_level > 1").count() < 3000  # it was every row on every level
    only = intervals._partners(b, "s", "e", ["contig"], 64, False, [0])
    assert only.select("_level").distinct().collect() == [(0,)] and only.count() < 2 * 20_000
    same = saved(spark.range(200_000).select(F.lit("annotation_1-SM1").alias("p"), F.lit(1 << 40).alias("n")), "x", plain=True)
    assert saved_bytes(same) > 200_000 * 24
