"""Shared folder, header checks, checksums, inventory of empty folders, relaxed unions."""

import pytest
from pyspark.sql import functions as F

from cellbulk import checks, schemas
from cellbulk.catalog import QUERIES
from cellbulk.operators import inventory, ranking, report
from cellbulk.session import discard, new_folder, saved, shared_dir
from cellbulk.sources import checksums, readers


class Unset:
    """A session whose configuration lacks the shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_session_without_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Unset)


def test_saved_frames_can_be_removed(spark):
    frame = saved(spark.range(5), "numbers")
    assert frame.count() == 5
    discard(frame)
    path = frame.inputFiles()[0].rsplit("/", 1)[0]
    assert spark.read.schema("id long").parquet(path).count() == 0


def test_only_shared_folders_are_removed(spark):
    with pytest.raises(ValueError, match="shared"):
        discard(spark.read.parquet("/root/testdata/sf0.001/region.parquet"))


def test_another_header_is_refused(spark):
    good, bad = new_folder(spark, "head") + ".tsv", new_folder(spark, "head") + ".tsv"
    rows = spark.createDataFrame([("g", "t", "c", 5, "+")], schemas.TSS)
    rows.write.csv(good, sep="\t", header=True)
    rows.toDF("a", "b", "c", "d", "e").write.csv(bad, sep="\t", header=True)
    assert readers.scan_table(spark, good, schema=schemas.TSS, required=["TSS"]).count() == 1
    with pytest.raises(ValueError, match="header"):
        readers.scan_table(spark, bad, schema=schemas.TSS)


def test_checksums_are_spread_over_tasks(spark):
    files = checksums.file_md5(spark, "/root/testdata/sf0.001", "*.parquet")
    per_task = files.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 4 and max(r["count"] for r in per_task) <= 4


def test_a_folder_without_files_lacks_what_is_required(spark):
    listing = spark.createDataFrame([("a", "per_cell_qc.tsv.gz")], "folder string, name string")
    folders = spark.createDataFrame([("a",), ("empty",)], "folder string")
    got = inventory.expected_files(listing, folders=folders).where("state = 'missing'").collect()
    assert [(r.folder, r.pattern) for r in got] == [("empty", "per_cell_qc.tsv.gz")]


@pytest.mark.parametrize("n", [2, 4, 100])
def test_top_keeps_null_scores_last(spark, n):
    rows = [("g", 1.0, 1), ("g", None, 2), ("g", float("nan"), 3), ("g", 9.0, 4), (None, None, 5), (None, 2.0, 6)]
    frame = spark.createDataFrame(rows, "grp string, score double, id int")
    got = {r.id for r in ranking.top_n(frame, ["grp"], "score", n, ["id"]).collect()}
    assert got == {2: {4, 1, 6, 5}, 4: {1, 2, 3, 4, 5, 6}, 100: {1, 2, 3, 4, 5, 6}}[n]


def test_top_of_equal_scores(spark):
    frame = spark.range(5000).select(F.lit("g").alias("grp"), F.lit(0.5).alias("score"), "id")
    assert sorted(r.id for r in ranking.top_n(frame, ["grp"], "score", 7, ["id"]).collect()) == list(range(7))


def test_union_relaxes_columns_and_types(spark):
    a = spark.createDataFrame([(1, "x", True)], "n int, s string, b boolean")
    b = spark.createDataFrame([(2.5, 3)], "n double, s int")
    got = report.union_relaxed(a, b)
    assert dict(got.dtypes) == {"n": "double", "s": "string", "b": "boolean"}
    assert sorted(map(tuple, got.collect())) == [(1.0, "x", True), (2.5, "3", None)]


def test_last_metadata_row_of_a_barcode_counts(spark):
    path = new_folder(spark, "metadata") + ".tsv"
    rows = [("b", n, "d", "c", "t", "SM0", "ACC0") for n in ("first", "second", "third")]
    spark.createDataFrame(rows, list(schemas.METADATA_REQUIRED)).coalesce(1).write.csv(path, sep="\t", header=True)
    from cellbulk.plans.atac import assignments_of

    got = assignments_of(readers.load_metadata(spark, path, sequence=True), "_sequence").collect()
    assert [r.cell_name for r in got] == ["third"]


def test_rows_without_a_place_are_refused(spark):
    frame = spark.createDataFrame([("c", 1), (None, 2)], "contig string, pos long")
    with pytest.raises(ValueError, match="1 rows of the tags"):
        checks.complete(frame, ["contig", "pos"], "the tags")
    assert checks.complete(frame, ["pos"], "the tags") is frame


def test_a_watch_counts_while_rows_are_written(spark):
    frame = spark.createDataFrame([("c1", 1), (None, 2), ("c2", None), ("c3", 4)], "contig string, pos long")
    started = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    watch = checks.placed(frame, ["contig", "pos"], "the tags")
    path = new_folder(spark, "watched")
    watch.rows.write.parquet(path)
    assert watch.counts() == {"without_contig_or_pos": 2}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == started + 1
    assert not watch.act(["warning"]) and spark.read.parquet(path).count() == 4
    with pytest.raises(ValueError, match="2 rows of the tags without contig or pos, for example"):
        watch.act(["exception"])
    fine = checks.placed(frame.na.drop(), ["contig", "pos"], "the tags")
    fine.rows.write.parquet(new_folder(spark, "watched"))
    assert fine.act(["exception"])


def test_violations_are_made_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def costly(item):
        seen.add(1)
        return item

    rows = spark.createDataFrame([("r", f"i{k}") for k in range(20)], "rule string, item string").repartition(3)
    path = new_folder(spark, "sentinel")
    assert not checks.act_on(rows.select("rule", costly("item").alias("item")), ["warning", "sentinel"], path)
    assert seen.value == 20 and spark.read.parquet(path).count() == 20


@pytest.mark.parametrize("pattern, fits, fails", [
    ("a[0-9].tsv", ["a3.tsv"], ["ax.tsv", "a33.tsv"]), ("[!ab]*", ["cab", "^"], ["abc", "b"]), ("[]x]?", ["]y", "xz"], ["yz", "x"]),
    ("a[b", ["a[b"], ["ab"]), ("[^a]", ["^", "a"], ["b"]), ("*.b?d", [".bed", "x\ny.bad"], ["bed", ".bd"]), ("[a\\]", ["a", "\\"], ["b"]),
    ("[&&]x", ["&x"], ["x"])])
def test_shell_patterns(spark, pattern, fits, fails):
    import fnmatch

    names = spark.createDataFrame([(n,) for n in fits + fails], "name string")
    got = {r.name for r in names.where(F.col("name").rlike(inventory.glob_regex(pattern))).collect()}
    assert got == set(fits) == {n for n in fits + fails if fnmatch.fnmatchcase(n, pattern)}


def test_queries_leave_the_layouts_as_they_are(spark):
    before = schemas.FRAGMENT.names
    rows = QUERIES["sort_fragments"](spark, "/root/testdata/sf0.001")
    assert rows.columns == [*before, "pseudobulk_id"] and schemas.FRAGMENT.names == before
    assert QUERIES["stream_barcode_qc"](spark, "/root/testdata/sf0.001").count() > 0
