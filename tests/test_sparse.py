"""One row per cell: round trips and quality from within the row."""

import pytest
from pyspark.sql import functions as F

from cellbulk.operators import rna, sparse

COUNTS = "analysis_set_accession string, barcode_sample string, gene_id string, count long"


@pytest.fixture
def parts(spark):
    rows = [("A", "c1", "g1", 5), ("A", "c1", "MT", 2), ("A", "c1", "g9", 0), ("A", "c2", "RP", 7), ("A", "c2", "MR", 1),
            ("B", "c1", "g1", 3), ("B", "c1", "MT", 1), ("B", "c1", "MT", 4), ("B", "c3", "new", 6)]
    counts = spark.createDataFrame(rows, COUNTS)
    info = spark.createDataFrame([("MT", "MT-1", True, False), ("RP", "RPS1", False, True), ("MR", "x", True, True), ("g1", "G", False, False)],
                                 "gene_id string, gene_name string, mt boolean, ribo boolean")
    universe = spark.createDataFrame([("A", g) for g in ("g1", "g0", "MT", "RP", "MR", "g9")] + [("B", g) for g in ("MT", "g1", "new")],
                                     "analysis_set_accession string, gene_id string")
    return counts, info, sparse.gene_dictionary(universe, info)


def test_numbers_follow_the_class(parts):
    got = {(r.analysis_set_accession, r.gene_id): r.gene_no for r in parts[2].collect()}
    assert [g for _, g in sorted((n, g) for (a, g), n in got.items() if a == "A")] == ["MR", "MT", "RP", "g0", "g1", "g9"]
    assert {n for (a, _), n in got.items() if a == "B"} == {0, 1, 2}


def test_round_trip(spark, parts):
    counts, _, dictionary = parts
    cells = counts.select(*sparse.BARCODE).unionAll(spark.createDataFrame([("A", "empty")], "a string, b string"))
    rows = sparse.to_sparse(counts, dictionary, cells)
    assert all(list(r.genes) == sorted(set(r.genes)) and len(r.genes) == len(r.counts) for r in rows.collect())
    assert rows.where("barcode_sample = 'empty'").first().genes == [] and rows.count() == 5
    want = counts.groupBy(*counts.columns[:3]).agg(F.sum("count").alias("count"))
    got = sparse.from_sparse(rows, dictionary)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert sparse.to_sparse(counts.limit(0), dictionary).collect() == []


def test_quality_from_the_row(spark, parts):
    counts, info, dictionary = parts
    cells = counts.select(*sparse.BARCODE).unionAll(spark.createDataFrame([("A", "empty")], "a string, b string"))
    assigned = spark.createDataFrame([("A", "c1", "p")], "analysis_set_accession string, barcode_sample string, pseudobulk_id string")
    merged = counts.groupBy(*counts.columns[:3]).agg(F.sum("count").alias("count"))
    want = rna.rna_cell_qc(merged, info, assigned, cells)
    got = sparse.sparse_cell_qc(sparse.to_sparse(counts, dictionary, cells), dictionary, assigned)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_quality_needs_no_shuffle_by_cell(spark, parts, tmp_path, capsys):
    counts, _, dictionary = parts
    sparse.to_sparse(counts, dictionary).write.parquet(f"file://{tmp_path}/m")
    dictionary.write.parquet(f"file://{tmp_path}/d")
    assigned = spark.createDataFrame([("A", "c1", "p")], "analysis_set_accession string, barcode_sample string, pseudobulk_id string")
    assigned.write.parquet(f"file://{tmp_path}/a")
    m, d, a = (spark.read.parquet(f"file://{tmp_path}/{n}") for n in "mda")
    sparse.sparse_cell_qc(m, d, a).explain()
    exchanges = [line for line in capsys.readouterr().out.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "barcode_sample" not in exchanges[0]  # the class limits only


def test_a_gene_without_a_number_is_an_error(spark, parts):
    counts, _, dictionary = parts
    with pytest.raises(Exception, match="no number for gene new of B"):
        sparse.to_sparse(counts, dictionary.where("gene_id != 'new'")).collect()
