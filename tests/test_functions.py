"""Column functions against closed forms and literal values."""

import math

import pytest
from pyspark.sql import functions as F

from cellbulk.functions import genomics as G
from cellbulk.functions import stats as S
from cellbulk.operators.annotation import attribute_map
from cellbulk.operators.inventory import glob_regex


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def tail(k, lam):
    terms = (math.exp(i * math.log(lam) - lam - math.lgamma(i + 1)) for i in range(k + 1, k + 4000))
    return -math.log10(math.fsum(terms))


def test_poisson_vector(spark):
    want = 4.21022960655635
    assert one(spark, S.poisson_score(F.lit(10), F.lit(2.5))) == pytest.approx(want, abs=1e-10)


@pytest.mark.parametrize("k, lam", [(0, 0.01), (1, 3.0), (30, 2.0), (500, 80.0), (40, 600.0),
                                    (1999, 2000.0)])
def test_poisson_both_forms(spark, k, lam):
    frame = spark.createDataFrame([(k, lam)], "k long, lam double")
    row = frame.select(
        S.poisson_score(F.col("k"), F.col("lam")).alias("native"),
        S.poisson_score_arrow(F.col("k").cast("double"), F.col("lam")).alias("arrow")).first()
    assert row.native == pytest.approx(tail(k, lam), rel=1e-8, abs=1e-9)
    assert row.arrow == pytest.approx(tail(k, lam), rel=1e-8, abs=1e-9)


@pytest.mark.parametrize("k, lam, want", [
    (0, 715.0, 0.0), (5000, 9000.0, 0.0), (0, 1e6, 0.0), (-1, 3.0, 0.0), (999_999, 1e6, 0.30098),
    (4, None, None), (None, 2.0, None), (3, float("nan"), None), (3, 0.0, None)])
def test_poisson_far_below_and_odd_input(spark, k, lam, want):
    frame = spark.createDataFrame([(k, lam)], "k long, lam double")
    row = frame.select(
        S.poisson_score(F.col("k"), F.col("lam")).alias("native"),
        S.poisson_score_arrow(F.col("k").cast("double"), F.col("lam")).alias("arrow")).first()
    for got in (row.native, row.arrow):
        assert got == (want if want is None else pytest.approx(want, abs=2e-4 if want else 1e-8))


@pytest.mark.parametrize("k, lam", [(700, 715.0), (8900, 9000.0), (9400, 9000.0), (20, 25.5), (99_000, 1e5)])
def test_poisson_at_depth(spark, k, lam):
    upper = math.fsum(math.exp(i * math.log(lam) - lam - math.lgamma(i + 1)) for i in range(k + 1, k + 20_000))
    frame = spark.createDataFrame([(k, lam)], "k long, lam double")
    row = frame.select(S.poisson_score(F.col("k"), F.col("lam")).alias("native"),
                       S.poisson_score_arrow(F.col("k").cast("double"), F.col("lam")).alias("arrow")).first()
    assert row.native == pytest.approx(row.arrow, rel=1e-9, abs=1e-12)
    assert row.arrow == pytest.approx(-math.log10(upper), rel=1e-6, abs=1e-8)


def test_fisher_of_three(spark):
    score = 6.2957935 / math.log(10) / 3
    got = one(spark, S.fisher_combine(*[F.lit(score)] * 3))
    assert 10 ** -got == pytest.approx(0.05, abs=1e-6)


def test_symlog_round_trip(spark):
    for value in (-250.0, -0.5, 0.0, 0.9, 1.0, 77.0):
        bent = S.symlog(F.lit(value), F.lit(1.0))
        assert one(spark, S.inverse_symlog(bent, F.lit(1.0))) == pytest.approx(value)
    assert one(spark, S.symlog(F.lit(77.0), F.lit(None).cast("double"))) == 77.0


def test_ratio_of_zero_is_null(spark):
    assert one(spark, S.percent(F.lit(1), F.lit(0))) is None


def test_accession_before_first_dot(spark):
    assert one(spark, G.accession_of(F.lit("ACC7.part.bed.gz"))) == "ACC7"


def test_slices_are_monotone(spark):
    values = [-1e9, -3.2, -1e-9, 0.0, 1e-9, 0.1, 0.1001, 5.0, 1e12]
    got = [one(spark, S.value_slice(F.lit(v))) for v in values]
    assert got == sorted(got)


def test_attributes_last_key_wins(spark):
    text = 'gene_id "G1"; tag "a"; tag "b"; level 2'
    frame = spark.createDataFrame([(text,)], "attributes string")
    got = frame.select(attribute_map("attributes").alias("m")).first().m
    assert got == {"gene_id": "G1", "tag": "b", "level": "2"}


@pytest.mark.parametrize("pattern, name, hit", [
    ("*_qc.tsv.gz", "a_qc.tsv.gz", True), ("*_qc.tsv.gz", "a_qcXtsv.gz", False),
    ("a?c", "abc", True), ("a?c", "abbc", False), ("x.bw", "xybw", False)])
def test_globs(spark, pattern, name, hit):
    assert one(spark, F.lit(name).rlike(glob_regex(pattern))) is hit


def test_half_even_picks(spark):
    assert [one(spark, F.bround(F.lit(v))) for v in (2.5, 3.5)] == [2, 4]
