"""Every query with a DuckDB statement agrees with it on the smallest tables."""

import pytest

from cellbulk import catalog
from cellbulk.catalog import QUERIES
from cellbulk.oracles import oracle_statements
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
STATEMENTS = oracle_statements()


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


SHARED = ("insertion_counts", "segments", "members", "atac_qc", "rna_qc", "expression", "final_peaks", "frip")


@pytest.fixture(scope="module", autouse=True)
def shared_study(spark):
    """All queries start from one study, whose costly frames are computed once."""
    study = catalog.Study(spark, SF_DIR)
    for name in SHARED:
        study.__dict__[name] = getattr(study, name).persist()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(catalog, "Study", lambda spark, sf_dir: study)
        yield
    spark.catalog.clearCache()


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_matches_oracle(spark, db, name):
    assert compare(spark, db, name, SF_DIR, STATEMENTS[name]) == ""


def test_only_checksums_lack_a_statement():
    assert set(QUERIES) - set(STATEMENTS) == {"file_md5"}


def test_file_md5(spark):
    import hashlib
    from pathlib import Path

    rows = QUERIES["file_md5"](spark, SF_DIR).collect()
    want = {p.name: hashlib.md5(p.read_bytes()).hexdigest() for p in Path(SF_DIR).glob("*.parquet")}
    assert {r.name: r.md5 for r in rows} == want
