"""Incremental sums: bounded folders, replays, crashes, equality with one pass."""

import os

import pytest
from pyspark.sql import functions as F

from cellbulk.streaming.tiers import ENTRIES, TieredSums


def sums_in(spark, folder, fan=3):
    return TieredSums(spark, f"file://{folder}", ["k"], [F.sum("n").alias("n"), F.max("top").alias("top")], fan)


def batch(spark, i):
    return lambda: spark.createDataFrame([("a", 1, i), (f"k{i % 3}", i, i)], "k string, n long, top long")


def plain(ids):
    want = {}
    for i in ids:
        for k, n in (("a", 1), (f"k{i % 3}", i)):
            old = want.get(k, (0, 0))
            want[k] = (old[0] + n, max(old[1], i))
    return want


def held(sums):
    return {r.k: (r.n, r.top) for r in sums.total().collect()}


def folders(path):
    return sum(1 for d, _, names in os.walk(path) if any(n.endswith(".parquet") for n in names))


def test_many_batches_leave_few_folders(spark, tmp_path):
    sums, counts = sums_in(spark, tmp_path), []
    for i in range(40):
        assert sums.add(i, batch(spark, i))
        counts.append(folders(tmp_path))
    assert held(sums) == plain(range(40))
    # at most fan live slots a tier and as many that older entries hold, in log3(40) tiers
    assert max(counts) <= ENTRIES + 2 * 3 * 5 and max(counts[20:]) <= max(counts[:20]) + 6


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    sums = sums_in(spark, tmp_path)
    for i in range(5):
        sums.add(i, batch(spark, i))
    for i in (4, 2):
        assert not sums.add(i, batch(spark, 99))
    assert held(sums_in(spark, tmp_path)) == plain(range(5))


@pytest.mark.parametrize("where", ["sums", "ledger"])
def test_a_batch_that_fails_half_way_is_added_once(spark, tmp_path, monkeypatch, where):
    sums = sums_in(spark, tmp_path)
    for i in range(2):
        sums.add(i, batch(spark, i))

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch, pytest.raises(OSError):
        if where == "sums":
            sums.add(2, broken)
        else:
            patch.setattr(spark, "createDataFrame", broken)  # after merging, before the entry
            frame = spark.sql("SELECT 'a' AS k, 50L AS n, 50L AS top")
            sums.add(2, lambda: frame)
    assert held(sums) == plain(range(2))
    assert sums.add(2, batch(spark, 2)) and held(sums) == plain(range(3))


def test_readers_keep_their_slots(spark, tmp_path):
    sums = sums_in(spark, tmp_path)
    for i in range(9):
        sums.add(i, batch(spark, i))
    seen = sums.total()
    for i in range(9, 9 + ENTRIES - 2):
        sums.add(i, batch(spark, i))
    assert {r.k: (r.n, r.top) for r in seen.collect()} == plain(range(9))


def test_an_entry_being_overwritten_is_passed_over(spark, tmp_path):
    sums = sums_in(spark, tmp_path)
    for i in range(6):
        sums.add(i, batch(spark, i))
    for name in os.listdir(tmp_path / "ledger" / "2"):  # batch 6 would go there
        os.remove(tmp_path / "ledger" / "2" / name)
    assert held(sums) == plain(range(6))


def test_nothing_added(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        sums_in(spark, tmp_path).total()
