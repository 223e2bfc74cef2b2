"""Hard negatives against brute force with Python integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellbulk.llm import hard_negatives as hn
from cellbulk.llm.strassen import product

SCHEMA = "vec_id long, embedding array<float>, label int, id int, score int, place string"


@pytest.mark.parametrize("shape", [(1, 1, 1), (70, 64, 130), (65, 33, 67), (5, 0, 4), (0, 8, 9), (100, 7, 100)])
def test_product(shape):
    m, k, n = shape
    rng = np.random.default_rng(3)
    a, b = rng.integers(-999, 999, (m, k)), rng.integers(-999, 999, (k, n))
    for leaf in (1, 8, 32):
        assert (product(a, b, leaf) == a @ b).all()


def test_product_survives_wrapped_sums():
    a = np.full((64, 64), (1 << 28) - 1, np.int64)
    b = np.full((64, 64), 1 << 28, np.int64)
    assert product(a, b, 4)[5, 9] == 64 * ((1 << 28) - 1) * (1 << 28)


def plain(rows, positives=5, negatives=3):
    """Rows (id, vector, label) by the contract, one row per id."""
    kept = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        kept[i] = min(kept.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in kept.items()}
    for i, (label, v) in whole.items():
        if i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, (other, w) in whole.items()
                        if j != i and len(v) == len(w))
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            found = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:negatives]
            yield from ((i, j, rank, k, -p, -n) for rank, (n, k, _) in enumerate(found, 1))


def mined(frame, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = hn.hard_negatives(frame, F.col("vec_id") % 50 == 0, label, **options)
    return sorted(tuple(r) for r in rows.collect())


def odd_rows():
    rng = np.random.default_rng(4)
    made = np.float32(rng.normal(size=(420, 24)) * 0.2)
    made[100:160] = made[100]  # ties, among them an anchor
    made[300:330] = 0
    rows = [(i, [float(x) for x in v], 1 if i % 3 else i % 10) for i, v in enumerate(made)]  # a hot label
    rows += [rows[50], (50, rows[51][1], 9), (61, rows[3][1], 0)]  # repeated ids
    rows += [(1000, None, 1), (1050, rows[4][1], None), (None, rows[4][1], 1), (1100, [float("nan")] * 24, 1),
             (1150, [float("inf")] * 24, 1), (1200, [None] * 24, 1), (1250, [], 1), (1251, [], 2), (1252, [], 1),
             (1300, [1.0, 2.0], 3), (1301, [1.0, 2.5], 3), (1302, [1.0, 1.0], 4), (-50, rows[5][1], 2)]
    return rows


@pytest.mark.parametrize("anchors, candidates", [(4096, 8192), (3, 50)])
def test_against_brute_force(spark, monkeypatch, anchors, candidates):
    monkeypatch.setattr(hn, "ANCHOR_ROWS", anchors)
    monkeypatch.setattr(hn, "CANDIDATE_ROWS", candidates)
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], SCHEMA)
    want = sorted(plain(rows))
    assert want and mined(frame) == want
    assert mined(frame, positives=2, negatives=1) == sorted(plain(rows, 2, 1))


def test_nothing_to_mine(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(1, [1.0], 1, 1, 1, "x")], SCHEMA)) == []


def test_products_beyond_a_long_are_refused(spark):
    with pytest.raises(Exception, match="too large for exact"):
        mined(spark.createDataFrame([(50, [3e30, 1.0], 1, 1, 1, "x")], SCHEMA))
