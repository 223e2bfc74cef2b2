"""The schedule stays within one block of the target, and every row has its place."""

from collections import Counter
from fractions import Fraction

import pytest

from cellbulk.llm import mixing

SIZES = {"hot": 400, "b": 90, "c": 61, "": 20, "tiny": 1}


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i, source or None, "t") for source, n in SIZES.items() for i in range(n)]
    return spark.createDataFrame(made + [(None, "b", "t"), (5, "b", "t"), (5, "b", "t")], "doc_id long, source string, offset string")


@pytest.mark.parametrize("weights", [None, {"hot": 0.5, "b": 0.25, "c": 0.2, "": 0.05}])
def test_deviation_is_below_one_block(spark, rows, weights):
    counts = rows.groupBy("source").count().collect()
    n = {r.source or "": r["count"] for r in counts}
    sizes = spark.createDataFrame(list(n.items()), "source string, n long")
    parts = {r.source: r.parts for r in mixing.source_parts(sizes, weights, 0.5, 50).collect()}
    got = mixing.with_positions(rows, weights=weights, block=4, resolution=50).collect()
    assert len(got) == sum(n.values()) and len({r.mix_position for r in got}) == len(got)
    order = [s for _, s in sorted({(r.mix_slot, r.source or "") for r in got})]
    blocks = {s: -(-k // 4) for s, k in n.items()}
    assert Counter(order) == blocks and {r.mix_slot for r in got} == set(range(len(order)))
    done, at, cycle = Counter(), 0, 0
    while at < len(order):  # every cycle hands out whole parts, and what a source has left
        amounts = {s: max(0, min(parts[s], blocks[s] - cycle * parts[s])) for s in parts}
        length, base = sum(amounts.values()), done.copy()
        for t in range(1, length + 1):
            done[order[at + t - 1]] += 1
            assert all(abs(done[s] - base[s] - Fraction(amounts[s] * t, length)) < 1 for s in parts)
        assert all(done[s] - base[s] == amounts[s] for s in parts)
        at, cycle = at + length, cycle + 1


def test_small_ranges_and_order(spark, rows, monkeypatch):
    whole = sorted((r.mix_position, str(r.doc_id)) for r in mixing.with_positions(rows, block=4, resolution=50).collect())
    monkeypatch.setattr(mixing, "RANGE_ROWS", 16)
    ranged = sorted((r.mix_position, str(r.doc_id)) for r in mixing.with_positions(rows, block=4, resolution=50).collect())
    assert len(ranged) == len(whole) and [p for p, _ in ranged] == [p for p, _ in whole]
    kept = mixing.mixed(rows, block=4, resolution=50)
    assert kept.columns == rows.columns and sorted(map(str, kept.collect())) == sorted(map(str, rows.collect()))


def test_empty_table(rows):
    assert mixing.with_positions(rows.where("false")).collect() == []


def test_too_many_weights(spark, rows):
    with pytest.raises(ValueError):
        mixing.with_positions(rows, weights={str(i): 1 for i in range(20)}, resolution=10)


@pytest.mark.parametrize("sizes, weights", [
    ({"hot": 1200, **{f"s{i}": 120 for i in range(20)}}, None),
    ({"a": 1600, "b": 600, "c": 3, "d": 40}, {"a": 0.7123, "b": 0.2876, "c": 0.0001, "d": 0}),
    ({"a": 30, "b": 30, "c": 30, "d": 7}, {"a": 1, "b": 1, "c": 1, "d": 2}),
])
def test_running_deviation_from_unrounded_weights(spark, sizes, weights):
    made = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    slots = sorted((r.mix_slot, r.source) for r in mixing.with_positions(made, weights=weights, block=1).collect())
    assert [t for t, _ in slots] == list(range(sum(sizes.values())))
    share = {s: Fraction(weights[s] if weights else n ** 0.5) for s, n in sizes.items()}
    ideal, done = dict.fromkeys(sizes, Fraction(0)), Counter()
    for _, source in slots:  # the ideal mix, slot by slot
        left = Fraction(1)
        while left:
            alive = {s: w for s, w in share.items() if w and ideal[s] < sizes[s]} or {
                s: Fraction(1) for s in sizes if ideal[s] < sizes[s]}
            total = sum(alive.values())
            step = min([left, *((sizes[s] - ideal[s]) * total / w for s, w in alive.items())])
            for s, w in alive.items():
                ideal[s] += step * w / total
            left -= step
        done[source] += 1
        assert all(abs(done[s] - ideal[s]) < 1 for s in sizes)


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 700)
    made = spark.range(6000).selectExpr("id as doc_id", "cast(pmod(id * id, 4001) as string) as source")
    got = mixing.with_positions(made, block=2).collect()
    assert len(got) == len({r.mix_position for r in got}) == 6000
    assert {r.mix_slot for r in got} == set(range(len({(r.source, r.mix_block) for r in got})))


def test_refused_weights(rows):
    with pytest.raises(ValueError):
        mixing.with_positions(rows, weights={"hot": -1.0})


def test_columns_of_any_name_survive(docs):
    kept = mixing.mixed(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    placed = mixing.with_positions(docs)
    assert placed.columns == [c for c in docs.columns if c != "mix_slot"] + ["mix_block", "mix_slot", "mix_position"]
    assert placed.select("_source", "_hash", "_rank").exceptAll(docs.select("_source", "_hash", "_rank")).isEmpty()
