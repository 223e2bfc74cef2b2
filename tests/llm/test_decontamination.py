"""Benchmark windows: brute force, DuckDB, proximity."""

import hashlib
import re

import duckdb
import pytest

from cellbulk.llm import decontamination as D
from cellbulk.llm.queries import ORACLES, QUERIES
from tests.oracle_check import canonical

ITEMS = [
    (1, "one two three four five six seven eight nine ten eleven twelve"), (2, "Short ITEM here"), (10, "short item here"),
    (3, ""), (4, None), (None, "text without id"), (5, "alone"), (6, "the the the the the the the the the the the"),
    (7, "never seen anywhere in any of the texts at all really"), (8, "É t é"),
]
TEXTS = [
    (1, "zero ONE two, three; four five six seven eight nine ten eleven twelve thirteen"),
    (2, "two three four five six seven eight nine ten eleven - and a short item here, short item here"),
    (3, "one two three four five six seven eight nine"), (4, None), (5, ""), (None, "Alone again"),
    (6, " ".join(["the"] * 40)), (7, "short item"), (7, "short item here"), (7, "short item here"), (8, "É t é É t É"),
    (9, "filler " * 20_000 + "short item here " + "filler " * 20_000),
]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(text):
    own = words(text)
    hit, items = set(), set()
    for item, body in ITEMS:
        w = words(body)
        n = min(10, len(w))
        for s in range(len(w) - n + 1) if n and item is not None else ():
            for at in range(len(own) - n + 1):
                if own[at:at + n] == w[s:s + n]:
                    hit.update(range(at, at + n))
                    items.add(str(item))
    return len(own), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def frames(spark):
    docs = spark.createDataFrame([(*t, 1, "x", 2) for t in TEXTS], "doc_id long, text string, tag int, pos string, wid int")
    return docs, spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, term string")


def test_matches_brute_force(frames):
    got = D.contamination(*frames).collect()
    assert sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in got) == sorted(
        str((i, *brute(t))) for i, t in TEXTS)
    kept = D.clean_documents(*frames)
    assert kept.columns == frames[0].columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == sorted(
        str((i, t)) for i, t in TEXTS if not brute(t)[4])


def test_empty_tables(frames):
    docs, items = frames
    assert D.contamination(docs.where("false"), items).collect() == []
    assert not any(r.contaminated for r in D.contamination(docs, items.where("false")).collect())


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"),
        (2, "alpha beta x gamma delta epsilon y zeta eta theta iota kappa"),
        (3, "alpha then a great many other words before kappa"), (4, "nothing at all")], "doc_id long, text string")
    texts, windows = D.keyed(docs, "doc_id", "text"), D.item_windows(items)
    counts = D.term_counts(texts, windows.selectExpr("explode(words) as term").distinct())
    anchored = D.with_anchors(windows, counts)
    index = D.postings(texts, anchored.selectExpr("term1 as term").union(anchored.select("term2")).distinct())
    assert {r.doc for r in D.exact_matches(index, texts, anchored).collect()} == {1}
    assert {r.doc for r in D.proximity_matches(index, texts, anchored).collect()} == {1, 2}


def test_proximity_with_edited_words(spark):
    own = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    items = spark.createDataFrame([(1, " ".join(own)), (2, "absent beta gamma delta epsilon zeta eta theta iota kappa"),
                                   (3, "solo"), (4, None), (None, "beta")], "item_id long, text string")
    swap = lambda *at: " ".join("new" if i in at else w for i, w in enumerate(own))
    texts = [(1, swap()), (2, swap(0)), (3, swap(0, 9)), (4, swap(0, 4, 9)), (5, "x y " + swap(3, 5) + " z"),
             (6, " ".join(own[1:])), (7, "nothing"), (None, "solo"), (8, None), (7, "nothing")]
    # everything but alpha and kappa is frequent, so the edited words are the rarest
    texts += [(100 + i, "beta gamma delta epsilon") for i in range(5)] + [(200 + i, "zeta eta theta iota") for i in range(5)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = D.near_contamination(docs, items).collect()
    want = {1: 2, 2: 2, 3: 2, 5: 1, 6: 2, None: 1}
    assert sorted(str((r.doc_id, r.n_proximity)) for r in got) == sorted(str((i, want.get(i, 0))) for i, _ in texts)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    want, got = con.execute(ORACLES[name]).df(), QUERIES[name](spark, sf).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want) and len(want)


def test_columns_of_any_name_survive_cleaning(spark, docs):
    items = spark.createDataFrame([("a", "the lazy dog near the river bank today")], "item_id string, text string")
    kept = D.clean_documents(docs, items)
    assert kept.columns == docs.columns
    want = docs.where("coalesce(text, '') NOT LIKE '%lazy dog near%'")
    assert kept.exceptAll(want).isEmpty() and want.exceptAll(kept).isEmpty() and kept.count() < docs.count()
