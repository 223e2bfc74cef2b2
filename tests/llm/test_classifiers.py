"""Held-out accuracy of the three trained operators, and their defined cases."""

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cellbulk.llm import quality, toxicity, url_filter
from cellbulk.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


def labels_of(sf):
    return {r[0]: r[1:] for r in duckdb.connect().execute(
        f"SELECT doc_id, quality, toxic FROM '{sf}/labels.parquet'").fetchall()}


@pytest.mark.parametrize("name, column, folds, fold, least", [
    ("op2_quality", 0, 5, 0, 0.97), ("op5_toxicity", 1, 4, 2, 0.95)])
def test_held_out_accuracy(spark, name, column, folds, fold, least):
    truth, rows = labels_of(LARGE), QUERIES[name](spark, LARGE).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, truth[r.doc_id][column]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(held) > 400 and sum(p == y for p, y in held) / len(held) >= least


@pytest.mark.parametrize("scores, blank", [(quality.quality_scores, 0.5), (toxicity.toxicity_scores, 0.0)])
def test_odd_rows(spark, docs, no_docs, scores, blank):
    labels = spark.createDataFrame(
        [(1, 1, 0, "x"), (1, 0, 1, "x"), (None, 1, 1, "x"), (3, None, None, "x"), (6, 0, 1, "x")],
        "doc_id long, quality int, toxic int, lang string")
    got = scores(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert scores(no_docs, labels).collect() == []
    assert {r.score for r in scores(docs, labels.where("false")).collect()} == {blank}


def test_labels_and_language_are_no_inputs(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    changed = docs.selectExpr("doc_id", "text", "'xx' as lang", "'none' as source")
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        a, b = ({r.doc_id: r.score for r in scores(d, labels).collect()} for d in (docs, changed))
        assert all(abs(a[i] - b[i]) < 1e-6 for i in a)


def test_filter_keeps_good_rows_whole(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.keep_good(docs, labels)
    judged = {r.doc_id for r in quality.quality_scores(docs, labels).collect() if r.predicted}
    assert kept.schema == docs.schema and {r.doc_id for r in kept.collect()} == judged


def test_every_word_is_encoded():
    encode, rows = toxicity.encoder(), lambda text: {tuple(r) for r in toxicity.encoder()(text).tolist()}
    for glued in ("<b>idiot</b>", "you/idiot", "and,idiot", "nice-loser idiot", '{"a":"idiot"}', "x=1;idiot=2"):
        assert rows("Idiot") < rows(glued) and len(rows(glued)) >= 2
    assert rows("--- !") == rows("---") | rows("!") and rows("a --- b,") == rows("a b ---")
    assert len(encode("")) == 0 and len(encode("<b>you idiot</b>")) == 4
    assert rows("\u7b28\u86cb\u5440") < rows("\u4f60\u662f\u7b28\u86cb\u5440\u3002") and len(encode("\u4f60\u662f\u7b28\u86cbab cd")) == 6
    assert rows("\u0e07\u0e35\u0e48\u0e40\u0e07\u0e48\u0e32") < rows("\u0e04\u0e19\u0e07\u0e35\u0e48\u0e40\u0e07\u0e48\u0e32")


def test_long_text_is_scored_in_runs(monkeypatch):
    texts = ["", "a b c d e f g", "x", " ".join(f"w{i}" for i in range(23)), "one,two;three " * 5]
    codes = [toxicity.encoder()(t) for t in texts]
    parts = toxicity.train(codes[1:], np.array([0, 1, 0, 1.0]), epochs=3)
    whole = toxicity.logits(parts, codes)
    monkeypatch.setattr(toxicity, "RUN", 4)
    assert np.allclose(toxicity.logits(parts, codes), whole, atol=1e-5)
    assert all((a == toxicity.encoder()(t)).all() for a, t in zip(codes, texts))


def test_toxic_word_behind_markup(spark):
    texts = [(i, f"we met {w} near the {p} on day {i}") for i in range(120)
             for w, p in [("idiot" if i % 2 else "friend", ("river", "house", "bridge")[i % 3])]]
    odd = [(1000, "<b>idiot</b>"), (1001, "the,idiot,river"), (1002, "<b>friend</b>"), (1003, "the,friend,river")]
    frame = spark.createDataFrame(texts + odd, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, toxic int")
    got = {r.doc_id: r.score for r in toxicity.toxicity_scores(frame, labels).where("doc_id >= 1000").collect()}
    assert got[1000] > 0.5 > got[1002] and got[1001] > 0.5 > got[1003]


def plain_rule(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, rest = rest[:cut].translate({i: i + 32 for i in range(65, 91)}), rest[cut:]
    path = rest[:min([i for i in map(rest.find, "?#") if i >= 0], default=len(rest))]
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.text), default=None)


def test_url_verdicts(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/", "http://xcom/", "http://a.com", "http://a.com?x=/", "a://b://c.com/",
            "http://Example.COM/en/x", "http://www.example.com/en/", "http://x.www.example.com/en/y#z", "http://n.net/es/",
            "http://n.net/ES/", "http://n.net/fr/?q", "http://É.net/fr/", "http://x.org/\nen", "http://" + "a." * 3000 + "org/" + "p" * 20_000]
    rows = [(i, u, "r") for i, u in enumerate(urls + urls[:3])]
    frame = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = url_filter.judge(frame, URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path, rule = plain_rule(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule.text if rule else None)
        if rule:
            assert r.verdict == ("block" if rule.block else "allow")
        assert r.verdict in ("allow", "block") and 0 <= r.block_score <= 1
    assert url_filter.judge(frame.where("false"), URL_RULES).collect() == []
    assert {r.verdict for r in url_filter.judge(frame, []).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge(frame.where("page_id = 4"), URL_RULES).collect()} == {"allow"}


def test_url_model_agrees_with_the_rules_it_learned_from(spark):
    rows = [r for r in QUERIES["op10_url_filter"](spark, LARGE).collect() if r.rule]
    agree = sum((r.block_score >= 0.5) == (r.verdict == "block") for r in rows)
    assert agree / len(rows) >= 0.97


def test_columns_of_any_name_survive_judging(docs):
    judged = url_filter.judge(docs.withColumn("url", F.lit("http://a.com/x")), URL_RULES)
    assert judged.columns == [c for c in docs.columns if c != "host"] + ["url", "host", "path", "rule", "verdict", "block_score"]
    assert judged.select("features", "_tag").exceptAll(docs.select("features", "_tag")).isEmpty()
    assert {r.host for r in judged.collect()} == {"a.com"}


def test_quality_sees_whole_chunks():
    encode = quality.encoder()
    plain = encode("some plain words").tolist()
    assert len(plain) == 3 and encode("").size == 0 and encode("- --").size == 2
    han = "".join(chr(0x4E00 + i) for i in range(900))
    assert len(set(encode(han).tolist())) > 800  # three letters at a time, none left out
    glued = ",".join(f"word{i}" for i in range(300))
    assert len(set(encode(glued).tolist())) >= 300
    assert encode("x" * 1000 + "中文").size == len(quality.parts_of("x" * 1000)) + 1
    for chunk in ("<b>" + "tag" * 20 + "</b>", "กข ฃ", "a中1" * 30, "!" * 99, "_" * 30):
        pieces = [p for c in chunk.split() for p in quality.parts_of(c)]
        assert set(chunk) - {" "} <= set("".join(pieces)) and max(map(len, pieces)) <= quality.LONG
    late = "bad" * 40
    assert encode("y" * 60 + late).tolist() != encode("y" * 60 + "good" * 30).tolist()


def test_toxicity_learns_from_every_labelled_row(spark):
    """A word met only beyond the rows of the first pass, and only late in long texts."""
    texts = [(i, f"we met {'idiot' if i % 2 else 'friend'} near the river on day {i}") for i in range(300)]
    texts += [(i, " ".join(["plain words again"] * 1200) + (" zorbag" if i % 2 else " velmon")) for i in range(300, 420)]
    frame = spark.createDataFrame(texts + [(1000, "a zorbag"), (1001, "a velmon")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in texts], "doc_id long, toxic int")
    model = toxicity.fit(frame, labels, warm=60, shard=60, rounds=6)
    low, high = toxicity.scorer(model)()(["a velmon", "a zorbag"])
    assert high > low + 0.2 and high > 0.5
    again = toxicity.fit(frame, labels, warm=60, shard=60, rounds=6)
    assert np.allclose(again.table, model.table, atol=1e-6) and again.thresholds == model.thresholds


def test_training_codes_take_two_bytes_a_bucket_and_held_out_texts_are_not_joined(spark):
    from cellbulk.llm import labelled
    docs = spark.createDataFrame([(i, "one two three", "en") for i in range(40)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    held = toxicity.fold_of(F.col("doc_id"), toxicity.FOLDS) == toxicity.HELD_OUT
    coded, _ = labelled.all_codes(docs, labels, "toxic", held, lambda: lambda t: toxicity.encoder()(t).ravel(), toxicity.CODES)
    rows = coded.collect()
    assert {len(r.codes) for r in rows} == {3 * 3 * 2}
    assert sorted(r.id for r in rows) == [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert [c.tolist() for c in toxicity.code_column({"codes": [rows[0].codes]})] == [toxicity.encoder()("one two three").tolist()]
