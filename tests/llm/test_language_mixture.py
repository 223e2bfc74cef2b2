"""Language mixtures against a plain computation, planted mixtures and held-out accuracy."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellbulk.llm import language_mixture as lm
from cellbulk.llm.common import fold_of
from cellbulk.llm.queries import op12_language

SF = "/root/testdata/sf0.01"


def plain_counts(text):
    low = [c if c.isalpha() else "\0" for c in f"\0{text.lower()}\0"]
    whole = [ord(a) | ord(b) << 21 | ord(c) << 42 for a, b, c in zip(low, low[1:], low[2:]) if b != "\0"]
    return Counter((w * int(lm.MIX) & (1 << 64) - 1) >> 48 for w in whole)


@pytest.mark.parametrize("text", ["", " ", "123 .,", "a", "Ab", "ab cd, EF\nÉcole 中文字 x1y", "İstanbul ΟΔΟΣ \U0001d400a", "ab" * 50])
@pytest.mark.parametrize("piece", [lm.PIECE, 3, 1])
def test_grams(monkeypatch, text, piece):
    monkeypatch.setattr(lm, "PIECE", piece)
    buckets, n = lm.gram_counts(text)
    assert dict(zip(buckets.tolist(), n.tolist())) == dict(plain_counts(text))


def plain_proportions(given, n, inside):
    """Proportions of the languages ``inside`` by one gram at a time."""
    shares = {l: 1 / len(inside) for l in inside}
    for _ in range(lm.ROUNDS):
        after = dict.fromkeys(inside, 0.0)
        for row, count in zip(given, n):
            whole = sum(shares[l] * row[l] for l in inside)
            for l in inside:
                after[l] += count * shares[l] * row[l] / whole / sum(n)
        moved = max(abs(after[l] - shares[l]) for l in inside)
        shares = after
        if moved < lm.STEADY:
            break
    return shares, sum(c * np.log(sum(shares[l] * row[l] for l in inside)) for row, c in zip(given, n))


def plain_judge(model, text):
    buckets, n = lm.gram_counts(text)
    if not len(buckets):
        return lm.UNKNOWN, []
    given, every = model.likelihood[buckets].astype(float), range(len(model.names))
    alone = [sum(c * np.log(row[l]) for row, c in zip(given, n)) for l in every]
    chosen, reached = {int(np.argmax(alone)): 1.0}, max(alone)
    order = sorted(every, key=lambda l: -plain_proportions(given, n, list(every))[0][l])
    for size in range(2, len(order) + 1):
        shares, likelihood = plain_proportions(given, n, order[:size])
        if likelihood - reached <= lm.PENALTY * np.log(sum(n) + 1):
            break
        chosen, reached = shares, likelihood
    ranked = sorted(chosen, key=lambda l: (-chosen[l], l))
    return model.names[ranked[0]], [model.names[l] for l in ranked]


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return lm.fitted(docs.where(fold_of(F.col("doc_id"), 4) != 2))


def test_mixtures_against_plain(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 4000").orderBy("doc_id").limit(60).collect()
    texts = [r.text for r in docs]
    en, de, fr = (next(r.text for r in docs if r.lang == l) for l in ("en", "de", "fr"))
    texts += ["", "1 2 3", "x", f"{en[:700]} {de[:700]}", f"{en[:600]} {fr[:600]} {de[:600]}", en + " " + fr[:400]]
    best, score, sets = model.judge(texts)
    assert list(zip(best, sets)) == [plain_judge(model, t) for t in texts]
    assert sets[-3:-1] and set(sets[-3]) == {"en", "de"} and set(sets[-2]) == {"en", "de", "fr"}
    assert all(0 <= s <= 1 for s in score)
    alone = [model.judge([t]) for t in texts]  # whatever stands beside a text
    assert best == [a[0][0] for a in alone] and sets == [a[2][0] for a in alone]
    assert np.allclose(score, [a[1][0] for a in alone], atol=1e-6)


def test_held_out_accuracy(spark):
    rows = op12_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    right = [r.lang == r.lang_pred for r in rows if r.held_out]
    assert len(right) > 200 and np.mean(right) >= 0.98


def test_odd_rows(docs, no_docs, spark):
    got = lm.languages(docs, fold_of(F.col("doc_id"), 4) == 2).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in (None, 7)}
    for r in got:
        if r.doc_id in texts:
            blank = not any(c.isalpha() for c in texts[r.doc_id] or "")
            assert (r.lang_pred == "und") == blank and (r.score == 0) == blank
            assert r.lang_pred in ("und", "en", "fr") and bool(r.languages) != blank
    assert lm.languages(no_docs, F.lit(False)).collect() == []
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in lm.languages(unlabelled, F.lit(False)).collect()} == {("und", 0.0)}


def test_many_languages_are_passed_on(spark, monkeypatch):
    monkeypatch.setattr(lm, "HELD_AT_ONCE", 2)
    rows = [(i, f"wort{chr(97 + i % 7) * 3} {chr(97 + i % 7) * 5}", f"l{i % 7}") for i in range(70)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    n = sum(sum(plain_counts(t).values()) for _, t, _ in rows)
    assert lm.language_counts(frame).agg(F.sum("n")).first()[0] == n
    assert all(r.lang_pred == f"l{r.doc_id % 7}" for r in lm.languages(frame, F.lit(False)).collect())
