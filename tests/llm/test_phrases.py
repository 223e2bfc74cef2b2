"""Collocations against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellbulk.llm import phrases as ph

LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least, longest=5, most=2000, share=100):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        found = []
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in frequent.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q)))
                   for q, b in frequent.items()):
                continue
            score, _, l, r = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:most], 1):
            yield lang, rank, phrase.decode(), -a, l, r, n[lang], -score


def mined(frame, **options):
    return sorted(tuple(r) for r in ph.collocations(frame, **options).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def made(spark, rows):
    return spark.createDataFrame([(i, l, t, 1, 2, "x", 3) for i, (l, t) in enumerate(rows)],
                                 "doc_id long, lang string, text string, n long, a long, phrase string, words int").repartition(3)


def odd_rows():
    rng = np.random.default_rng(5)
    vocabulary = ["the", "of", "The", "é", "a\x01", "a", "中文", "x y", "-", "\x1cq"]
    rows = []
    for i in range(120):
        words = rng.choice(vocabulary, rng.integers(0, 60), p=[.34, .2, .1, .1, .06, .06, .05, .04, .03, .02])
        rows.append((["en", "fr", None, "und"][int(i > 70) + int(i > 90) + int(i > 110)],
                     "".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", "!"], p=[.7, .1, .1, .05, .03, .02]) for w in words)))
    rows += [("en", "one and the same passage of eight words")] * 30
    return rows + [("en", None), (None, None), ("en", ""), ("de", " .\n"), ("de", "alone"), ("en", "x" * 5000), ("fr", "w " * 3000)]


@pytest.mark.parametrize("sizes", [{}, {"RANGE_ROWS": 40}, {"PIECE": 64, "HELD": 30}, {"BITS": 1 << 16, "RANGE_ROWS": 3}])
def test_against_plain_counting(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(ph, name, value)
    rows = odd_rows()
    want = sorted(plain(rows, 6))
    assert len(want) > 50 and mined(made(spark, rows), least=6) == want


def test_parameters(spark):
    rows = odd_rows()
    frame = made(spark, rows)
    assert mined(frame, least=12, longest=3, most=7, share=60) == sorted(plain(rows, 12, 3, 7, 60))


def test_full_bitmap_loses_nothing(spark, monkeypatch):
    def full(self, hashes):
        self.last, self.bits = np.uint64(ph.BITS - 1), np.full(ph.BITS // 8, 255, np.uint8)

    monkeypatch.setattr(ph.FrequentBits, "__init__", full)
    rows = odd_rows()
    assert mined(made(spark, rows), least=6) == sorted(plain(rows, 6))


def test_hashes_of_both_sides_agree(spark):
    names = ["a", "of", "é", "中文", "a\x01"]
    frame = spark.createDataFrame([("en", n) for n in names], "lang string, phrase string")
    links = ph.Links(ph.FrequentBits(frame.select(ph.word_hash(F.col("lang"), F.col("phrase")))))
    tokens = [n.encode() for n in names]
    assert links.hashes("en", tokens).all() and not links.hashes("fr", tokens).any()
    assert links.pairs_of("en", [tokens[0], b".", *tokens[1:3], b"rare", tokens[3]])[0].tolist() == [2]


def test_empty_tables(spark):
    frame = made(spark, [("en", "a b")])
    assert mined(frame.where(F.lit(False))) == [] and mined(frame) == []


def test_scores_pass_64_bits(spark, monkeypatch):
    words = spark.createDataFrame([("en", "", 10**15), ("en", "a", 10**12), ("en", "b", 10**12 + 7)], "lang string, phrase string, n long")
    pairs = spark.createDataFrame([("en", "a b", 2, 10**12 - 1)], "lang string, phrase string, words int, n long")
    monkeypatch.setattr(ph, "phrase_counts", lambda *_: (words, pairs))
    score = 1000 * (10**12 - 1) * 10**15 // (10**12 * (10**12 + 7))
    assert mined(words) == [("en", 1, "a b", 10**12 - 1, 10**12, 10**12 + 7, 10**15, score)]


def test_quicksort_partitions():
    rng = np.random.default_rng(6)
    rows = np.zeros((3000, 5), np.int32)
    for row in rows:
        k = rng.integers(1, 6)
        row[:k] = np.minimum(rng.geometric(0.4, k), 9)
    weight = rng.integers(1, 5, 3000)
    want = Counter()
    for row, w in zip(rows.tolist(), weight.tolist()):
        for k in range(2, 1 + sum(x > 0 for x in row)):
            want[tuple(row[:k])] += w
    got = {tuple(rows[i, :k].tolist()): n for i, k, n in ph.equal_partitions(rows, weight, 20)}
    assert got == {p: n for p, n in want.items() if n >= 20}
