"""Language identification by mixtures of n-gram models.

A gram is a letter with both its neighbours, in lower case, where anything but a letter
counts as a space; so a text has as many grams as letters. A language's model is the
smoothed distribution of its grams over hash buckets, counted over all labelled documents
of the training folds. A document is a mixture of languages: expectation-maximisation
finds the proportions that make its grams likeliest. The languages named are those of the
smallest set whose likelihood no further language raises by more than a penalty that
grows with the logarithm of the text; sets are nested in the order of the proportions.

Defined results: a null or empty text, and one without a letter, is ``und`` with score 0;
so is every text while nothing is labelled. Texts of any length count whole, long ones in
pieces of ``PIECE`` characters. Among equal proportions the smaller name wins. Rows that
repeat an id are judged one by one. Rows without a language teach nothing. An empty table
gives an empty one. Extra columns are ignored. The model has one row of ``BUCKETS``
numbers for each language, whatever the number of documents.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellbulk.llm.common import by_bytes, text_of

UNKNOWN = "und"
BUCKETS, PIECE = 1 << 16, 1 << 20
MIX = np.uint64(0x9E3779B97F4A7C15)
SMOOTHING = 1000.0  # grams of the common background that every language is given
PENALTY = 3.0  # log-likelihood that a further language must add, times log of the letters
ROUNDS, STEADY = 40, 1e-3
HELD_AT_ONCE = 64  # languages whose counts a task keeps before it passes them on


@cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the grams of a whole text, and how often each occurs."""
    low, total = text.lower(), None
    for start in range(0, len(low), PIECE):
        stop = min(len(low), start + PIECE)
        inner = low[max(0, start - 1):stop + 1].encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(inner, "<u4")
        codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
        codes = np.concatenate([np.zeros(int(start == 0), np.uint64), codes, np.zeros(int(stop == len(low)), np.uint64)])
        middle = codes[1:-1]
        whole = codes[:-2] | middle << np.uint64(21) | codes[2:] << np.uint64(42)
        found = (whole[middle > 0] * MIX >> np.uint64(48)).astype(np.uint16)
        if len(low) > PIECE:
            total = np.bincount(found, minlength=BUCKETS) + (0 if total is None else total)
        else:
            found.sort(kind="stable")  # radix for 16 bits
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(found)), bool), found[1:] != found[:-1]]))
            return found[first], np.diff(first, append=len(found))
    if total is None:
        return np.zeros(0, np.uint16), np.zeros(0, np.int64)
    buckets = np.flatnonzero(total)
    return buckets.astype(np.uint16), total[buckets]


class Mixture:
    """Gram models of languages, and the proportions of languages in texts."""

    def __init__(self, names: list[str], counts: np.ndarray):
        """``counts``: one row of gram counts for each name; names ascend."""
        self.names = names
        shares = counts / np.maximum(1, counts.sum(axis=1, keepdims=True))
        background = 0.5 * shares.mean(axis=0) + 0.5 / BUCKETS if names else np.zeros(BUCKETS)
        smooth = (counts + SMOOTHING * background) / (counts.sum(axis=1, keepdims=True) + SMOOTHING)
        self.likelihood = np.ascontiguousarray(smooth.T, dtype=np.float32)

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, list[list[str]]]:
        """(language, score, languages by falling proportion) of every text."""
        best, score, sets = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        grams = [gram_counts(t) for t in texts] if self.names else []
        at = [i for i, (buckets, _) in enumerate(grams) if len(buckets)]
        if not at:
            return best, score, sets
        chosen, shares, letters = self._select([grams[i] for i in at])
        held = np.where(chosen, shares, 0)
        order = np.argsort(-held, axis=1, kind="stable")
        for k, i in enumerate(at):
            top = order[k, 0]
            best[i] = self.names[top]
            # one letter more of every language: a short text proves less
            score[i] = (letters[k] * held[k, top] + 1) / (letters[k] + len(self.names))
            sets[i] = [self.names[j] for j in order[k, :chosen[k].sum()]]
        return best, score, sets

    def _select(self, grams: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(chosen languages, proportions among them, letters) of texts with letters."""
        sizes = np.array([len(buckets) for buckets, _ in grams])
        given = self.likelihood[np.concatenate([buckets for buckets, _ in grams])]
        weight = np.concatenate([n for _, n in grams]).astype(np.float32)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        letters = np.add.reduceat(weight, starts).astype(np.float64)
        alone = np.add.reduceat(weight[:, None] * np.log(given), starts, axis=0)
        rows, languages = len(grams), len(self.names)
        chosen = np.zeros((rows, languages), bool)
        chosen[np.arange(rows), alone.argmax(axis=1)] = True
        shares, reached = chosen.astype(np.float64), alone.max(axis=1).astype(np.float64)
        if languages == 1:
            return chosen, shares, letters
        everything, _ = self._proportions(given, weight, sizes, np.ones((rows, languages), bool))
        rank = np.argsort(np.argsort(-everything, axis=1, kind="stable"), axis=1)
        live = np.arange(rows)
        for size in range(2, languages + 1):
            inside = np.repeat(np.isin(np.arange(rows), live), sizes)
            wanted = rank[live] < size
            found, likelihood = self._proportions(given[inside], weight[inside], sizes[live], wanted)
            better = likelihood - reached[live] > PENALTY * np.log(letters[live] + 1)
            live, found, likelihood, wanted = live[better], found[better], likelihood[better], wanted[better]
            if not len(live):
                break
            chosen[live], shares[live], reached[live] = wanted, found, likelihood
        return chosen, shares, letters

    @staticmethod
    def _proportions(given: np.ndarray, weight: np.ndarray, sizes: np.ndarray,
                     allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Proportions of the allowed languages by expectation-maximisation, and the log-likelihood."""
        shares = (allowed / allowed.sum(axis=1, keepdims=True)).astype(np.float32)
        live, some, n, size = np.arange(len(sizes)), given, weight, sizes
        for _ in range(ROUNDS):
            starts = np.concatenate([[0], np.cumsum(size)[:-1]])
            joint = some * np.repeat(shares[live], size, axis=0)
            joint *= (n / joint.sum(axis=1))[:, None]
            after = np.add.reduceat(joint, starts, axis=0) / np.add.reduceat(n, starts)[:, None]
            moving = np.abs(after - shares[live]).max(axis=1) >= STEADY
            shares[live] = after
            if not moving.any():
                break
            if not moving.all():  # a text stops on its own, whatever stands beside it
                inside = np.repeat(moving, size)
                live, some, n, size = live[moving], some[inside], n[inside], size[moving]
        mixed = (given * np.repeat(shares, sizes, axis=0)).sum(axis=1)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return shares.astype(np.float64), np.add.reduceat(weight * np.log(mixed), starts).astype(np.float64)


def language_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, bucket, n) over all rows with a language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, content in zip(batch["lang"], batch["text"]):
                if name not in held:
                    if len(held) >= HELD_AT_ONCE:
                        yield from passed_on(held)
                    held[name] = np.zeros(BUCKETS, np.int64)
                buckets, n = gram_counts(content)
                held[name][buckets] += n
        yield from passed_on(held)

    def passed_on(held: dict[str, np.ndarray]) -> Iterator[pd.DataFrame]:
        for name, counts in held.items():
            buckets = np.flatnonzero(counts)
            yield pd.DataFrame({"lang": name, "bucket": buckets.astype(np.int32), "n": counts[buckets]})
        held.clear()

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), text_of(text).alias("text"))
    return rows.mapInPandas(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def fitted(docs: DataFrame, text: str = "text", lang: str = "lang") -> Mixture:
    """Models of all languages of ``docs``; what the driver gets is bounded by languages times buckets."""
    found = language_counts(docs, text, lang).toPandas()
    names = sorted(set(found["lang"]))
    counts = np.zeros((len(names), BUCKETS))
    counts[found["lang"].map({name: i for i, name in enumerate(names)}), found["bucket"]] = found["n"]
    return Mixture(names, counts)


def languages(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score, languages) of every row; rows of ``held_out`` teach nothing."""
    model = fitted(docs.where(~held_out), text, lang)
    kind = docs.schema[key].dataType.simpleString()
    at_once = max(1, (1 << 20) // max(4, len(model.names)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            best, score, sets = [], [], []
            for some in by_bytes(batch["text"], at_once):
                for whole, part in zip((best, score, sets), model.judge(some)):
                    whole.extend(part)
            yield pd.DataFrame({"key": batch["key"], "held_out": batch["held_out"], "lang_pred": best,
                                "score": score, "languages": sets})

    rows = docs.select(F.col(key).alias("key"), held_out.alias("held_out"), text_of(text).alias("text"))
    return rows.mapInPandas(run, f"key {kind}, held_out boolean, lang_pred string, score double, languages array<string>"
                            ).withColumnRenamed("key", key)
