"""Toxicity scores: a convolutional network over hashed word embeddings, in numpy.

Every word of a text is encoded, whatever it is glued to: a run of word characters, or
what stands between spaces where that has none. A word has three hashed features: itself
and its first four and five letters; its embedding is their mean. In scripts written
without spaces every character begins a word, whose features are the one, two and three
characters from there on. Filters of widths one to three run over the embeddings and
each keeps its maximum over the document, from which a logistic layer scores. Trained
by Adagrad; through the maxima only few positions carry a gradient. Logits are
temperature-scaled on held-back rows and moved from the sample's to the labels' odds.
Thresholds are calibrated by language on the held-back rows; they decide ``flagged`` and
have no part in the score.

Defined results: null and empty texts have no words and the score of padding alone;
without labels of both kinds every score is 0; rows with null or repeated ids are
scored like others.
"""

import re
import zlib
from collections.abc import Iterator
from itertools import islice
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellbulk.llm import labelled
from cellbulk.llm.common import by_bytes, fold_of
from cellbulk.session import saved

BUCKETS, DIMS, FILTERS, WIDTHS, MEMORY = 1 << 16, 16, 8, (1, 2, 3), 300_000
FOLDS, HELD_OUT = 4, 2
WARM, SHARD, ROUNDS, BLOCKS = 6000, 10_000, 2, 64
PAD = max(WIDTHS) - 1
CODES = "<u2"  # holds every bucket
# Thai to Tibetan, Myanmar, Khmer, kana, Han
_UNSPACED = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30fa\u30fc-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
_UNSPACED_RUN = re.compile(f"[{_UNSPACED}]+")
_WORDS = re.compile(rf"(?:(?![{_UNSPACED}])\w)+|[{_UNSPACED}]+|(?<!\S)[^\w\s{_UNSPACED}]++(?!\S)")
_PLAIN = re.compile(r"\w+|(?<!\S)[^\w\s]++(?!\S)")
RUN = 1 << 16  # words of a text that are encoded, and window starts that are scored, at once


def features(word: str) -> tuple[int, int, int]:
    """Buckets of a word; bucket 0 is padding."""
    if _UNSPACED_RUN.match(word):
        parts = "1" + word[:1], "2" + word[:2], "3" + word[:3]
    else:
        word = word.lower()
        parts = "=" + word, "4" + word[:4], "5" + word[:5]
    return tuple(1 + zlib.crc32(f.encode()) % (BUCKETS - 1) for f in parts)


def grams(run: str) -> Iterator[str]:
    return (run[i:i + 3] for i in range(len(run)))


def words_of(text: str) -> Iterator[str]:
    if not _UNSPACED_RUN.search(text):
        return (m.group() for m in _PLAIN.finditer(text)) if len(text) > 16 * RUN else iter(_PLAIN.findall(text))
    return (w for m in _WORDS.finditer(text) for w in (
        grams(m.group()) if _UNSPACED_RUN.match(m.group()) else (m.group(),)))


def encoder():
    known: dict[str, tuple[int, int, int]] = {}

    def encode(text: str) -> np.ndarray:
        found, words = [np.zeros((0, 3), np.int32)], words_of(text)
        while run := list(islice(words, RUN)):
            new = {w for w in run if w not in known}
            if len(known) + len(new) > MEMORY:
                known.clear()
                new = set(run)
            known.update((w, features(w)) for w in new)
            found.append(np.array([known[w] for w in run], np.int32).reshape(-1, 3))
        return np.concatenate(found)

    return encode


class Model(NamedTuple):
    table: np.ndarray  # buckets x dims
    filters: tuple[np.ndarray, ...]  # for each width: width x dims x filters
    bias: np.ndarray
    weight: np.ndarray
    base: float
    temperature: float
    shift: float
    thresholds: dict[str, float]


def stream_of(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All documents in one array with padding after each, and where each begins."""
    pad = np.zeros((PAD + 1, 3), np.int32)
    begin = np.concatenate([[0], np.cumsum([len(c) + PAD + 1 for c in codes])[:-1]]).astype(np.int64)
    return np.concatenate([part for c in codes for part in (c, pad)]), begin


def convolved(vectors: np.ndarray, filters) -> np.ndarray:
    """Positions x (widths * filters); windows that begin in a document end in its padding."""
    size = len(vectors)
    out = np.empty((size, len(filters) * FILTERS), np.float32)
    for k, kernel in enumerate(filters):
        here = vectors @ kernel[0]
        for r in range(1, len(kernel)):
            here[:size - r] += vectors[r:] @ kernel[r]
        out[:, k * FILTERS:(k + 1) * FILTERS] = here
    return out


class State(NamedTuple):
    """Parameters and, for Adagrad, the sums of their squared slopes."""
    params: list[np.ndarray]  # table, a kernel for each width, bias, weight, base
    seen: list[np.ndarray]


def fresh(seed: int = 4) -> State:
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.05, (BUCKETS, DIMS)).astype(np.float32)
    table[0] = 0
    filters = [rng.normal(0, 0.3, (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
    count = len(WIDTHS) * FILTERS
    bias, weight, base = np.zeros(count, np.float32), rng.normal(0, 0.3, count).astype(np.float32), np.zeros(1, np.float32)
    params = [table, *filters, bias, weight, base]
    return State(params, [np.full_like(p, 1e-3) for p in params])


def windows(params: list[np.ndarray], codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each document and filter the maximum and the words under it; long ones in runs."""
    table, filters = params[0], params[1:1 + len(WIDTHS)]
    count, wide = len(WIDTHS) * FILTERS, np.arange(PAD + 1)
    best = np.full((len(codes), count), -np.inf, np.float32)
    words = np.zeros((len(codes), count, PAD + 1, 3), np.int32)
    runs = [(i, c[at:at + RUN + PAD], min(RUN, max(1, len(c) - at + 1))) for i, c in enumerate(codes) for at in range(0, max(1, len(c)), RUN)]
    while runs:
        size = np.cumsum([len(r[1]) for r in runs])
        stop = max(1, int(np.searchsorted(size, 4 * RUN, "right")))
        part, runs = runs[:stop], runs[stop:]
        stream, begin = stream_of([c for _, c, _ in part])
        maps = convolved(table[stream].mean(axis=1), filters)
        for (i, _, starts), b in zip(part, begin):
            top = b + maps[b:b + starts].argmax(axis=0)
            value = maps[top, np.arange(count)]
            more = value > best[i]
            best[i, more] = value[more]
            words[i, more] = stream[top[more, None] + wide]
    return best, words


def learn(state: State, codes: list[np.ndarray], y: np.ndarray, rate: float = 0.2) -> None:
    """One step of Adagrad on a few documents."""
    params, seen = state
    table, filters, (bias, weight, base) = params[0], params[1:-3], params[-3:]
    value, words = windows(params, codes)
    value += bias
    hidden = np.maximum(value, 0)
    wrong = (labelled.sigmoid(hidden @ weight + base) - y) / len(y)
    back = (wrong[:, None] * weight * (value > 0)).astype(np.float32)
    slopes, rows, grads = [], [], []
    for k, width in enumerate(WIDTHS):
        own = slice(k * FILTERS, (k + 1) * FILTERS)
        slope = np.zeros_like(filters[k])
        for r in range(width):
            spot = words[:, own, r]
            slope[r] = np.einsum("nfd,nf->df", table[spot].mean(axis=2), back[:, own])
            rows.append(spot.reshape(-1, 3))
            grads.append((back[:, own, None] * filters[k][r].T[None]).reshape(-1, DIMS) / 3)
        slopes.append(slope)
    rows, grads = np.concatenate(rows), np.concatenate(grads)
    touched, where = np.unique(rows.ravel(), return_inverse=True)
    total = np.zeros((len(touched), DIMS), np.float32)
    np.add.at(total, where, np.repeat(grads, 3, axis=0))
    total[touched == 0] = 0
    seen[0][touched] += total * total
    table[touched] -= rate * total / np.sqrt(seen[0][touched])
    last = back.sum(axis=0), (hidden.T @ wrong).astype(np.float32), np.array([wrong.sum()], np.float32)
    for i, slope in enumerate((*slopes, *last), 1):
        seen[i] += slope * slope
        params[i] -= rate * slope / np.sqrt(seen[i])


def parts_of(state: State) -> tuple:
    table, *filters, bias, weight, base = state.params
    return table, tuple(filters), bias, weight, float(base[0])


def warmed(codes: list[np.ndarray], y: np.ndarray, epochs: int | None = None, batch: int = 32, seed: int = 4) -> State:
    epochs = epochs or max(6, 30_000 // len(codes))  # few documents are seen more often
    state, rng = fresh(seed), np.random.default_rng(seed + 1)
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(codes)), max(1, len(codes) // batch)):
            learn(state, [codes[i] for i in at], y[at])
    return state


def train(codes: list[np.ndarray], y: np.ndarray, epochs: int | None = None):
    return parts_of(warmed(codes, y, epochs))


def packed(state: State) -> np.ndarray:
    return np.concatenate([p.ravel() for p in (*state.params, *state.seen)])


def unpacked(flat: np.ndarray) -> State:
    like, at, found = fresh().params, 0, []
    for p in like * 2:
        found.append(flat[at:at + p.size].reshape(p.shape).copy())
        at += p.size
    return State(found[:len(like)], found[len(like):])


def logits(parts, codes: list[np.ndarray]) -> np.ndarray:
    """The maxima of a long document are the maxima over its runs."""
    filters, bias, weight, base = parts[1:]
    runs, starts, own = [], [], []
    for c in codes:
        own.append(len(runs))
        for at in range(0, max(1, len(c)), RUN):
            last = at + RUN >= len(c)
            runs.append(c[at:] if last else c[at:at + RUN + PAD])
            starts.append(len(c) - at + 1 if last else RUN)
    best = np.empty((len(runs), len(filters) * FILTERS), np.float32)
    at = 0
    while at < len(runs):
        stop, size = at + 1, starts[at]
        while stop < len(runs) and size + starts[stop] <= 4 * RUN:
            size += starts[stop]
            stop += 1
        best[at:stop] = maxima(parts, runs[at:stop], starts[at:stop])
        at = stop
    best = np.maximum.reduceat(best, own, axis=0) if own else best
    return np.maximum(best + bias, 0) @ weight + base


def maxima(parts, codes: list[np.ndarray], starts: list[int]) -> np.ndarray:
    """Of each run and filter the maximum over its first ``starts`` windows. Filters are
    applied to each distinct word once, then summed by position."""
    table, filters = parts[:2]
    stream, begin = stream_of(codes)
    code, place = np.unique(stream[:, 0].astype(np.int64) << 34 | stream[:, 1].astype(np.int64) << 17 | stream[:, 2], return_inverse=True)
    kinds = np.stack([code >> 34, code >> 17 & 0x1FFFF, code & 0x1FFFF], axis=1)
    vectors = table[kinds].mean(axis=1)
    best = np.empty((len(begin), len(filters) * FILTERS), np.float32)
    # windows that begin in the last paddings would reach into the next document
    edges = np.stack([begin, begin + np.array(starts)], axis=1).ravel()
    for k, kernel in enumerate(filters):
        here = (vectors @ kernel[0])[place]
        for r in range(1, len(kernel)):
            here[:len(place) - r] += (vectors @ kernel[r])[place[r:]]
        best[:, k * FILTERS:(k + 1) * FILTERS] = np.maximum.reduceat(here, edges, axis=0)[::2]
    return best


def language_thresholds(judged: DataFrame, least: int = 20) -> dict[str, float]:
    """For each language the cut with the best F1 on held-back rows; 0.3 where there are few."""
    found, cuts = {}, np.linspace(0.05, 0.95, 19)
    over = [F.count_if(F.col("score") >= float(c)).alias(f"n{i}") for i, c in enumerate(cuts)]
    hits = [F.sum(F.when(F.col("score") >= float(c), F.col("label")).otherwise(0)).alias(f"h{i}") for i, c in enumerate(cuts)]
    for row in judged.where("lang != ''").groupBy("lang").agg(F.count("*").alias("n"), F.sum("label").alias("ones"), *over, *hits).collect():
        if row.n >= least and 0 < row.ones < row.n:
            f1 = [2 * row[f"h{i}"] / max(1, row[f"n{i}"] + row.ones) for i in range(len(cuts))]
            good = [c for c, f in zip(cuts, f1) if f >= max(f1) - 1e-9]
            found[row.lang] = float(min(good, key=lambda c: abs(c - 0.3)))
    return found


def best_temperature(raw: DataFrame) -> float:
    """``labelled.temperature`` over the rows of a table, its losses summed by Spark."""
    grid = np.exp(np.linspace(np.log(0.5), np.log(5.0), 40))
    signed = F.when(F.col("label") > 0, F.col("raw")).otherwise(-F.col("raw"))
    losses = [F.avg(F.log1p(F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), signed / float(t)))))) for t in grid]
    row = raw.agg(F.count_distinct("label"), *losses).first()
    return 1.0 if row[0] < 2 else float(grid[int(np.argmin(row[1:]))])


def code_column(batch) -> list[np.ndarray]:
    return [np.frombuffer(c, CODES).astype(np.int32).reshape(-1, 3) for c in batch["codes"]]


def improved(rows: DataFrame, state: State, shards: int) -> State:
    """One pass of every shard over its rows from the same state, and the mean of what comes out.

    A shard is a stream of batches in one task; blocks of the parameters are averaged by
    Spark, so the driver sees one set of them.
    """
    flat = packed(state)
    size = -(-len(flat) // BLOCKS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, shard, count = unpacked(flat), None, 0
        for batch in batches:
            codes, y = code_column(batch), batch["label"].to_numpy(np.float64)
            shard, count = int(batch["shard"].iloc[0]), count + len(y)
            for at in np.array_split(np.arange(len(y)), max(1, len(y) // 32)):
                learn(own, [codes[i] for i in at], y[at])
        if shard is not None:
            out = packed(own)
            for i in range(BLOCKS):
                yield pd.DataFrame({"shard": [shard], "rows": [count], "block": [i], "values": [out[i * size:(i + 1) * size].tobytes()]})

    def mean(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("shard")
        total = sum(np.frombuffer(v, np.float32) * np.float64(n) for v, n in zip(group["values"], group["rows"]))
        return pd.DataFrame({"block": [int(group["block"].iloc[0])], "values": [(total / group["rows"].sum()).astype(np.float32).tobytes()]})

    dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", F.xxhash64("id", F.lit(1)), "id", F.xxhash64("codes"))
    learned = dealt.select("shard", "label", "codes").mapInPandas(run, "shard int, rows long, block int, values binary")
    blocks = learned.groupBy("block").applyInPandas(mean, "block int, values binary").collect()
    return unpacked(np.concatenate([np.frombuffer(b["values"], np.float32) for b in sorted(blocks, key=lambda b: b["block"])]))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        warm: int = WARM, shard: int = SHARD, rounds: int = ROUNDS) -> Model | None:
    """None without labels of both kinds in the training folds.

    All labelled documents of these folds are learned from, whole. One task trains on about
    ``warm`` of them first, so that what is averaged afterwards starts alike; if there are
    more, all go through ``rounds`` passes of shards. A seventh is held back for temperature
    and thresholds, all of which count.
    """
    held = fold_of(F.col(key), FOLDS) == HELD_OUT

    def flat():
        encode = encoder()
        return lambda value: encode(value).ravel()

    coded, share = labelled.all_codes(docs, labels, "toxic", held, flat, CODES, key, text)
    spot = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(100))
    known = coded.agg(F.count("*").alias("n"), F.sum("label").alias("ones"), F.count_if(spot >= 15).alias("kept"),
                      F.count_distinct(F.when(spot >= 15, F.col("label"))).alias("kinds")).first()
    if not 0 < (known.ones or 0) < known.n:
        return None
    rows = coded if known.kinds < 2 else coded.where(spot >= 15)  # too few to hold some back
    count = known.n if known.kinds < 2 else known.kept

    def first(group: pd.DataFrame) -> pd.DataFrame:
        state = warmed(code_column(group), group["label"].to_numpy(np.float64))
        return pd.DataFrame({"values": [packed(state).tobytes()]})

    some = rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(-(-count // warm))) == 0) if count > warm else rows
    begun = some.select("label", "codes", F.xxhash64("id", F.lit(1)).alias("h"), "id").groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda g: first(g.sort_values(["h", "id", "codes"])), "values binary").first()
    state = unpacked(np.frombuffer(begun["values"], np.float32)) if begun else fresh()
    if count > warm:
        shards = -(-count // shard)
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(shards)).cast("int"))
        for _ in range(rounds):
            state = improved(dealt, state, shards)
    parts = parts_of(state)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"label": batch["label"], "lang": batch["lang"], "raw": logits(parts, code_column(batch)).astype(np.float64)})

    raw = saved(coded.where(spot < 15).select("label", "lang", "codes").mapInPandas(judge, "label int, lang string, raw double"), "held-back")
    heat, shift = best_temperature(raw), labelled.prior_shift(np.array([known.ones / known.n]), share)
    score = 1 / (1 + F.exp(-(F.col("raw") / heat + shift)))
    return Model(*parts, heat, shift, language_thresholds(raw.withColumn("score", score)))


def scorer(model: Model | None):
    def make():
        encode = encoder()

        def judge(texts: list[str]) -> np.ndarray:
            if model is None:
                return np.zeros(len(texts))
            out = []
            for run in by_bytes(texts, 1 << 20):
                raw = logits(model[:5], [encode(t) for t in run])
                out.append(labelled.sigmoid(raw / model.temperature + model.shift))
            return np.concatenate(out).astype(np.float64) if out else np.zeros(0)

        return judge

    return make


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted, lang, flagged): flagged by the language's own threshold."""
    held = fold_of(F.col(key), FOLDS) == HELD_OUT
    model = fit(docs, labels, key, text)
    cut = F.lit(0.3)
    for lang, value in (model.thresholds if model else {}).items():
        cut = F.when(F.col("lang") == lang, value).otherwise(cut)
    return labelled.scored(docs, held, scorer(model), key, text).withColumn("flagged", F.col("score") >= cut)
