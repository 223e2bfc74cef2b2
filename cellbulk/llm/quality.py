"""Quality scores: random-indexing word vectors, pooled, and a two-layer network.

A chunk of text between spaces is a word (its letters and digits, lower-cased) with a
shape (case, digits, punctuation, run lengths cut to three). Both are hashed. Chunks of more
than ``LONG`` characters, and scripts without spaces, are read part by part. Every
bucket has a sparse ternary index vector made from its number; the vector of a bucket
is the sum of the index vectors met around it in the training texts. A document is
pooled to the mean and spread of its word vectors, the mean of its shape vectors and the
likeness of neighbours. The network is trained with numpy; its logits are divided by a
temperature fitted on held-back rows and moved from the sample's to the labels' odds.

Defined results: null and empty texts are scored from an all-zero pool; without labels
of both kinds every score is 0.5; rows with null or repeated ids are scored like others.
"""

import re
import zlib
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellbulk.llm import labelled
from cellbulk.llm.common import by_bytes, fold_of, runs_of

WORDS, SHAPES, DIMS, WINDOW, MEMORY = 1 << 15, 1 << 10, 32, 2, 300_000
FOLDS, HELD_OUT = 5, 0
_RUN = re.compile(r"(.)\1{2,}", re.S)


# Thai to Tibetan, Myanmar, Khmer, kana, Han: scripts that put no spaces between words.
_UNSPACED = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]+")
LONG = 24  # longer chunks are read in parts
_PARTS = re.compile(rf"{_UNSPACED.pattern}|(?:(?!{_UNSPACED.pattern[:-1]})\w){{1,{LONG}}}|[^\w\s]{{1,{LONG}}}")


def _shape(chunk: str) -> str:
    kinds = "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in chunk)
    return _RUN.sub(r"\1\1\1", kinds)


def parts_of(chunk: str) -> list[str]:
    """The chunk itself; a long one, or one in a script without spaces, as its words, runs of
    signs and three letters at a time, so that none of it goes unseen."""
    if len(chunk) <= LONG and not _UNSPACED.search(chunk):
        return [chunk]
    found = []
    for part in _PARTS.findall(chunk):
        found += [part[i:i + 3] for i in range(max(1, len(part) - 2))] if _UNSPACED.match(part) else [part]
    return found or [chunk]


def encoder():
    """Text to one number per chunk or part of one: word bucket and shape bucket in one."""
    known: dict[str, tuple[int, ...]] = {}

    def code(part: str) -> int:
        word = "".join(c for c in part if c.isalnum()).lower()
        return (zlib.crc32(word.encode()) % WORDS) * SHAPES + zlib.crc32(_shape(part).encode()) % SHAPES

    def codes(chunk: str) -> tuple[int, ...]:
        return tuple(map(code, parts_of(chunk)))

    def encode(text: str) -> np.ndarray:
        chunks = text.split()
        fresh = set(chunks).difference(known)
        if len(known) + len(fresh) > MEMORY:
            known.clear()
            fresh = set(chunks)
        known.update((c, codes(c)) for c in fresh if len(c) <= 4 * LONG)
        found = (known[c] if len(c) <= 4 * LONG else codes(c) for c in chunks)
        return np.fromiter(chain.from_iterable(found), np.int32)

    return encode


def index_vectors(count: int, seed: int) -> np.ndarray:
    """Sparse ternary vectors: four of the components are +1 or -1."""
    made = np.zeros((count, DIMS), np.float32)
    rng = np.random.default_rng(seed)
    spots = rng.integers(0, DIMS, (count, 4))
    made[np.arange(count)[:, None], spots] = rng.choice([-1.0, 1.0], (count, 4))
    return made


def context_vectors(streams: list[np.ndarray], count: int, seed: int) -> np.ndarray:
    """Unit sums of the index vectors within WINDOW places, over all streams."""
    index = index_vectors(count, seed)
    total = np.zeros((count, DIMS))
    for step in range(1, WINDOW + 1):
        left = np.concatenate([s[:-step] for s in streams] or [np.zeros(0, np.int64)])
        right = np.concatenate([s[step:] for s in streams] or [np.zeros(0, np.int64)])
        for d in range(DIMS):
            total[:, d] += np.bincount(left, index[right, d], count) + np.bincount(right, index[left, d], count)
    norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
    return (total / np.maximum(norm, 1e-9)).astype(np.float32)


def pooled(codes: list[np.ndarray], words: np.ndarray, shapes: np.ndarray) -> np.ndarray:
    """One row per document; an empty one is all zeros."""
    out = np.zeros((len(codes), 3 * DIMS + 3), np.float32)
    full = [i for i, c in enumerate(codes) if len(c)]
    if not full:
        return out
    stream = np.concatenate([codes[i] for i in full])
    sizes = np.array([len(codes[i]) for i in full])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    vectors = words[stream // SHAPES]
    n = sizes[:, None].astype(np.float32)
    mean = np.add.reduceat(vectors, begin) / n
    spread = np.add.reduceat(vectors * vectors, begin) / n - mean * mean
    forms = np.add.reduceat(shapes[stream % SHAPES], begin) / n
    alike = np.zeros(len(stream), np.float32)
    alike[1:] = np.einsum("ij,ij->i", vectors[1:], vectors[:-1])
    alike[begin] = 0
    same = np.zeros(len(stream), np.float32)
    same[1:] = stream[1:] == stream[:-1]
    same[begin] = 0
    last = np.c_[np.add.reduceat(alike, begin), np.add.reduceat(same, begin)] / n
    out[full] = np.c_[mean, spread, forms, last, np.sqrt((mean * mean).sum(axis=1, keepdims=True))]
    return out


class Model(NamedTuple):
    words: np.ndarray
    shapes: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float]
    temperature: float
    shift: float


def logits(layers, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.maximum(x @ w1 + b1, 0) @ w2 + b2


def train_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, batch: int = 64, rate: float = 0.003,
                  decay: float = 1e-4, seed: int = 3):
    """Two layers by minibatch Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(())]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    step = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            step += 1
            h = np.maximum(x[at] @ params[0] + params[1], 0)
            wrong = (labelled.sigmoid(h @ params[2] + params[3]) - y[at]) / len(at)
            back = np.outer(wrong, params[2]) * (h > 0)
            slopes = [x[at].T @ back + decay * params[0], back.sum(axis=0), h.T @ wrong + decay * params[2], wrong.sum()]
            for i, g in enumerate(slopes):
                m, v = moments[i]
                m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                moments[i] = (m, v)
                params[i] = params[i] - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return tuple(params)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        per_class: int = labelled.PER_CLASS) -> Model | None:
    """None without labels of both kinds in the training folds."""
    held = fold_of(F.col(key), FOLDS) == HELD_OUT
    codes, y, _, share = labelled.training_codes(docs, labels, "quality", held, encoder, per_class, key=key, text=text)
    if len(set(y.tolist())) < 2:
        return None
    words = context_vectors([c // SHAPES for c in codes], WORDS, 1)
    shapes = context_vectors([c % SHAPES for c in codes], SHAPES, 2)
    x = np.concatenate([pooled(codes[i:i + 256], words, shapes) for i in range(0, len(codes), 256)]).astype(np.float64)
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - centre) / scale
    back = np.random.default_rng(5).random(len(y)) < 0.2
    layers = train_network(x[~back], y[~back])
    warm = labelled.temperature(logits(layers, x[back]), y[back])
    return Model(words, shapes, centre, scale, layers, warm, labelled.prior_shift(y, share))


def scorer(model: Model | None):
    def make():
        encode = encoder()

        def judge(texts: list[str]) -> np.ndarray:
            if model is None:
                return np.full(len(texts), 0.5)
            out = []
            for run in by_bytes(texts, 1 << 20):
                x = (pooled([encode(t) for t in run], model.words, model.shapes) - model.centre) / model.scale
                out.append(labelled.sigmoid(logits(model.layers, x) / model.temperature + model.shift))
            return np.concatenate(out) if out else np.zeros(0)

        return judge

    return make


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted, lang) of every row."""
    held = fold_of(F.col(key), FOLDS) == HELD_OUT
    return labelled.scored(docs, held, scorer(fit(docs, labels, key, text)), key, text)


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = 0.3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score of at least ``cut``: whole rows, judged where they are."""
    model = fit(docs, labels, key, text)
    place = docs.columns.index(text)

    def run(batches):
        judge = scorer(model)()
        for whole in batches:
            for batch in (whole.slice(a, b - a) for a, b in runs_of(whole.column(place), 1 << 20)):
                texts = ["" if t is None else t for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(judge(texts) >= cut))

    return docs.mapInArrow(run, docs.schema)
