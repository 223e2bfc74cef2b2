"""Bounded samples of labelled documents, and what both text classifiers share.

A classifier is fitted on at most ``per_class`` documents of each label, of up to
``most_bytes`` each, the ones with the smallest hash of their id. The bound is on the
fit alone: every document is scored whole. Labels, language, source and id are no
inputs of a score.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellbulk.llm.common import smallest_by_hash, text_of
from cellbulk.session import saved

PER_CLASS, DOC_BYTES = 3000, 16_384


def training_codes(docs: DataFrame, labels: DataFrame, label: str, held_out: Column,
                   encode: Callable[[], Callable[[str], np.ndarray]], per_class: int = PER_CLASS,
                   most_bytes: int = DOC_BYTES, key: str = "doc_id", text: str = "text") -> tuple[list, np.ndarray, list, float]:
    """(codes per document, label, lang, share of label 1 among all rows of the training folds).

    A repeated id takes its largest label; null labels and ids are left out.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(
        F.max(label).cast("int").alias("_label")).where(~held_out)
    counted = known.agg(F.count("*").alias("n"), F.sum("_label").alias("ones")).first()
    ones, rows_known = counted.ones or 0, counted.n
    chosen = smallest_by_hash(known.where("_label = 1"), [key], 2 * per_class, ones).unionByName(
        smallest_by_hash(known.where("_label = 0"), [key], 2 * per_class, rows_known - ones))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.where(F.octet_length(text_of(text)) <= most_bytes).select(
        key, text_of(text).alias("_text"), lang.alias("_lang")).join(saved(chosen, "labelled"), key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coded = encode()
        for batch in batches:
            yield pd.DataFrame({"id": batch[key].astype("int64"), "label": batch["_label"], "lang": batch["_lang"],
                                "codes": [coded(t).astype("<i4").tobytes() for t in batch["_text"]]})

    found = saved(rows.mapInPandas(run, "id long, label int, lang string, codes binary"), "training")
    own = [F.xxhash64("id"), F.col("id"), F.xxhash64("codes")]
    local = found.where("label = 1").orderBy(*own).limit(per_class).unionByName(
        found.where("label = 0").orderBy(*own).limit(per_class)).toPandas()
    codes = [np.frombuffer(c, "<i4") for c in local["codes"]]
    return codes, local["label"].to_numpy(np.float64), local["lang"].tolist(), ones / max(1, rows_known)


def all_codes(docs: DataFrame, labels: DataFrame, label: str, held_out: Column,
              encode: Callable[[], Callable[[str], np.ndarray]], kind: str, key: str = "doc_id",
              text: str = "text") -> tuple[DataFrame, float]:
    """((id, label, lang, codes) of every labelled document of the training folds, whole; share
    of label 1 among all rows of these folds). A repeated id takes its largest label.

    Codes are stored as numpy's ``kind``. Labels grow with the documents, so they are never
    broadcast; texts of the held-out folds are left out before the shuffle.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(key).agg(
        F.max(label).cast("int").alias("_label")).where(~held_out)
    counted = known.agg(F.count("*").alias("n"), F.sum("_label").alias("ones")).first()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.where(F.col(key).isNotNull() & ~held_out).select(key, text_of(text).alias("_text"), lang.alias("_lang")).join(
        saved(known, "labelled").hint("merge"), key)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coded = encode()
        for batch in batches:
            yield pd.DataFrame({"id": batch[key].astype("int64"), "label": batch["_label"], "lang": batch["_lang"],
                                "codes": [coded(t).astype(kind).tobytes() for t in batch["_text"]]})

    found = saved(rows.mapInPandas(run, "id long, label int, lang string, codes binary"), "training")
    return found, (counted.ones or 0) / max(1, counted.n)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of logits that makes held-back labels likeliest, by a grid search."""
    if len(set(y.tolist())) < 2:
        return 1.0
    grid = np.exp(np.linspace(np.log(0.5), np.log(5.0), 40))
    losses = [-np.mean(np.where(y > 0, np.log(sigmoid(logits / t) + 1e-12), np.log(1 - sigmoid(logits / t) + 1e-12)))
              for t in grid]
    return float(grid[int(np.argmin(losses))])


def prior_shift(y: np.ndarray, share: float) -> float:
    """Log-odds between the share of label 1 in the corpus' labels and in the sample."""
    inside = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    outside = min(max(share, 1e-3), 1 - 1e-3)
    return float(np.log(outside / (1 - outside)) - np.log(inside / (1 - inside)))


def scored(docs: DataFrame, held_out: Column, score: Callable[[], Callable[[list[str]], np.ndarray]],
           key: str = "doc_id", text: str = "text", cut: float = 0.3) -> DataFrame:
    """(key, held_out, score, predicted, lang) of every row, in one pass without a shuffle."""
    kind = docs.schema[key].dataType.simpleString()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = score()
        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "held_out": batch["held_out"], "lang": batch["lang"],
                                "score": judge(batch["text"].tolist())})

    rows = docs.select(F.col(key).alias("key"), held_out.alias("held_out"), lang.alias("lang"),
                       text_of(text).alias("text"))
    found = rows.mapInPandas(run, f"key {kind}, held_out boolean, lang string, score double")
    return found.select(F.col("key").alias(key), "held_out", "score",
                        (F.col("score") >= cut).cast("int").alias("predicted"), "lang")
