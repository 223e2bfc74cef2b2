"""Hard negatives of anchor vectors, by exact integer inner products of tiles.

Components become ``floor(scale * x)``. Rows are dealt into slices of bounded size; a
tile is a slice of anchors with a slice of candidates, multiplied by Strassen's scheme.
Two rounds run over tiles:

1. anchors with candidates of their own label: the best ``positives`` rows of each anchor;
2. anchors, which now carry the windows of their positives, with all candidates: the best
   ``negatives`` rows of another label inside each window.

A tile keeps a heap of that many rows for each anchor, or anchor and positive. Heaps merge
by a ranked window, whose limit Spark applies in every map task before it shuffles.

Defined results: rows with a null id, label or vector, or with a null or non-finite
component take no part. Of rows that repeat an id the one with the smallest (label, vector)
counts, so exact repeats count once. Ties go to the smaller id. Vectors of different
lengths do not meet; empty ones score 0. Components whose products could pass 62 bits are
refused with an error, never wrapped around. An empty table, or one without anchors, gives
no rows. Extra columns are ignored.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellbulk.llm.strassen import product
from cellbulk.session import saved

ANCHOR_ROWS, CANDIDATE_ROWS, STRIP = 4096, 8192, 256
LOWEST = np.iinfo(np.int64).min


def integer_vectors(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(id long, label long, anchor boolean, dim int, vector binary: little-endian int32) of
    rows (id, label, anchor, vector array<double>)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = [np.floor(scale * np.asarray(v, np.float64)) for v in batch["vector"]]
            for key, v in zip(batch["id"], whole):
                if len(v) and np.abs(v).max() * np.sqrt(len(v)) >= 1 << 27:
                    raise ValueError(f"components of vector {key} are too large for exact 64-bit scores")
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "anchor": batch["anchor"],
                                "dim": [len(v) for v in whole],
                                "vector": [v.astype("<i4").tobytes() for v in whole]})

    return rows.select("id", "label", "anchor", "vector").mapInPandas(
        run, "id long, label long, anchor boolean, dim int, vector binary")


def best(scores: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``count`` largest entries of every row, of equal ones the first;
    entries at the lowest integer are no candidates."""
    if scores.shape[1] > count:
        least = np.partition(scores, -count, axis=1)[:, -count]
        row, column = np.nonzero((scores >= least[:, None]) & (scores > LOWEST))
    else:
        row, column = np.nonzero(scores > LOWEST)
    order = np.lexsort((column, -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    inside = np.arange(len(row)) - first[row] < count
    return row[inside], column[inside]


def matrix(vectors: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), "<i4").reshape(len(vectors), dim).astype(np.int64)


def tiles(anchors: DataFrame, candidates: DataFrame, keys: list[str], carried: str) -> DataFrame:
    """Both sides dealt to tiles and united: (keys, i, j, side, id, label, vector, carried).

    Slices are counted by ``keys`` with Spark, and the ids' hash picks the slice, so every
    slice has about the same number of rows, whichever key is hot.
    """
    def slices(rows: DataFrame, size: int, name: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias(name))

    counts = saved(slices(anchors, ANCHOR_ROWS, "down").join(
        slices(candidates, CANDIDATE_ROWS, "across"), keys), "slices")

    def dealt(rows: DataFrame, side: bool, own: str, other: str, places: str, copies: str) -> DataFrame:
        spot = F.pmod(F.xxhash64(F.lit(places), "id"), F.col(own)).cast("int")
        return rows.join(counts, keys).select(
            *(k for k in keys if k != "label"), spot.alias(places), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(copies),
            F.lit(side).alias("side"), "id", "label", "vector",
            F.col(carried).alias("carried") if side else F.lit(None).cast("array<long>").alias("carried"))

    return dealt(anchors, True, "down", "across", "i", "j").unionByName(
        dealt(candidates, False, "across", "down", "j", "i"))


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame, int]:
    """Anchors and candidates of a tile by ascending id, and the length of their vectors."""
    group = group.sort_values("id", kind="stable")
    side = group["side"].to_numpy(bool)
    return group[side], group[~side], int(group["dim"].iloc[0])


def same_label(group: pd.DataFrame, count: int) -> pd.DataFrame:
    """The best ``count`` other rows for each anchor of a tile of one label."""
    left, right, dim = _sides(group)
    ids, other = left["id"].to_numpy(np.int64), right["id"].to_numpy(np.int64)
    turned, found = matrix(right["vector"], dim).T, []
    for start in range(0, len(left), STRIP):
        part = ids[start:start + STRIP]
        scores = product(matrix(left["vector"].iloc[start:start + STRIP], dim), turned)
        scores[part[:, None] == other[None, :]] = LOWEST
        row, column = best(scores, count)
        found.append(pd.DataFrame({"anchor_id": part[row], "id": other[column], "score": scores[row, column]}))
    return pd.concat(found) if found else pd.DataFrame({"anchor_id": [], "id": [], "score": []}, dtype=np.int64)


def inside_windows(group: pd.DataFrame, count: int, low: int, high: int) -> pd.DataFrame:
    """The best ``count`` rows of another label in each positive's window, for each anchor of a tile."""
    left, right, dim = _sides(group)
    ids, other = left["id"].to_numpy(np.int64), right["id"].to_numpy(np.int64)
    labels, others = left["label"].to_numpy(np.int64), right["label"].to_numpy(np.int64)
    turned, found = matrix(right["vector"], dim).T, []
    for start in range(0, len(left), STRIP):
        cut = slice(start, start + STRIP)
        part, windows = ids[cut], left["carried"].iloc[cut].tolist()
        scores = product(matrix(left["vector"].iloc[cut], dim), turned)
        scores[labels[cut, None] == others[None, :]] = LOWEST
        for place in range(max((len(w) for w in windows), default=0)):
            at = np.array([i for i, w in enumerate(windows) if len(w) > place])
            wanted = np.array([windows[i][place] for i in at], np.int64)
            least, most = -(-wanted * low // 100), wanted * high // 100
            at, least, most = at[least <= most], least[least <= most], most[least <= most]
            some = scores[at]
            some[(some < least[:, None]) | (some > most[:, None])] = LOWEST
            row, column = best(some, count)
            found.append(pd.DataFrame({"anchor_id": part[at[row]], "place": place, "id": other[column],
                                       "score": some[row, column]}))
    return pd.concat(found) if found else pd.DataFrame({n: [] for n in ("anchor_id", "place", "id", "score")}, dtype=np.int64)


def merged(heaps: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The best ``count`` rows of all heaps of a key, with their rank from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(rows: DataFrame, anchor: Column, label: Column, key: str = "vec_id", vector: str = "embedding",
                   scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each
    anchor and each of its best ``positives`` rows of its label, the best ``negatives`` rows
    of another label that score between ``low`` and ``high`` per cent of the positive.
    """
    values = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    taken = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"),
                        anchor.alias("anchor"), F.when(fine, values).alias("vector")).dropna(subset=["id", "label", "vector"])
    one = taken.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("row")).select("id", "row.*")
    whole = saved(integer_vectors(one, scale), "integer-vectors")
    anchors = whole.where("anchor")

    pairs = tiles(anchors.withColumn("windows", F.array().cast("array<long>")), whole, ["dim", "label"], "windows")
    near = saved(merged(pairs.groupBy("dim", "label", "i", "j").applyInPandas(
        lambda group: same_label(group, positives), "anchor_id long, id long, score long"), ["anchor_id"], positives), "positives")
    windows = near.groupBy(F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(
        F.struct("rank", "score"))).alias("best")).select("id", F.col("best.score").alias("windows"))

    pairs = tiles(anchors.join(windows, "id"), whole, ["dim"], "windows")
    far = merged(pairs.groupBy("dim", "i", "j").applyInPandas(
        lambda group: inside_windows(group, negatives, low, high), "anchor_id long, place int, id long, score long"),
        ["anchor_id", "place"], negatives)
    return far.select("anchor_id", (F.col("place") + 1).alias("place"), "rank", F.col("id").alias("negative_id"),
                      F.col("score").alias("negative_score")).join(
        near.select("anchor_id", F.col("rank").alias("place"), F.col("id").alias("positive_id"),
                    F.col("score").alias("positive_score")), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
