"""Exact Hamming self-join of 64-bit fingerprints over vantage-point trees.

The top of the tree is grown from a bounded sample of fingerprints: a node holds a
vantage fingerprint and the median distance to it. Every fingerprint has one home leaf
and is also sent to those later leaves whose border lies within the search radius of
it, by the triangle inequality, so each pair meets in exactly one leaf. A leaf is one
group; inside it a further vantage point prunes by the same bound.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from cellbulk.llm.common import smallest_by_hash
from cellbulk.llm.components import merge

LEAF_ROWS, SAMPLE, PER_LEAF = 1024, 32_768, 32


def grow(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage and radius of the inner nodes 1 .. 2**depth - 1; children of i are 2i, 2i+1."""
    vantage, radius = np.zeros(1 << depth, np.uint64), np.full(1 << depth, 32, np.int64)
    held = {1: sample}
    for node in range(1, 1 << depth):
        own = held.pop(node, sample[:0])
        if len(own):
            # of a few members take the one that spreads the others most
            tried = own[:: max(1, len(own) // 8)][:8]
            apart = np.bitwise_count(own[None, :] ^ tried[:, None]).astype(np.int64)
            best = int(np.argmax(apart.var(axis=1)))
            vantage[node], radius[node] = tried[best], int(np.median(apart[best]))
            near = apart[best] <= radius[node]
            held[2 * node], held[2 * node + 1] = own[near], own[~near]
    return vantage, radius


def route(fps: np.ndarray, vantage: np.ndarray, radius: np.ndarray, depth: int,
          reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(home leaf of each, rows that visit, leaves visited): only leaves after the home."""
    home = np.ones(len(fps), np.int64)
    rows, nodes = np.arange(len(fps)), np.ones(len(fps), np.int64)
    for _ in range(depth):
        home = 2 * home + (np.bitwise_count(fps ^ vantage[home]) > radius[home])
        apart = np.bitwise_count(fps[rows] ^ vantage[nodes]).astype(np.int64)
        near, far = apart - reach <= radius[nodes], apart + reach > radius[nodes]
        rows, nodes = (np.concatenate([rows[near], rows[far]]),
                       np.concatenate([2 * nodes[near], 2 * nodes[far] + 1]))
    later = nodes > home[rows]
    return home - (1 << depth), rows[later], nodes[later] - (1 << depth)


def leaf_forest(fps: np.ndarray, at_home: np.ndarray, reach: int) -> np.ndarray:
    """For each row the smallest row that the links found in this leaf lead to.

    Links are sought among home rows and between home rows and visitors.
    """
    label = np.arange(len(fps))
    homes = np.flatnonzero(at_home)
    if not len(homes):
        return label
    apart = np.bitwise_count(fps ^ fps[homes[0]]).astype(np.int64)
    homes = homes[np.argsort(apart[homes], kind="stable")]
    steps = apart[homes]
    for distance in np.unique(apart):
        seekers = np.flatnonzero(apart == distance)
        within = homes[np.searchsorted(steps, distance - reach):np.searchsorted(steps, distance + reach, "right")]
        width = max(1, (1 << 21) // max(1, len(within)))
        for start in range(0, len(seekers), width):
            own = seekers[start:start + width]
            a, b = np.nonzero(np.bitwise_count(fps[own][:, None] ^ fps[within][None, :]) <= reach)
            label = merge(label, own[a], within[b])
    return label


def hamming_links(items: DataFrame, reach: int = 2, leaf_rows: int = LEAF_ROWS,
                  sample: int = SAMPLE) -> DataFrame:
    """Links (a, b) that join the same items as all pairs within ``reach`` bits would.

    ``items`` has distinct (id long, fp long). In each leaf the pairs found are reduced
    to a spanning forest, so the result has at most one row per row of a leaf.
    """
    count = items.count()
    depth = max(0, math.ceil(math.log2(max(1, count / leaf_rows))))
    depth = min(depth, int(math.log2(max(1, sample // PER_LEAF))))
    chosen = smallest_by_hash(items.select("fp"), ["fp"], sample if depth else 0, count).toPandas()
    vantage, radius = grow(chosen["fp"].to_numpy(np.int64).view(np.uint64), depth)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64)
            ids = batch["id"].to_numpy(np.int64)
            home, rows, leaves = route(fps.view(np.uint64), vantage, radius, depth, reach)
            yield pd.DataFrame({
                "leaf": np.concatenate([home, leaves]), "id": np.concatenate([ids, ids[rows]]),
                "fp": np.concatenate([fps, fps[rows]]),
                "home": np.arange(len(fps) + len(rows)) < len(fps)})

    def search(leaf: pd.DataFrame) -> pd.DataFrame:
        leaf = leaf.sort_values("id")
        ids = leaf["id"].to_numpy(np.int64)
        label = leaf_forest(leaf["fp"].to_numpy(np.int64).view(np.uint64), leaf["home"].to_numpy(bool), reach)
        linked = label != np.arange(len(ids))
        return pd.DataFrame({"a": ids[label[linked]], "b": ids[linked]})

    sent = items.select("id", "fp").mapInPandas(send, "leaf long, id long, fp long, home boolean")
    return sent.groupBy("leaf").applyInPandas(search, "a long, b long")
