"""Connected components of a link table, and of the links that one task has found."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellbulk.session import discard, saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b); component is the smallest id.

    Each round hooks every vertex to its smallest neighbour if that is smaller, follows
    the parents to their root by repeated doubling and contracts the graph to the
    roots, so at least half of the vertices that still have links vanish. All steps are
    joins and minima of two columns; a vertex with many links is combined before the
    shuffle. Links to itself or to null do nothing; an empty table gives an empty one.
    """
    ordered = edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    current, members = saved(ordered.distinct(), "links"), None
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("_low")).select(
            "id", F.least("id", "_low").alias("root"))
        roots = _roots(saved(parents, "parents"))
        a, b = (roots.select(F.col("id").alias(c), F.col("root").alias(f"{c}_root")) for c in "ab")
        left = current.join(a, "a").join(b, "b").where("a_root != b_root").select(
            F.least("a_root", "b_root").alias("a"), F.greatest("a_root", "b_root").alias("b")).distinct()
        rest = saved(left, "links")
        if members is None:
            moved = roots.select("id", F.col("root").alias("component"))
        else:
            step = roots.withColumnsRenamed({"id": "component"})
            moved = saved(members.join(step, "component", "left").select(
                "id", F.coalesce("root", "component").alias("component")), "members")
            discard(roots)
            discard(members)
        discard(current)
        current, members = rest, moved
    return members if members is not None else current.select(
        F.col("a").alias("id"), F.col("b").alias("component"))


def _roots(parents: DataFrame) -> DataFrame:
    """Follow parents to the top: every pass doubles the distance a pointer spans."""
    while True:
        up = parents.select(F.col("id").alias("root"), F.col("root").alias("top"))
        jumped = saved(parents.join(up, "root").select(
            "id", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "parents")
        discard(parents)
        parents = jumped.select("id", "root")
        if jumped.where("moved").isEmpty():
            return parents


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking rows ``a`` with rows ``b``; a label is the smallest row reached."""
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while (label[label] != label).any():
            label = label[label]
