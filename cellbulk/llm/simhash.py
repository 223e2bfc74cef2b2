"""SimHash fingerprints of whole texts and their near-duplicate classes.

Defined results: a text without words, and so a null or empty one, has fingerprint
zero, which links like any other. Rows that repeat an id belong to one class. A row
without an id has its fingerprint but no component. Extra columns are ignored.
"""

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellbulk.llm.common import text_of
from cellbulk.llm.components import connected_components
from cellbulk.llm.vp_tree import hamming_links
from cellbulk.session import discard, saved

SEED = 42
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str, words: int = 3) -> int:
    """Unsigned fingerprint over the hashes of all word shingles, repeats included."""
    from xxhash import xxh64_intdigest

    found = text.encode("utf-8").lower().split()  # bytes: only ASCII letters and spaces count
    if not found:
        return 0
    shingles = map(b" ".join, zip(*[found[i:] for i in range(words)])) if len(found) >= words else [b" ".join(found)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64)
    parts = hashes.view(np.uint8).reshape(-1, 8)
    set_in = np.concatenate([np.bincount(parts[:, i], minlength=256) @ _BITS for i in range(8)])
    return int(np.packbits(2 * set_in > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long of the same bits."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t, words) for t in batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"id": batch["id"], "fp": fps.view(np.int64)})

    return docs.select(F.col(key).alias("id"), text_of(text).alias("text")).mapInPandas(
        run, f"id {kind}, fp long")


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", text: str = "text",
                           reach: int = 2) -> DataFrame:
    """(key, fingerprint, component_id) per row; the component is its smallest id.

    Equal fingerprints are one item of the search, represented by their smallest id.
    """
    found = saved(fingerprints(docs, key, text), "fingerprints")
    items = saved(found.where("id is not null").groupBy("fp").agg(F.min("id").alias("id")), "items")
    links = saved(hamming_links(items, reach), "fingerprint-links")
    parts = connected_components(links)
    placed = items.join(parts, "id", "left").select(
        "fp", F.coalesce("component", "id").alias("component_id"))
    discard(links)
    return found.join(placed, "fp", "left").select(
        F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` whose id represents its class, each id once; rows without an id
    stay, as nothing can be said of them."""
    classes = near_duplicate_classes(docs, key, text)
    kept = classes.where(F.col(key) == F.col("component_id")).select(key).distinct()
    named = docs.where(F.col(key).isNotNull()).join(kept, key, "left_semi").dropDuplicates([key])
    return named.unionByName(docs.where(F.col(key).isNull())).select(*docs.columns)
