"""What several corpus operators share: tables, text cleaning, batching of Python work."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def by_bytes(texts: Iterable[str], limit: int = 1 << 18) -> Iterator[list[str]]:
    """Runs of consecutive texts of about ``limit`` characters, so that what a library
    builds for one run stays small; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text) > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text)
    if run:
        yield run


def runs_of(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of consecutive texts that begin within ``limit`` bytes of each other."""
    begin = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))])
    start = 0
    while start < len(texts):
        stop = max(start + 1, int(np.searchsorted(begin[:-1], begin[start] + limit)))
        yield start, stop
        start = stop


def smallest_by_hash(rows: DataFrame, columns: list[str], most: int, count: int) -> DataFrame:
    """The ``most`` rows with the smallest hash of ``columns``, of ``count`` rows or so.

    A threshold on the hash leaves about twice as many rows as wanted before any is
    ordered, so what meets in one task does not grow with the table.
    """
    spot = F.shiftrightunsigned(F.xxhash64(*columns), 24)
    share = 2.0 * most / max(1, count)
    some = rows if share >= 1 else rows.where(spot < int(share * (1 << 40)) + 1)
    return some.orderBy(spot, *columns).limit(most)


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def packed(rows: DataFrame, **columns: Column) -> DataFrame:
    """All columns of ``rows`` in one struct ``row``, next to columns of an operator's own:
    so no name of either can clash with one of the other."""
    return rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
                       *[c.alias(n) for n, c in columns.items()])


def unpacked(frame: DataFrame, columns: Iterable[str], *added: str) -> DataFrame:
    """The packed columns again, followed by ``added``, which take the place of packed
    columns of their name."""
    taken = {n.lower() for n in added}
    return frame.select(*[F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken], *added)
