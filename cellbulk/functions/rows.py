"""Turning one row into several."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unfold(names: Sequence[str], *rows: Sequence[Column | int | str | bool | None]) -> Column:
    """Generator that emits one output row per entry of ``rows``, under ``names``."""
    def cell(value):
        return value if isinstance(value, Column) else F.lit(value)

    return F.inline(F.array(*[
        F.struct(*[cell(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]))


def slot_rows(lists: DataFrame) -> DataFrame:
    """Lists ``slots`` and ``n`` as a row per slot (slot, n); other columns stay."""
    keys = [c for c in lists.columns if c not in ("slots", "n")]
    return lists.select(*keys, "n", F.posexplode("slots").alias("_i", "slot")).select(
        *keys, F.col("slot").cast("long").alias("slot"), F.coalesce(F.get("n", "_i"), F.lit(0)).alias("n"))
