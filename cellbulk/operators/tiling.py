"""Running computations over long ordered groups without one task per group.

A window over a whole contig, or over every value of a metric, would put that
group into one task. Here each group is cut into tiles that are already ordered
among themselves. One exchange on (group, tile) feeds a window inside every tile
and a one-row summary per tile; a second, small window runs over the summaries
and its result is joined back to the tile.
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ColumnFn = Callable[[WindowSpec], Column]


def spread_by_tile(rows: DataFrame, keys: Sequence[str], tile: str, parts: int | None = None) -> DataFrame:
    """One exchange on (keys, tile), meant to be read by two branches of a plan.

    The join of the branches would infer IS NOT NULL on one of them only and push
    it below the exchange, which could then not be reused. Stated here, the test
    is the same for both. Rows without key or coordinate have no tile; plans refuse
    them at the scan (``checks.complete``), so none is lost here.
    """
    present = F.lit(True)
    for name in (*keys, tile):
        present = present & F.col(name).isNotNull()
    return rows.where(present).repartition(*([parts] if parts else []), tile, *keys)


def with_tile_state(
    rows: DataFrame,
    keys: Sequence[str],
    tile: str,
    order: Sequence[str | Column],
    inside: Mapping[str, ColumnFn],
    summary: Mapping[str, Column],
    across: Mapping[str, ColumnFn],
    placed: bool = False,
) -> DataFrame:
    """Add window columns computed inside tiles and state carried between tiles.

    ``inside`` columns see the rows of one tile in ``order``. ``summary``
    aggregates a tile to one row; ``across`` columns see those rows in tile order
    within ``keys``. Key and tile columns must not be NULL. ``placed`` says that
    the rows already come from ``spread_by_tile``.
    """
    parted = rows if placed else spread_by_tile(rows, keys, tile)
    # The tile leads: sorting compares the first key by its leading bytes, which
    # tell tile numbers apart but rarely names.
    in_tile = Window.partitionBy(tile, *keys).orderBy(*order)
    local = parted.select("*", *[fn(in_tile).alias(name) for name, fn in inside.items()])
    over_tiles = Window.partitionBy(*keys).orderBy(tile)
    state = (
        parted.groupBy(tile, *keys)
        .agg(*[agg.alias(name) for name, agg in summary.items()])
        .select(*keys, tile, *[fn(over_tiles).alias(name) for name, fn in across.items()])
    )
    return local.join(state, [tile, *keys])


def up_to_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def running_total(
    rows: DataFrame, keys: Sequence[str], tile: str, order: Sequence[str | Column],
    value: str, out: str,
) -> DataFrame:
    """Inclusive prefix sum of ``value`` along tile, then order."""
    return (
        with_tile_state(
            rows, keys, tile, order,
            inside={"_in": lambda w: F.sum(value).over(up_to_here(w))},
            summary={"_sum": F.sum(value)},
            across={"_before": lambda w: F.sum("_sum").over(before_here(w))},
        )
        .withColumn(out, F.col("_in") + F.coalesce("_before", F.lit(0)))
        .drop("_in", "_before")
    )
