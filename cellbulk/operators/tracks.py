"""Signal tracks: depth of intervals, and several tracks on common segments.

A track is a table of non-overlapping runs (keys, start, end, value).
"""

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cellbulk import constants as C
from cellbulk.functions import depths
from cellbulk.functions.genomics import slice_of
from cellbulk.functions.rows import unfold
from cellbulk.operators.tiling import (
    before_here,
    spread_by_tile,
    up_to_here,
    with_tile_state,
)
from cellbulk.session import saved


def coverage(
    intervals: DataFrame, start: str, end: str, keys: Sequence[str] = ("contig",),
    weights: Mapping[str, Column] | None = None, tile: int = C.TILE, distinct: bool = False,
) -> DataFrame:
    """Runs (keys, start, end) of constant depth, where some depth is above zero.

    ``weights`` names one depth per kind of interval; an interval adds its weight
    to each. Starts and ends are first summed per position, so a pile-up shrinks
    to one row before anything is ordered; a depth is the running total of those
    sums. All depths come from one pass and share their runs.

    ``distinct`` promises that only a few intervals share a position, as after an
    aggregation by position. A tile is then small however deep the pile-up, so
    rows go to their tile at once and are summed there, which saves a shuffle.
    """
    weights = weights or {"depth": F.lit(1)}
    names = list(weights)
    edges = intervals.select(
        *keys, F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end"),
        *[w.cast("long").alias(n) for n, w in weights.items()],
    ).select(
        *keys,
        unfold(["start", *names],
               [F.col("start"), *[F.col(n) for n in names]],
               [F.col("end"), *[-F.col(n) for n in names]]),
    )
    in_tile = edges.withColumn("_tile", slice_of(F.col("start"), tile))
    if distinct:
        in_tile = spread_by_tile(in_tile, keys, "_tile")
    changes = in_tile.groupBy("_tile", *keys, "start").agg(
        *[F.sum(n).alias(n) for n in names]
    ).where(F.greatest(*[F.abs(n) for n in names], F.lit(0)) > 0)

    def running(name: str):
        return lambda w: F.sum(name).over(up_to_here(w))

    def carried(name: str):
        return lambda w: F.sum(f"_sum_{name}").over(before_here(w))

    state = with_tile_state(
        changes, keys, "_tile", ["start"],
        inside={**{f"_in_{n}": running(n) for n in names},
                "_next": lambda w: F.lead("start").over(w)},
        summary={**{f"_sum_{n}": F.sum(n) for n in names}, "_first": F.min("start")},
        across={**{f"_before_{n}": carried(n) for n in names},
                "_next_tile": lambda w: F.lead("_first").over(w)},
        placed=distinct,
    )
    return state.select(
        *keys, "start", F.coalesce("_next", "_next_tile").alias("end"),
        *[(F.col(f"_in_{n}") + F.coalesce(f"_before_{n}", F.lit(0))).alias(n) for n in names],
    ).where(F.greatest(*names, F.lit(0)) > 0)


def window_depths(points: DataFrame, position: str, weight: str, widths: Mapping[str, int],
                  keys: Sequence[str] = ("contig",), clip: bool = True, tile: int = C.POINT_TILE,
                  carry: Sequence[str] = (), derive: depths.Derive | None = None,
                  values: T.StructType | None = None, ahead: int = 0, order: Sequence[str] = ()) -> DataFrame:
    """``coverage`` of windows around points: runs (keys, start, end, a depth per width).

    ``widths`` names the depths; a point adds its weight to each over that many bases around
    it, from 0 on if ``clip``. What is shuffled is a row per point and not one per edge of a
    window: a point goes to the tiles its widest window reaches, which are seldom two, and a
    tile works out its runs alone. Only the run at the end of a tile needs to know where the
    next change is; these are a row per tile, made from the same exchange. Few points may
    share a position, as after an aggregation by position; a tile is then small.

    ``derive`` (see ``depths.in_slice``) may make other columns, which ``values`` names, in the
    same call; ``carry`` are columns of the points it needs that follow from the keys.

    ``ahead`` promises what ``runs_end_near`` found: a run that leaves its tile ends within so
    many bases behind it. Tiles then see these bases too and need no second pass. ``order`` is
    as in ``_by_number``.
    """
    values = values or T.StructType([T.StructField(n, T.LongType()) for n in widths])
    if ahead:
        schema = _runs_schema(points, keys, values)
        placed = _by_number(_points_by_tile(points, position, weight, max(widths.values()), keys, clip, tile,
                                            carry, ahead), keys, order)
        return placed.groupBy("_group").applyInArrow(depths.told_apart(depths.in_slice(
            keys, widths, tile, clip, to_arrow_schema(schema), False, carry, derive, ahead), ["_tile", *keys]), schema)
    spread = spread_by_tile(_points_by_tile(
        points, position, weight, max(widths.values()), keys, clip, tile, carry), keys, "_tile", _parts(points))

    def tiles(edge: bool, *columns: T.StructField) -> DataFrame:
        schema = T.StructType([*[points.schema[k] for k in keys], *columns, *values.fields])
        return spread.groupBy("_tile", *keys).applyInArrow(depths.in_slice(
            keys, widths, tile, clip, to_arrow_schema(schema), edge, carry, derive), schema)

    def long(name: str) -> T.StructField:
        return T.StructField(name, T.LongType())

    inner = tiles(False, long("start"), long("end"))
    last = tiles(True, long("_tile"), long("_first"), T.StructField("_on", T.BooleanType()), long("start"))
    closed = last.withColumn("end", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_tile")))
    return inner.unionByName(closed.where("_on").select(*inner.columns))


def shared_depths(points: DataFrame, position: str, weight: str, by: str, names: Sequence[str],
                  widths: Mapping[str, int], keys: Sequence[str], ahead: int, derive: Callable, values: T.StructType,
                  limit: Column, carry: Sequence[str] = (), clip: bool = True, tile: int = C.POINT_TILE,
                  order: Sequence[str] = ()) -> DataFrame:
    """What ``overlay`` makes of the ``window_depths`` of the sets named in column ``by`` and of
    all points together, without their runs: only points are shuffled, once.

    A segment is covered by a run of each of them that ends no later than ``limit``, if that is
    not NULL. ``derive`` (see ``depths.shared_in_slice``) makes its ``values``. ``ahead`` is what
    ``runs_end_near`` promises for every set and for all points together.
    """
    known = points.where(F.col(by).isin(*names)).withColumn("_by", F.col(by)).withColumn("_limit", limit.cast("long"))
    schema = _runs_schema(points, keys, values)
    placed = _by_number(_points_by_tile(known, position, weight, max(widths.values()), keys, clip, tile,
                                        ["_by", "_limit", *carry], ahead), keys, order)
    return placed.groupBy("_group").applyInArrow(depths.told_apart(depths.shared_in_slice(
        keys, names, widths, tile, clip, ahead, to_arrow_schema(schema), carry, derive), ["_tile", *keys]), schema)


def runs_end_near(points: DataFrame, position: str, weight: str, widths: Mapping[str, int],
                  keys: Sequence[str] = ("contig",), clip: bool = True, tile: int = C.POINT_TILE,
                  ahead: int | None = None) -> int:
    """``ahead``, if no run that leaves its tile ends so many bases behind it or farther, else 0.

    By default that is the widest of ``widths``: a run is longer only where points repeat in
    steps that suit all widths. One pass over the points, of which those near the borders of
    tiles are shuffled.
    """
    wide = max(widths.values())
    ahead = ahead or wide
    at = F.col(position).cast("long")
    first, last = slice_of(at - wide - ahead, tile) + 1, slice_of(at + wide, tile)
    near = points.select(*keys, at.alias("_at"), F.col(weight).cast("long").alias("_n"), first.alias("_tile"),
                         last.alias("_last")).where("_tile <= _last").select(
        *keys, "_at", "_n", F.explode(F.sequence("_tile", "_last")).alias("_tile"))
    schema = T.StructType([T.StructField("_tile", T.LongType()), *[points.schema[k] for k in keys]])
    found = near.groupBy("_tile", *keys).applyInArrow(
        depths.open_at_border(keys, widths, tile, clip, ahead, to_arrow_schema(schema)), schema)
    return 0 if found.count() else ahead


def _runs_schema(points: DataFrame, keys: Sequence[str], values: T.StructType) -> T.StructType:
    return T.StructType([*[points.schema[k] for k in keys], T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), *values.fields])


def _by_number(spread: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Points with one number for tile and keys, in one partition each: Spark orders the rows of a
    task by it in a few passes, where it would compare names. Groups may share a number.

    With ``order``, some of the keys and last one that numbers contigs, partitions are ranges: of
    groups that agree in the first ones, contig by contig, tile by tile.
    """
    known = spread.na.drop(subset=["_tile", *keys])
    if not order:
        return known.withColumn("_group", F.xxhash64("_tile", *keys)).repartition(_parts(spread), "_group")
    *leading, rank = order
    places = [(F.xxhash64(*leading), 24, 39), (F.col(rank).cast("long"), 15, 24),
              (F.col("_tile"), 24, 0)]
    number = sum((F.shiftleft(value.bitwiseAND(F.lit((1 << bits) - 1)), by) for value, bits, by in places), F.lit(0))
    return known.withColumn("_group", number).repartitionByRange(_parts(spread), "_group")


def _points_by_tile(points: DataFrame, position: str, weight: str, wide: int, keys: Sequence[str],
                    clip: bool, tile: int, carry: Sequence[str] = (), ahead: int = 0) -> DataFrame:
    """A row (keys, carry, _at, _n, _tile) per point and tile that its window reaches, or that
    ends less than ``ahead`` bases before that."""
    at = F.col(position).cast("long")
    low = at - wide // 2
    first = F.greatest(low - ahead, F.lit(0)) if clip else low - ahead
    reached = F.sequence(slice_of(first, tile), slice_of(low + wide, tile))
    return points.select(*keys, *carry, at.alias("_at"), F.col(weight).cast("long").alias("_n"),
                         F.explode(reached).alias("_tile"))


def _parts(frame: DataFrame) -> int:
    """A row becomes several runs, so the partitions are not packed by the bytes of the rows."""
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def overlay(
    track: DataFrame, by: str, names: Sequence[str], keys: Sequence[str] = ("contig",),
    value: str = "value", cover: str = "all", fill: float | None = None, tile: int = C.TILE,
) -> DataFrame:
    """Spread the tracks named in column ``by`` to columns on their common segments.

    A track becomes the list of its value changes; per position the changes merge
    to one row, and every track's value is carried forward to its next change. No
    track is joined with another. ``cover='all'`` keeps segments every track
    covers; ``'any'`` those at least one covers, with ``fill`` for the rest.
    """
    if cover not in ("all", "any"):
        raise ValueError(f"cover must be 'all' or 'any', not {cover!r}")
    # A run is shuffled once for every tile that holds one of its ends, seldom two, and
    # becomes events there. Runs of a track do not overlap, so a tile holds at most two
    # events per base and track. A run may end where the next begins; the larger struct,
    # the one that is on, wins.
    runs = track.select(
        *keys, F.col(by).alias("_by"), F.col("start").cast("long").alias("_start"),
        F.col("end").cast("long").alias("_end"), F.col(value).cast("double").alias("_value"))
    ends = F.array_distinct(F.array(slice_of(F.col("_start"), tile), slice_of(F.col("_end"), tile)))
    placed = spread_by_tile(runs.withColumn("_tile", F.explode(ends)), keys, "_tile")
    in_tile = placed.select(
        *keys, "_by", "_tile",
        unfold(["start", "_on", "_value"],
               [F.col("_start"), True, F.col("_value")],
               [F.col("_end"), False, F.lit(None).cast("double")]),
    ).where(slice_of(F.col("start"), tile) == F.col("_tile"))
    changes = in_tile.groupBy("_tile", *keys, "start").agg(*[
        F.max(F.when(F.col("_by") == name, F.struct("_on", "_value"))).alias(f"_c{i}")
        for i, name in enumerate(names)
    ])

    def held(i: int):
        return lambda w: F.last(f"_c{i}", ignorenulls=True).over(up_to_here(w))

    def carried(i: int):
        return lambda w: F.last(f"_l{i}", ignorenulls=True).over(before_here(w))

    def last_change(i: int) -> Column:
        return F.max_by(f"_c{i}", F.when(F.col(f"_c{i}").isNotNull(), F.col("start")))

    every = range(len(names))
    state = with_tile_state(
        changes, keys, "_tile", ["start"],
        inside={**{f"_h{i}": held(i) for i in every},
                "_next": lambda w: F.lead("start").over(w)},
        summary={**{f"_l{i}": last_change(i) for i in every}, "_first": F.min("start")},
        across={**{f"_p{i}": carried(i) for i in every},
                "_next_tile": lambda w: F.lead("_first").over(w)},
        placed=True,
    )
    now = [F.coalesce(f"_h{i}", f"_p{i}") for i in every]
    flat = state.select(
        *keys, "start", F.coalesce("_next", "_next_tile").alias("end"),
        *[F.coalesce(now[i]["_on"], F.lit(False)).alias(f"_on{i}") for i in every],
        *[now[i]["_value"].alias(f"_v{i}") for i in every],
    )
    covered = F.lit(cover == "all")
    for i in every:
        on = F.col(f"_on{i}")
        covered = (covered & on) if cover == "all" else (covered | on)
    return flat.where(covered & F.col("end").isNotNull()).select(
        *keys, "start", "end",
        *[(F.col(f"_v{i}") if fill is None else F.coalesce(f"_v{i}", F.lit(float(fill))))
          .alias(name) for i, name in enumerate(names)],
    )


def overlay_frames(tracks: Mapping[str, DataFrame], keys: Sequence[str] = ("contig",),
                   value: str = "value", **options) -> DataFrame:
    """``overlay`` of tracks held in separate tables."""
    stacked = None
    for name, track in tracks.items():
        one = track.select(*keys, "start", "end", value, F.lit(name).alias("_name"))
        stacked = one if stacked is None else stacked.unionByName(one)
    return overlay(stacked, "_name", list(tracks), keys, value, **options)


def number_islands(
    runs: DataFrame, keys: Sequence[str], joins: Callable[[Column, Column], Column],
    tile: int = C.TILE,
) -> DataFrame:
    """Number the maximal chains of ordered, non-overlapping runs from 1.

    ``joins(previous, current)`` tells whether a run continues the chain of its
    predecessor; both are structs of the run's columns. Breaks are counted inside
    a tile first; whether a tile's first run continues the tile before is settled
    on the one-row-per-tile summaries.
    """
    # The whole row, so that both branches ask the exchange for the same columns.
    row = F.struct(*[c for c in runs.columns if c not in keys])
    in_tile = Window.partitionBy("_tile", *keys).orderBy("start")
    local = (
        spread_by_tile(runs.withColumn("_tile", slice_of(F.col("start"), tile)), keys, "_tile")
        .withColumn("_prev", F.lag(row).over(in_tile))
        .withColumn("_new", F.when(F.col("_prev").isNull() | joins(F.col("_prev"), row), 0)
                    .otherwise(1))
        .withColumn("_in", F.sum("_new").over(up_to_here(in_tile)))
    )
    over_tiles = Window.partitionBy(*keys).orderBy("_tile")
    before = F.col("_before")
    state = (
        local.groupBy("_tile", *keys)
        .agg(F.sum("_new").alias("_sum"), F.min_by(row, "start").alias("_first"),
             F.max_by(row, "start").alias("_last"))
        .withColumn("_before", F.lag("_last").over(over_tiles))
        .withColumn("_edge", F.when(before.isNotNull() & joins(before, F.col("_first")), 0)
                    .otherwise(1))
        .withColumn("_base", F.sum(F.col("_sum") + F.col("_edge")).over(up_to_here(over_tiles))
                    - F.col("_sum"))
        .select(*keys, "_tile", "_base")
    )
    return local.join(state, ["_tile", *keys]).select(
        *runs.columns, (F.col("_base") + F.col("_in")).alias("island"))


def merge_equal_neighbours(track: DataFrame, values: Sequence[str],
                           keys: Sequence[str] = ("contig",), tile: int = C.TILE) -> DataFrame:
    """Join runs that touch and carry the same values."""

    def same(previous: Column, current: Column) -> Column:
        equal = previous["end"] == current["start"]
        for v in values:
            equal = equal & previous[v].eqNullSafe(current[v])
        return equal

    numbered = number_islands(track, keys, same, tile)
    return numbered.groupBy(*keys, "island").agg(
        F.min("start").alias("start"), F.max("end").alias("end"),
        *[F.first(v).alias(v) for v in values],
    ).drop("island")


def zoom_levels(track: DataFrame, keys: Sequence[str] = ("contig",), value: str = "value",
                finest: int = 6, step: int = 2, levels: int = 10) -> DataFrame:
    """Summaries (keys, level, window, value_sum, min_value, max_value, covered) of a track in
    windows of ``2**level`` bases, for ``levels`` levels from ``finest`` on, ``step`` apart.

    ``value_sum`` and ``covered`` count bases of runs, so their ratio is the mean; windows no
    run covers are absent. Runs are cut at the borders of the finest windows once; all
    coarser windows are sums of finest ones, added up before they are shuffled. A run of any
    length costs one row per finest window it covers.
    """
    at = F.col("_w")
    cut = track.select(*keys, "start", "end", F.col(value).cast("double").alias("_v"), F.explode(F.sequence(
        F.shiftright(F.col("start").cast("long"), finest), F.shiftright(F.col("end").cast("long") - 1, finest))).alias("_w"))
    length = F.least("end", F.shiftleft(at + 1, finest)) - F.greatest("start", F.shiftleft(at, finest))
    base = saved(cut.where("end > start").withColumn("_n", length).groupBy(*keys, "_w").agg(
        F.sum(F.col("_v") * F.col("_n")).alias("value_sum"), F.min("_v").alias("min_value"),
        F.max("_v").alias("max_value"), F.sum("_n").alias("covered")).withColumnRenamed("_w", "window"), "zoom-base")
    return _coarser(base, keys, finest, [finest + i * step for i in range(levels)])


def depth_zooms(points: DataFrame, position: str, weight: str, width: int, keys: Sequence[str] = ("contig",),
                finest: int = 6, step: int = 2, levels: int = 10, clip: bool = True,
                tile: int = C.POINT_TILE) -> DataFrame:
    """What ``zoom_levels`` makes of one of ``window_depths``, without its runs.

    A tile knows its depths alone, so it sums them up to all windows that fit into it, and only
    points are shuffled. Those windows are written once, as windows longer than a tile are sums
    of its longest. ``tile`` is a power of two, no shorter than the finest window.
    """
    if tile & (tile - 1) or tile < 1 << finest:
        raise ValueError(f"tile must be a power of two and hold a window of {1 << finest} bases, not {tile}")
    every = [finest + i * step for i in range(levels)]
    inside = [k for k in every if 1 << k <= tile]
    schema = T.StructType([*[points.schema[k] for k in keys], T.StructField("level", T.IntegerType()),
                           T.StructField("window", T.LongType()), T.StructField("value_sum", T.DoubleType()),
                           T.StructField("min_value", T.DoubleType()), T.StructField("max_value", T.DoubleType()),
                           T.StructField("covered", T.LongType())])
    # One number for tile and keys: Spark orders the rows of a task by it in a few passes, where
    # it would compare names. Groups that share a number are told apart by the function.
    spread = _points_by_tile(points, position, weight, width, keys, clip, tile).na.drop(
        subset=["_tile", *keys]).withColumn("_group", F.xxhash64("_tile", *keys)).repartition(_parts(points), "_group")
    found = spread.groupBy("_group").applyInArrow(
        depths.windows_in_slice(keys, width, tile, clip, inside, to_arrow_schema(schema)), schema)
    if inside == every:
        return found
    found = saved(found, "zooms")
    top = inside[-1]
    return found.unionByName(_coarser(found.where(F.col("level") == top), keys, top, every[len(inside):]))


def _coarser(base: DataFrame, keys: Sequence[str], level: int, coarser: Sequence[int]) -> DataFrame:
    """The windows of coarser levels, as sums of those of one level."""
    places = F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright("_w", k - level).alias("window")) for k in coarser])
    return base.withColumnRenamed("window", "_w").drop("level").select("*", F.inline(places)).groupBy(
        *keys, "level", "window").agg(
        F.sum("value_sum").alias("value_sum"), F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"), F.sum("covered").alias("covered"))


def zoom_view(zooms: DataFrame, start: int, end: int, windows: int, where: Column | None = None) -> DataFrame:
    """The windows that reach into [start, end) at the coarsest stored level that still cuts it
    into ``windows`` pieces, or at the finest there is."""
    chosen = zooms if where is None else zooms.where(where)
    known = sorted(r.level for r in chosen.select("level").distinct().collect())
    level = max((k for k in known if (end - start) >> k >= windows), default=min(known, default=0))
    return chosen.where((F.col("level") == level) & F.col("window").between(start >> level, (end - 1) >> level))
