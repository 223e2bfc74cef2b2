"""Interval joins as equi-joins on genome bins.

A bare range condition would be planned as a nested loop. Rows are assigned to
bins instead, so Catalyst sees an equality on (keys, bin) plus a residual test.
The smaller side is written first, so whether it is broadcast rests on its measured
size. When it is too large for that, the rows of every bin are counted once, and bins
above a load are split over as many tasks as they need; no other bin is touched.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellbulk import constants as C
from cellbulk.functions.genomics import slice_of
from cellbulk.session import saved, saved_bytes

LAST_CONTIG = (1 << 15) - 1


def broadcast_limit(frame: DataFrame) -> int:
    raw = str(frame.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    text = raw.strip().lower().removesuffix("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(text[-1:], 1)
    return int(text.rstrip("kmg")) * scale


def salted(big: DataFrame, small: DataFrame, salt: int, *identity: Column
           ) -> tuple[DataFrame, DataFrame, list[str]]:
    """Spread every key of ``big`` over ``salt`` tasks and repeat ``small`` for each."""
    if salt <= 1:
        return big, small, []
    return (
        big.withColumn("_salt", F.pmod(F.xxhash64(*identity), F.lit(salt))),
        small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<long>"))),
        ["_salt"],
    )


def heavy_bins(placed: DataFrame, on: Sequence[str], rows: int = C.HEAVY_ROWS,
               most: int = C.HEAVY_BINS) -> DataFrame:
    """(on, _fan) of the bins that hold more than ``rows`` rows, from one count of all bins.

    ``_fan`` is the number of shares of about ``rows`` rows. Where that would name more
    than ``most`` bins, shares are the ``most``-th part of all rows instead, so the table
    stays below ``most`` rows and may be broadcast at any scale.
    """
    total = Observation()
    counted = placed.groupBy(*on).agg(F.count("*").alias("_n")).observe(total, F.sum("_n").alias("n"))
    found = saved(counted.where(F.col("_n") > rows), "heavy-bins")
    share = max(rows, -(-(total.get["n"] or 0) // most))
    return found.where(F.col("_n") > share).select(*on, F.ceil(F.col("_n") / share).alias("_fan"))


def split_by_load(big: DataFrame, small: DataFrame, on: Sequence[str], rows: int,
                  identity: Sequence[Column]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Spread heavy bins of ``big`` over as many tasks as their rows ask for; only there
    rows of ``small`` are repeated. The share of a row follows from its values alone."""
    heavy = heavy_bins(big, on, rows)
    if heavy.isEmpty():
        return big, small, []
    heavy = F.broadcast(heavy)
    fan = F.coalesce("_fan", F.lit(1))
    spread = big.join(heavy, list(on), "left").withColumn("_salt", F.pmod(F.xxhash64(*identity), fan)).drop("_fan")
    repeated = small.join(heavy, list(on), "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), fan - 1))).drop("_fan")
    return spread, repeated, ["_salt"]


def _meeting(big: DataFrame, small: DataFrame, on: Sequence[str], salt: int | None, rows: int,
             identity: Sequence[Column]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join on bins, and the further join column where bins are split.

    The small side is written plain, so the size of its rows is measured; where Catalyst will broadcast it,
    no bin need be split. ``salt`` splits every bin alike instead.
    """
    if salt is not None:
        return salted(big, small, salt, *identity)
    small = saved(small, "bins", plain=True)
    if saved_bytes(small) <= broadcast_limit(small):
        return big, small, []
    return split_by_load(big, small, on, rows, identity)


def never_null(key: Column) -> Column:
    """A join key Catalyst need not test for NULL.

    It would push that test below the projections that compute the key and so
    compute them twice. Rows without coordinates fail the residual test anyway.
    """
    return F.coalesce(key, F.lit(0))


def spread_over_bins(intervals: DataFrame, start: Column, end: Column, width: int,
                     out: str = "_bin") -> DataFrame:
    """One row per bin that [start, end) touches."""
    return intervals.withColumn(
        out, F.explode(F.sequence(slice_of(start, width), slice_of(end - 1, width)))
    )


def points_in_intervals(
    points: DataFrame, position: str, intervals: DataFrame, start: str, end: str,
    keys: Sequence[str], width: int = C.BIN, salt: int | None = None, how: str = "inner",
    heavy_rows: int = C.HEAVY_ROWS,
) -> DataFrame:
    """Join points with the intervals [start, end) that contain them.

    A point has exactly one bin, so a pair appears once; with ``how='left'`` and
    disjoint intervals every point appears exactly once.
    """
    spread = spread_over_bins(intervals, F.col(start), F.col(end), width)
    binned = points.withColumn("_bin", never_null(slice_of(F.col(position), width)))
    left, right, extra = _meeting(binned, spread, [*keys, "_bin"], salt, heavy_rows,
                                  [F.col(c) for c in points.columns])
    link = (*keys, "_bin", *extra)
    right = right.withColumnsRenamed({c: f"_r{c}" for c in link})
    on = [F.col(c) == F.col(f"_r{c}") for c in link]
    inside = (F.col(position) >= F.col(start)) & (F.col(position) < F.col(end))
    return left.join(right, [*on, inside], how).drop(
        "_bin", *extra, *[f"_r{c}" for c in link])


def joined_with_bins(points: DataFrame, position: str, bins: DataFrame, keys: Sequence[str],
                     width: int, heavy_rows: int = C.HEAVY_ROWS) -> DataFrame:
    """Points with the row of ``bins`` (keys, _bin, ...) for their bin, where there is one."""
    binned = points.withColumn("_bin", never_null(slice_of(F.col(position), width)))
    left, right, extra = _meeting(binned, bins, [*keys, "_bin"], None, heavy_rows,
                                  [F.col(c) for c in points.columns])
    return left.join(right, [*keys, "_bin", *extra]).drop("_bin", *extra)


def _residual(a_start: str, a_end: str, min_overlap: float | None) -> Column:
    shared = F.least(a_end, "_b_end") - F.greatest(a_start, "_b_start")
    if min_overlap is None:
        return shared > 0
    return (shared > 0) & (
        (shared >= min_overlap * (F.col(a_end) - F.col(a_start)))
        | (shared >= min_overlap * (F.col("_b_end") - F.col("_b_start")))
    )


def _widths(width: int) -> list[int]:
    """Bin widths for ever longer rows; the last one takes any length."""
    return [width << (3 * level) for level in range(6)] + [1 << 60]


def _level_and_bin(start: Column, length: Column, width: int) -> tuple[Column, Column]:
    widths = _widths(width)
    level = F.lit(0)
    for w in widths[:-1]:
        level = level + (length > w).cast("int")
    chosen = F.get(F.array(*[F.lit(w) for w in widths]), level)
    return never_null(level), never_null(F.floor(start / chosen).cast("long"))


def levels_of(a: DataFrame, a_start: str, a_end: str, width: int = C.BIN) -> list[int]:
    """The levels the rows of ``a`` take; at most one per width. One pass over ``a``."""
    level, _ = _level_and_bin(F.col(a_start), F.col(a_end) - F.col(a_start), width)
    return sorted(r[0] for r in a.select(level.alias("_level")).distinct().collect())


def _partners(b: DataFrame, b_start: str, b_end: str, keys: Sequence[str], width: int,
              merge: bool, levels: Sequence[int] | None = None) -> DataFrame:
    """b in every bin, per level, in which a row reaching it may begin.

    ``levels`` names the levels that occur, where they are known; all are served else.
    """
    used = [(level, w) for level, w in enumerate(_widths(width)) if levels is None or level in levels]
    if not used:
        used = [(0, width)]
    # Rows of a level are longer than the width of the level before: at least two of these.
    cells = F.array(*[F.lit(1 if level == 0 else _widths(width)[level - 1] // 2) for level in range(len(_widths(width)))])
    rows = b.select(*keys, F.col(b_start).alias("_b_start"), F.col(b_end).alias("_b_end")).where(
        "_b_end > _b_start")  # an empty row overlaps nothing
    spans = F.array(*[
        F.struct(
            F.lit(level).alias("_level"), F.lit(w).alias("_width"),
            F.sequence(slice_of(F.col("_b_start") - (w - 1), w),
                       slice_of(F.col("_b_end") - 1, w)).alias("_bins"),
        )
        for level, w in used
    ])
    spread = rows.select("*", F.inline(spans)).select(
        *keys, "_b_start", "_b_end", "_level", "_width", F.explode("_bins").alias("_bin")
    )
    if not merge:
        return spread.drop("_width")
    # For "any overlap" the part of b before its bin is of no use, and of the rows that then
    # begin at one position only the longest is. On the coarser levels a row of a is longer
    # than two cells. What begins in its first cell or before begins left of its end, what
    # begins in its last cell or behind ends right of its start, and anything between meets
    # it: so the first start and the last end of a cell say all. However many b rows pile
    # up, a bin keeps at most its width of them on the finest level and 17 on the others.
    cell = F.get(cells, F.col("_level"))
    return (
        spread.withColumn("_b_start", F.greatest("_b_start", F.col("_bin") * F.col("_width")))
        .withColumn("_cell", F.floor(F.col("_b_start") / cell).cast("long"))
        .groupBy(*keys, "_level", "_bin", "_cell")
        .agg(F.min("_b_start").alias("_b_start"), F.max("_b_end").alias("_b_end")).drop("_cell")
    )


def overlap_filter(
    a: DataFrame, a_start: str, a_end: str, b: DataFrame, b_start: str, b_end: str,
    keys: Sequence[str], how: str = "semi", min_overlap: float | None = None,
    width: int = C.BIN, salt: int | None = None, heavy_rows: int = C.HEAVY_ROWS,
    levels: Sequence[int] | None = None,
) -> DataFrame:
    """Rows of ``a`` that overlap some row of ``b`` (``semi``) or none (``anti``).

    ``min_overlap`` asks for that share of either interval. A row of ``a`` takes
    exactly one bin: that of its start, at the finest level whose bins are no
    shorter than the row. ``b`` is spread to every bin from which such a row
    reaches it. So ``a`` is read once and never copied, neither kind needs a
    deduplication, and rows of any length are handled. ``levels`` is what ``levels_of``
    found for ``a``, if that was asked.
    """
    if how not in ("semi", "anti"):
        raise ValueError(f"how must be 'semi' or 'anti', not {how!r}")
    left, right, on = _level_join(a, a_start, a_end, b, b_start, b_end, keys, min_overlap,
                                  width, salt, heavy_rows, levels)
    link = [F.col(c) == F.col(f"_r{c}") for c in on]
    return left.join(right, [*link, _residual(a_start, a_end, min_overlap)],
                     f"left_{how}").select(*a.columns)


def overlap_flag(
    a: DataFrame, a_start: str, a_end: str, b: DataFrame, b_start: str, b_end: str,
    keys: Sequence[str], out: str, min_overlap: float | None = None, width: int = C.BIN,
    salt: int | None = None, heavy_rows: int = C.HEAVY_ROWS, levels: Sequence[int] | None = None,
) -> DataFrame:
    """All rows of ``a`` with a flag telling whether some row of ``b`` overlaps.

    Planned as one existence join, so ``a`` is read once for both outcomes. ``levels`` is as
    in ``overlap_filter``.
    """
    left, right, on = _level_join(a, a_start, a_end, b, b_start, b_end, keys, min_overlap,
                                  width, salt, heavy_rows, levels)
    # Outer names must not occur below the subquery, where they would bind first.
    outer = left.select(
        *a.columns, *[F.col(c).alias(f"_o{c}") for c in on],
        F.col(a_start).alias("_a_start"), F.col(a_end).alias("_a_end"))
    o_start, o_end = F.col("_a_start").outer(), F.col("_a_end").outer()
    shared = F.least(o_end, F.col("_b_end")) - F.greatest(o_start, F.col("_b_start"))
    test = shared > 0
    if min_overlap is not None:
        test = test & ((shared >= min_overlap * (o_end - o_start))
                       | (shared >= min_overlap * (F.col("_b_end") - F.col("_b_start"))))
    for c in on:
        test = test & (F.col(f"_o{c}").outer() == F.col(f"_r{c}"))
    return outer.select(*a.columns, right.where(test).exists().alias(out))


def _level_join(a, a_start, a_end, b, b_start, b_end, keys, min_overlap, width, salt, heavy_rows, levels=None):
    """Both sides placed on (level, bin, salt), and the names of the join columns."""
    level, slot = _level_and_bin(F.col(a_start), F.col(a_end) - F.col(a_start), width)
    placed = a.withColumn("_level", level).withColumn("_bin", slot)
    near = _partners(b, b_start, b_end, keys, width, min_overlap is None, levels)
    on = [*keys, "_level", "_bin"]
    left, right, extra = _meeting(placed, near, on, salt, heavy_rows, [F.col(c) for c in a.columns])
    on += extra
    return left, right.select(*[F.col(c).alias(f"_r{c}") for c in on], "_b_start", "_b_end"), on


def clip_to_contigs(
    intervals: DataFrame, contig: str, start: str, end: str, sizes: DataFrame,
    mode: str = "drop",
) -> DataFrame:
    """Keep intervals inside their contig: drop offenders, or trim them."""
    bounds = sizes.select(F.col("chr").alias(contig), F.col("size").alias("_size"))
    joined = intervals.join(bounds, contig)
    if mode == "drop":
        kept = joined.where((F.col(start) >= 0) & (F.col(end) <= F.col("_size")))
    elif mode == "trim":
        kept = (
            joined.withColumn(start, F.greatest(F.col(start), F.lit(0)))
            .withColumn(end, F.least(F.col(end), F.col("_size")))
            .where(F.col(start) < F.col(end))
        )
    else:
        raise ValueError(f"mode must be 'drop' or 'trim', not {mode!r}")
    return kept.select(*intervals.columns)


def with_chrom_order(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows with ``chrom_order``; contigs off the list come last."""
    order = sizes.select(F.col("chr").alias("contig"), F.col("chrom_order").cast("long").alias("chrom_order"))
    return rows.join(order, "contig", "left").select(
        *rows.columns, F.coalesce("chrom_order", F.lit(LAST_CONTIG)).alias("chrom_order"))


def in_genome_order(track: DataFrame, sizes: DataFrame, by: Sequence[str] = ("pseudobulk_id",)) -> DataFrame:
    """Runs with ``chrom_order``, in partitions that are ranges of (by, contig, start)."""
    placed = with_chrom_order(track, sizes)
    return placed.repartitionByRange(*[F.col(c) for c in (*by, "chrom_order", "start")])


def genome_sorted(intervals: DataFrame, contig: str, start: str, end: str, sizes: DataFrame,
                  rest: Sequence[str] = ()) -> DataFrame:
    """Order by the contig list, then position, then the remaining text; unknown contigs last."""
    order = sizes.select(F.col("chr").alias(contig), "chrom_order")
    return (
        intervals.join(order, contig, "left").select(*intervals.columns, "chrom_order")
        .orderBy(F.col("chrom_order").asc_nulls_last(), start, end,
                 *[F.col(c).cast("string") for c in rest])
    )
