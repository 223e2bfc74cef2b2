"""Depth of windows around points inside one genome slice, by numpy on Arrow tables."""

import sys
from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors need not have this package installed to run the functions made here.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Derive = Callable[[Mapping[str, np.ndarray], Mapping[str, object]], dict[str, np.ndarray]]
CHUNK = 1 << 16  # rows of one Arrow batch that goes back
DENSE = 16  # up to so many bases a point, depths are worked out base by base


def changes(points: np.ndarray, weights: np.ndarray, widths: Sequence[int], clip: bool
            ) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ascending positions where some depth changes, and every depth from there on.

    A point adds its weight to depth k over ``widths[k]`` bases around it, from 0 on if
    ``clip``.
    """
    if not len(points):
        return points, [weights for _ in widths]
    if int(points.max()) - int(points.min()) + 2 * max(widths) <= DENSE * len(points):
        return _changes_base_by_base(points, weights, widths, clip)
    lows = [points - w // 2 for w in widths]
    highs = [low + w for low, w in zip(lows, widths)]
    if clip:
        lows = [np.maximum(low, 0) for low in lows]
    places = np.concatenate([*lows, *highs])
    order = np.argsort(places, kind="stable")
    places = places[order]
    first = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    n, sums = len(points), []
    for k in range(len(widths)):
        step = np.zeros(len(places), np.int64)
        step[k * n:(k + 1) * n] = weights
        step[(len(widths) + k) * n:(len(widths) + k + 1) * n] = -weights
        sums.append(np.add.reduceat(step[order], first))
    moved = np.any([s != 0 for s in sums], axis=0)
    return places[first][moved], [np.cumsum(s[moved]) for s in sums]


def _changes_base_by_base(points: np.ndarray, weights: np.ndarray, widths: Sequence[int], clip: bool
                          ) -> tuple[np.ndarray, list[np.ndarray]]:
    """``changes`` where points lie so close that a value per base costs less than ordering edges."""
    reach = max(widths)
    base = int(points.min()) - reach
    size = int(points.max()) - base + reach + 1
    upto = np.cumsum(np.bincount(points - base, weights, size)).astype(np.int64)  # sums below 2**53
    found = []
    for w in widths:
        depth = upto.copy()
        ahead, behind = w // 2, w - w // 2  # a base is covered by points up to there
        if ahead:
            depth[:-ahead] = upto[ahead:]
            depth[-ahead:] = upto[-1]
        depth[behind:] -= upto[:-behind]
        found.append(depth)
    first = max(-base, 0) if clip else 0
    moved = np.any([np.diff(depth[first:], prepend=0) != 0 for depth in found], axis=0)
    at = np.flatnonzero(moved) + first
    return at + base, [depth[at] for depth in found]


def in_slice(keys: Sequence[str], widths: Mapping[str, int], tile: int, clip: bool, schema: pa.Schema,
             edge: bool, carry: Sequence[str] = (), derive: Derive | None = None, ahead: int = 0
             ) -> Callable[[tuple, pa.Table], pa.Table]:
    """Function of one (tile, keys) group of points (_tile, keys, _at, _n, carry).

    Its rows are the runs that begin inside the tile and end there, or up to ``ahead`` bases
    behind it. With ``edge`` it is one row instead: the first change of the tile, and the run
    that its last one begins, ``_on`` if that has some depth. ``derive`` makes further columns from the depths of the
    rows and the carried values, which are the same for all points of a group.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        slot = key[0].as_py()
        at, found = changes(table["_at"].to_numpy(), table["_n"].to_numpy(), list(widths.values()), clip)
        own = slice(*np.searchsorted(at, [slot * tile, (slot + 1) * tile + ahead]))
        at, found = at[own], [d[own] for d in found]
        high = np.any([d > 0 for d in found], axis=0)
        if edge:
            kept = slice(len(at) - 1, None) if len(at) else slice(0, 0)
            columns = {"_first": at[:1], "start": at[kept], "_on": high[kept]}
        else:
            kept = np.flatnonzero(high[:-1] & (at[:-1] < (slot + 1) * tile))
            columns = {"start": at[kept], "end": at[kept + 1] if len(kept) else at[:0]}
        columns |= {name: d[kept] for name, d in zip(widths, found)}
        if derive:
            columns |= derive(columns, {c: table[c][0].as_py() for c in carry})
        return _rows({"_tile": key[0], **dict(zip(keys, key[1:]))}, columns, schema)

    return run


def told_apart(function: Callable[[tuple, pa.Table], pa.Table], names: Sequence[str]
               ) -> Callable[[pa.Table], pa.Table]:
    """A function of one group as one of several groups that share a number."""
    def run(table: pa.Table) -> pa.Table:
        return pa.concat_tables([function(tuple(named.values()), rows) for named, rows in _told_apart(table, names)])

    return run


def open_at_border(keys: Sequence[str], widths: Mapping[str, int], tile: int, clip: bool, ahead: int,
                   schema: pa.Schema) -> Callable[[tuple, pa.Table], pa.Table]:
    """Function of the points near the border where a tile begins, a (tile, keys) group: its
    name, if a run that reaches over the border goes on for ``ahead`` bases behind it."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        border = key[0].as_py() * tile
        at, found = changes(table["_at"].to_numpy(), table["_n"].to_numpy(), list(widths.values()), clip)
        first, behind = np.searchsorted(at, [border, border + ahead])
        far = bool(first) and first == behind and any(d[first - 1] > 0 for d in found)
        return pa.table([pa.repeat(k, int(far)) for k in key], names=schema.names).cast(schema)

    return run


def shared_in_slice(keys: Sequence[str], names: Sequence[str], widths: Mapping[str, int], tile: int, clip: bool,
                    ahead: int, schema: pa.Schema, carry: Sequence[str], derive: Callable
                    ) -> Callable[[tuple, pa.Table], pa.Table]:
    """Function of one (tile, keys) group of the points (_tile, keys, _by, _at, _n, _limit, carry) of
    several sets, of which ``_by`` names one.

    Its rows are the segments that begin inside the tile and that a run of every set and one of
    all sets together cover; a run that ends behind ``_limit`` does not count. ``derive`` makes
    the values from the depths of every set, then those of all together, and the carried values.
    No run may go on for more than ``ahead`` bases behind the tile.
    """
    def run(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[0].as_py() * tile, (key[0].as_py() + 1) * tile
        limit = table["_limit"][0].as_py()
        stop = high + ahead if limit is None else min(high + ahead, limit + 1)
        at, n = table["_at"].to_numpy(), table["_n"].to_numpy()
        masks = [pc.equal(table["_by"], name).to_numpy() for name in names]
        tracks = [changes(at[m], n[m], list(widths.values()), clip) for m in masks]
        places = np.unique(np.concatenate([found for found, _ in tracks]))
        begin, own, end = np.searchsorted(places, [low, high, stop])
        each = [[_held(found, d, places) for d in depths] for found, depths in tracks]
        each.append([np.sum(ds, axis=0) for ds in zip(*each)])
        covered = np.ones(len(places), np.bool_)
        for ds in each:
            moved = np.any([np.diff(d, prepend=0) != 0 for d in ds], axis=0)
            last = begin + np.flatnonzero(moved[begin:end])[-1:]
            covered &= np.any([d > 0 for d in ds], axis=0)
            covered[int(last[0]) if len(last) else 0:] = False
        kept = begin + np.flatnonzero(covered[begin:own])
        columns = {"start": places[kept], "end": places[kept + 1] if len(kept) else places[:0]}
        sets = [{name: d[kept] for name, d in zip(widths, ds)} for ds in each]
        columns |= derive(sets, {c: table[c][0].as_py() for c in carry})
        return _rows({"_tile": key[0], **dict(zip(keys, key[1:]))}, columns, schema)

    return run


def _held(at: np.ndarray, values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Values that hold from ``at`` on, at other places; 0 before the first."""
    return np.concatenate([[0], values])[np.searchsorted(at, places, "right")]


def _rows(named: Mapping[str, pa.Scalar], columns: Mapping[str, np.ndarray], schema: pa.Schema) -> pa.Table:
    """Columns of one length, and values that are the same in all rows, as batches of that layout."""
    size = max(len(c) for c in columns.values())
    whole = pa.table([pa.repeat(named[f.name], size) if f.name in named
                      else pa.array(columns[f.name], f.type, from_pandas=True) for f in schema], names=schema.names)
    return pa.Table.from_batches(whole.to_batches(CHUNK), whole.schema)


def cut_to_windows(starts: np.ndarray, ends: np.ndarray, values: np.ndarray, level: int
                   ) -> tuple[np.ndarray, ...]:
    """Ascending, disjoint, non-empty runs summed up in windows of ``2**level`` bases: window,
    sum over its bases, least and largest value, bases covered."""
    first = starts >> level
    pieces = ((ends - 1) >> level) - first + 1
    run = np.repeat(np.arange(len(pieces)), pieces)
    at = first[run] + np.arange(len(run)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    length = np.minimum(ends[run], (at + 1) << level) - np.maximum(starts[run], at << level)
    return merged_windows(at, values[run] * length, values[run], values[run], length)


def merged_windows(at: np.ndarray, sums: np.ndarray, least: np.ndarray, most: np.ndarray,
                   covered: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring rows of one window as one row."""
    first = np.flatnonzero(np.concatenate([at[:1] == at[:1], at[1:] != at[:-1]]))
    if not len(first):
        return at, sums, least, most, covered
    return (at[first], np.add.reduceat(sums, first), np.minimum.reduceat(least, first),
            np.maximum.reduceat(most, first), np.add.reduceat(covered, first))


def windows_in_slice(keys: Sequence[str], width: int, tile: int, clip: bool, levels: Sequence[int],
                     schema: pa.Schema) -> Callable[[pa.Table], pa.Table]:
    """Function of the points (_tile, keys, _at, _n) of a (tile, keys) group, or of several: the
    windows of the ascending ``levels``, as far as they lie inside their tile."""
    names = ["level", "window", "value_sum", "min_value", "max_value", "covered"]

    def group(slot: int, points: pa.Table) -> dict[str, np.ndarray]:
        at, (depth,) = changes(points["_at"].to_numpy(), points["_n"].to_numpy(), [width], clip)
        starts, ends = np.maximum(at[:-1], slot * tile), np.minimum(at[1:], (slot + 1) * tile)
        kept = (depth[:-1] > 0) & (ends > starts)
        windows = cut_to_windows(starts[kept], ends[kept], depth[:-1][kept], levels[0])
        found = []
        for before, level in zip([levels[0], *levels], levels):
            windows = merged_windows(windows[0] >> (level - before), *windows[1:])
            found.append((np.full(len(windows[0]), level, np.int32), *windows))
        return dict(zip(names, [np.concatenate(parts) for parts in zip(*found)]))

    def run(table: pa.Table) -> pa.Table:
        return pa.concat_tables([_rows(named, group(named["_tile"].as_py(), points), schema)
                                 for named, points in _told_apart(table, ["_tile", *keys])])

    return run


def _told_apart(table: pa.Table, names: Sequence[str]) -> list[tuple[dict[str, pa.Scalar], pa.Table]]:
    """The rows of every combination of values; mostly there is one."""
    first = {n: table[n][0] for n in names}
    same = None
    for name, value in first.items():
        equal = pc.equal(table[name], value)
        same = equal if same is None else pc.and_(same, equal)
    if pc.all(same).as_py():
        return [(first, table)]
    return [(first, table.filter(same)), *_told_apart(table.filter(pc.invert(same)), names)]
