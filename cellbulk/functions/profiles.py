"""Counting the values of long lists, and the slots of points around sites, by numpy on Arrow batches."""

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have this package installed to run the functions made here.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CONTIG = 40  # a place is the number of its contig, from 1 on, shifted by so many bits, plus the position
AT_ONCE = 1 << 20  # pairs of a point and a site
ROWS = 1 << 9
NAMES = 1 << 10
Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def count_slots(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Function of rows whose last column ``slots`` lists numbers from 0 to ``size - 1``: the list
    becomes its distinct numbers in order, and a further list ``n`` says how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            code, n = np.unique(row * size + lists.flatten().to_numpy(), return_counts=True)
            ends = pa.array(np.searchsorted(code, np.arange(len(lists) + 1) * size), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(code % size, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(n, pa.int64()))],
                names=[*batch.schema.names, "n"])

    return run


def _slots_near(at: np.ndarray, sites: np.ndarray, strands: np.ndarray, half: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(point, slot) of every pair of a point and one of the ascending sites in reach, some points at a time."""
    low = np.searchsorted(sites, at - half, "left")
    reach = np.searchsorted(sites, at + half, "right") - low
    upto, start = np.concatenate([[0], np.cumsum(reach)]), 0
    while start < len(at):
        stop = max(start + 1, int(np.searchsorted(upto, upto[start] + AT_ONCE, "right")) - 1)
        some = reach[start:stop]
        point = np.repeat(np.arange(start, stop), some)
        site = np.arange(len(point)) + np.repeat(low[start:stop] - upto[start:stop] + upto[start], some)
        yield point, half + (at[point] - sites[site]) * strands[site]
        start = stop


def list_slots(sites: np.ndarray, strands: np.ndarray, half: int) -> Batches:
    """Function of rows (keys, _at, _key) in the order of ``_key``, a number that follows from the
    keys: the slots of the places ``_at`` around the sites, one row (keys, slots, n) per keys with
    lists as of ``count_slots``. Keys without a slot are left out."""
    size = 2 * half + 1

    def counted(rows: pa.Table) -> pa.RecordBatch:
        codes = [c.combine_chunks().dictionary_encode("encode").indices.to_numpy() for c in rows.columns[:-2]]
        codes.append(rows["_key"].to_numpy())
        at = rows["_at"].to_numpy()
        begins = _begins(codes)
        if begins.sum() > _begins(codes[-1:]).sum():  # keys that share a number may be mixed
            order = np.lexsort(codes)
            rows, at, begins = rows.take(order), at[order], _begins([c[order] for c in codes])
        first, row = np.flatnonzero(begins), np.cumsum(begins) - 1
        total = np.zeros(len(first) * size, np.int64)
        for point, slot in _slots_near(at, sites, strands, half):
            total += np.bincount(row[point] * size + slot, minlength=len(total))
        code = np.flatnonzero(total)
        ends = np.searchsorted(code, np.arange(len(first) + 1) * size)
        names = rows.take(first).combine_chunks()
        keys = [pa.concat_arrays(c.chunks) for c in names.columns[:-2]]
        found = pa.RecordBatch.from_arrays(
            [*keys, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(code % size, pa.int32())),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(total[code], pa.int64()))],
            names=[*rows.column_names[:-2], "slots", "n"])
        return found.filter(pa.array(np.diff(ends) > 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []  # rows of the last number so far
        for batch in batches:
            if not batch.num_rows:
                continue
            number = batch.column(batch.num_columns - 1).to_numpy()
            cut = int(np.searchsorted(number, number[-1], "left"))
            if cut or (held and number[0] != held[-1].column(batch.num_columns - 1)[0].as_py()):
                whole = [*held, *([batch.slice(0, cut)] if cut else [])]
                yield counted(pa.Table.from_batches(whole))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield counted(pa.Table.from_batches(held))

    return run


def _begins(codes: list[np.ndarray]) -> np.ndarray:
    """Where a row differs from the row before."""
    return np.concatenate([[True], np.any([c[1:] != c[:-1] for c in codes], axis=0)])


def sum_slots(sites: np.ndarray, strands: np.ndarray, half: int) -> Batches:
    """Function of rows (name, place): the slots around the sites of all rows of a name as lists
    ``slots`` and ``n``, in one row or several."""
    size = 2 * half + 1

    def found(batch: pa.RecordBatch, number: np.ndarray, names: int) -> Iterator[np.ndarray]:
        for point, slot in _slots_near(batch.column(1).to_numpy(), sites, strands, half):
            yield np.bincount(number[point] * size + slot, minlength=names * size)

    return _summed(found, size)


def sum_lists(size: int) -> Batches:
    """Function of rows (name, slots, n) with lists as of ``count_slots``: the same of every name, in
    one row or several."""
    def found(batch: pa.RecordBatch, number: np.ndarray, names: int) -> Iterator[np.ndarray]:
        for first in range(0, batch.num_rows, ROWS):
            some = batch.slice(first, ROWS)
            lists = some.column(1)
            row = np.repeat(number[first:first + ROWS], np.diff(lists.offsets.to_numpy()))
            code = row.astype(np.int64) * size + lists.flatten().to_numpy()
            yield np.bincount(code, some.column(2).flatten().to_numpy(), names * size).astype(np.int64)

    return _summed(found, size)


def _summed(found: Callable[[pa.RecordBatch, np.ndarray, int], Iterator[np.ndarray]], size: int) -> Batches:
    """Sums by the names in the first column of what ``found`` makes of batches, the names as numbers."""
    def rows(totals: dict[str, np.ndarray], name: str) -> Iterator[pa.RecordBatch]:
        for key, total in totals.items():
            slots = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([slots], pa.list_(pa.int32())),
                                              pa.array([total[slots]], pa.list_(pa.int64()))], names=[name, "slots", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, name = {}, None
        for batch in batches:
            name, coded = batch.schema.names[0], batch.column(0).dictionary_encode()
            keys, number = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for more in found(batch, number, len(keys)):
                for key, sums in zip(keys, more.reshape(len(keys), size)):
                    totals[key] = totals[key] + sums if key in totals else sums.copy()
            if len(totals) > NAMES:
                yield from rows(totals, name)
                totals = {}
        yield from rows(totals, name)

    return run
