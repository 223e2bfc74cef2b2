"""Cosine self-join of embeddings by a subspace pigeonhole.

Unit vectors at cosine >= c differ by a squared distance of at most 2 - 2c. They are
rotated by a fixed orthogonal transform and cut into blocks; at least one block then
differs by no more than its proportional share. Each block is joined on its own: a grid
over its leading coordinates gives a vector one home cell, and the cells after it that
lie within the block's radius are visited. Within a cell block distances select
candidates, and whole vectors decide in double precision. A linked pair counts in the
first block whose budget it keeps, so the union over blocks has every pair once without
any pair being written: a task returns link counts and a spanning forest.

Defined results: vectors that are null, empty or zero, or hold null or non-finite
components, link with nothing. Vectors of different lengths do not link. A row without
an id takes no part (n_links 0, no component, not kept). Equal vectors, which are
joined once, link with each other.
"""

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellbulk.llm.components import connected_components, merge
from cellbulk.session import saved

BLOCKS, GRID_DIMS, TILE, STEP = 4, 2, 8192, 512
SLACK = 1e-9
ROUGH = 1e-5  # more than single precision loses in a block distance of unit vectors
MIX = np.uint64(0x9E3779B97F4A7C15)  # spreads ids over the slices of a cell


def units(vectors: list[bytes], kind: str) -> np.ndarray:
    """Rows of length one in double precision, from vectors of one length as bytes."""
    matrix = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)  # no overflow in the squares
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def rotated(matrix: np.ndarray, seed: int = 7) -> np.ndarray:
    """Two rounds of sign flips and Hadamard transform: orthogonal, and made of element-wise
    steps only, so a vector gets the same bits whatever rows stand beside it."""
    width = 1 << max(0, int(matrix.shape[1] - 1).bit_length())
    turned = np.zeros((len(matrix), width))
    turned[:, :matrix.shape[1]] = matrix
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(2, width))
    for sign in signs:
        turned = turned * sign
        half = 1
        while half < width:
            pairs = turned.reshape(len(matrix), -1, 2, half)
            turned = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
            turned = turned.reshape(len(matrix), width)
            half *= 2
        turned = turned / np.sqrt(width)
    return turned


def block_count(width: int, blocks: int = BLOCKS) -> int:
    """Blocks of at least eight coordinates; widths are powers of two."""
    return max(1, min(blocks, width // 8))


def cells_of(turned: np.ndarray, budget: float, blocks: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, rows, cells, at home?) of a batch of rotated vectors."""
    count = block_count(turned.shape[1], blocks)
    size = turned.shape[1] // count
    radius = float(np.sqrt(budget / count)) + SLACK
    dims = min(GRID_DIMS, size)
    for block in range(count):
        lead = turned[:, block * size:block * size + dims]
        low, high = (np.floor((lead + d) / (2 * radius)).astype(np.int64) for d in (-radius, radius))
        home = _packed(np.floor(lead / (2 * radius)).astype(np.int64))
        rows = np.arange(len(turned))
        yield block, rows, home, np.ones(len(rows), bool)
        visits = np.stack([_packed(np.where(np.array(up, bool), high, low))
                           for up in itertools.product((0, 1), repeat=dims)], axis=1)
        # a cell reached on both sides of a coordinate appears twice: keep its first mention
        order = np.sort(visits, axis=1)
        fresh = (order > home[:, None]) & np.c_[np.ones(len(order), bool), order[:, 1:] != order[:, :-1]]
        at, which = np.nonzero(fresh)
        yield block, at, order[at, which], np.zeros(len(at), bool)


def _packed(cell: np.ndarray) -> np.ndarray:
    """Grid coordinates as one number; they are small, as the vectors have length one."""
    code = np.zeros(len(cell), np.int64)
    for i in range(cell.shape[1]):
        code = code * 65_536 + (cell[:, i] + 32_768)
    return code


def tile_links(left: pd.DataFrame, right: pd.DataFrame | None, kind: str, block: int, cosine: float,
               blocks: int) -> pd.DataFrame:
    """(id, links, root) of rows that are linked; ``right`` is None to join left with itself."""
    rows = left if right is None else pd.concat([left, right])
    turned = rotated(units(rows["vector"].tolist(), kind))
    ids, copies = rows["id"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)
    budget = 2 - 2 * cosine + SLACK
    count = block_count(turned.shape[1], blocks)
    size, split = turned.shape[1] // count, len(left)
    own = np.ascontiguousarray(turned[:, block * size:(block + 1) * size], dtype=np.float32)
    norm = (own * own).sum(axis=1)
    rank = np.argsort(ids, kind="stable")  # labels are positions in id order
    place = np.empty(len(ids), np.int64)
    place[rank] = np.arange(len(ids))
    links, label = np.zeros(len(ids), np.int64), np.arange(len(ids))
    first, last = (0, split) if right is None else (split, len(ids))
    width = max(1, (1 << 21) // max(1, last - first))
    for start in range(0, split, width):
        stop = min(split, start + width)
        begin = start if right is None else first
        # |x - y|^2 <= budget, written as a bound on the product
        close = own[start:stop] @ own[begin:last].T
        close -= norm[start:stop, None] / 2
        a, b = np.nonzero(close >= (norm[None, begin:last] - np.float32(budget / count + ROUGH)) / 2)
        a, b = a + start, b + begin
        if right is None:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 1 << 17):
            x, y = a[at:at + (1 << 17)], b[at:at + (1 << 17)]
            linked = (turned[x] * turned[y]).sum(axis=1) >= cosine
            x, y = x[linked], y[linked]
            parts = ((turned[x] - turned[y]) ** 2).reshape(len(x), count, size).sum(axis=2)
            here = np.argmax(parts <= budget / count, axis=1) == block
            x, y = x[here], y[here]
            links += np.bincount(x, weights=copies[y], minlength=len(ids)).astype(np.int64)
            links += np.bincount(y, weights=copies[x], minlength=len(ids)).astype(np.int64)
            label = merge(label, place[x], place[y])
    found = links > 0
    return pd.DataFrame({"id": ids[found], "links": links[found], "root": ids[rank[label[place[found]]]]})


def cosine_links(items: DataFrame, cosine: float = 0.9, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """(id, links, root) partial results over distinct (id long, copies long, dim int, vector
    binary: little-endian floats or doubles).

    Cells are counted first: how many there are is bounded by the grid, which depends on
    the cosine alone. A cell above ``tile`` rows is cut into slices of about that size,
    and every pair of slices is a group of its own.
    """
    one = items.first()
    budget, kind = 2 - 2 * cosine + SLACK, f"<f{len(one.vector) // one.dim if one else 8}"

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
        """A few rows of one length at a time, and the cells each belongs to or visits."""
        for batch in batches:
            for dim, rows in batch.groupby("dim"):
                for start in range(0, len(rows), STEP):
                    part = rows.iloc[start:start + STEP].reset_index(drop=True)
                    spots = cells_of(rotated(units(part["vector"].tolist(), kind)), budget, blocks)
                    yield part, pd.concat([pd.DataFrame({"dim": int(dim), "block": block, "cell": cell, "home": home, "row": at})
                                           for block, at, cell, home in spots])

    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, spots in spread(batches):
            yield spots.groupby(["dim", "block", "cell", "home"], as_index=False).agg(n=("row", "size"))

    counted = items.mapInPandas(tally, "dim int, block int, cell long, home boolean, n long").groupBy(
        "dim", "block", "cell", "home").agg(F.sum("n").alias("n")).toPandas()
    slices = {(r.dim, r.block, r.cell, r.home): -(-r.n // tile) for r in counted.itertuples()}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, spots in spread(batches):
            mixed = part["id"].to_numpy(np.int64).view(np.uint64) * MIX >> np.uint64(33)
            made = []
            for (*cell, home), spot in spots.groupby(["dim", "block", "cell", "home"]):
                own, guests = slices.get((*cell, True), 0), slices.get((*cell, False), 0)
                rows = spot["row"].to_numpy()
                salt = (mixed[rows] % np.uint64(own if home else guests)).astype(np.int64)
                for s in np.unique(salt):
                    here = rows[salt == s]
                    if home:
                        made += [(*cell, s, j, True, here) for j in [*range(s, own), *range(own, own + guests)]]
                    made += [(*cell, i, s if home else own + s, False, here) for i in range(s if home else own)]
            if made:
                sizes = [len(m[-1]) for m in made]
                placed = pd.DataFrame({name: np.repeat([m[k] for m in made], sizes) for k, name in enumerate(
                    ("dim", "block", "cell", "i", "j", "first"))})
                rows = part.iloc[np.concatenate([m[-1] for m in made])].reset_index(drop=True)
                yield pd.concat([placed, rows[["id", "copies", "vector"]]], axis=1)

    def search(group: pd.DataFrame) -> pd.DataFrame:
        block, i, j = (int(group[name].iloc[0]) for name in ("block", "i", "j"))
        first = group["first"].to_numpy(bool)
        right = None if i == j else group[~first]
        if not first.any() or (right is not None and not len(right)):
            return pd.DataFrame({"id": [], "links": [], "root": []}, dtype=np.int64)
        return tile_links(group[first], right, kind, block, cosine, blocks)

    dealt = items.select("id", "copies", "dim", "vector").mapInPandas(
        deal, "dim int, block int, cell long, i int, j int, first boolean, id long, copies long, vector binary")
    return dealt.groupBy("dim", "block", "cell", "i", "j").applyInPandas(search, "id long, links long, root long")


def as_bytes(rows: DataFrame) -> DataFrame:
    """(id, copies, dim, vector) with the array as its bytes, which cost little to copy."""
    kind = "<f4" if rows.schema["vector"].dataType.elementType.simpleString() == "float" else "<f8"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            vectors = [np.asarray(v, kind) for v in batch["vector"]]
            yield pd.DataFrame({"id": batch["id"], "copies": batch["copies"], "dim": [len(v) for v in vectors],
                                "vector": [v.tobytes() for v in vectors]})

    return rows.select("id", "copies", "vector").mapInPandas(run, "id long, copies long, dim int, vector binary")


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, key: str = "vec_id",
                    vector: str = "embedding") -> DataFrame:
    """(key, n_links, component_id, kept) per row of ``vectors``."""
    fine = F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).cast("long").alias("key"), F.when(fine & F.col(key).isNotNull(), F.col(vector)).alias("vector"))
    items = saved(rows.where("vector is not null").groupBy("vector").agg(
        F.min("key").alias("id"), F.count("*").alias("copies")), "vectors")
    found = saved(cosine_links(saved(as_bytes(items), "vector-bytes"), cosine), "vector-links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select(F.col("root").alias("a"), F.col("id").alias("b")))
    placed = items.join(counts, "id", "left").join(parts, "id", "left").select(
        "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"))
    whole = rows.join(placed, "vector", "left")
    component = F.coalesce("component_id", "key")
    return whole.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("key") == component, F.lit(False)).alias("kept"))
