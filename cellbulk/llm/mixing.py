"""Mixing sources to target weights: a Pfair schedule of source blocks.

A source's documents are put in pseudo-random order and cut into blocks. In the ideal mix
every source that has blocks left runs at the rate of its weight among those that have;
the j-th block of a source is released in the slot in which the ideal mix begins it and
due at the end of the slot in which the ideal mix ends it. In every slot the released
block with the earliest deadline runs. The ideal mix fills every slot, so all deadlines
are met and after any number of slots, over the whole order, a source's blocks differ
from its ideal share by less than one. Weights are not rounded: all times are ratios of
integers. When a source runs out, the others share its slots by their weights. Sources
of weight 0 follow after all others, in equal shares. No row is dropped.

With ``resolution`` the weights are first rounded to that many whole parts, at least one
each, and every cycle hands out whole parts.

The driver holds one row per source and works out the slots one after the other, which
is one step of a heap per block of ``BLOCK`` documents; what it has worked out is written
every ``CHUNK`` slots. Documents are ranked in hash ranges of their source, so a source
with a third of all rows is split like the rest. What touches documents is DataFrame code
in the JVM.

Defined results: a null source counts as the source with the empty name; null ids and
repeated rows are rows like any other, each with a place of its own; an empty table
gives an empty schedule. Extra columns are carried along.
"""

import heapq
import math
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellbulk.llm.common import packed, unpacked
from cellbulk.session import new_folder, saved

BLOCK, RANGE_ROWS, CHUNK = 64, 4096, 500_000
SPOT = ["_source", "_range"]


def source_parts(counts: DataFrame, weights: Mapping[str, float] | None, exponent: float,
                 resolution: int) -> DataFrame:
    """(source, n, parts): whole parts of about ``resolution`` in all, at least one each.

    Without ``weights`` a source weighs its row count to the power ``exponent``. A source
    that ``weights`` does not name gets one part.
    """
    if weights:
        if len(weights) > resolution:
            raise ValueError("more weighted sources than parts in a cycle")
        pairs = [F.lit(x) for name, weight in weights.items() for x in (name, float(weight))]
        weight = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("source")), F.lit(0.0))
    else:
        weight = F.pow(F.col("n").cast("double"), F.lit(exponent))
    total = counts.withColumn("weight", weight).agg(F.collect_list(F.struct("source", "n", "weight")).alias("all"))
    share = F.aggregate("all", F.lit(0.0), lambda s, x: s + x["weight"])
    return total.withColumn("_sum", share).select("_sum", F.inline("all")).select(
        "source", "n", F.greatest(F.lit(1), F.round(F.col("weight") / F.col("_sum") * resolution)).cast("int").alias("parts"))


def ideal_windows(weights: list[Fraction], blocks: list[int]) -> list[Iterator[tuple[int, int]]]:
    """(release, due) of every block of each source, in a mix by weights above 0.

    At the moment v a source has run min(blocks, weight * v) blocks; slots are the sum of
    these, which is linear between the moments at which sources run out.
    """
    scale = math.lcm(*[w.denominator for w in weights])
    whole = [int(w * scale) for w in weights]
    ends: list[tuple[int, int]] = []  # the moment as blocks / weight
    gone, alive = [0], [sum(whole)]
    for b, w in sorted(zip(blocks, whole), key=lambda s: Fraction(*s)):
        if ends and ends[-1][0] * w == b * ends[-1][1]:
            gone[-1], alive[-1] = gone[-1] + b, alive[-1] - w
        else:
            ends.append((b, w))
            gone.append(gone[-1] + b)
            alive.append(alive[-1] - w)

    def windows(w: int, b: int) -> Iterator[tuple[int, int]]:
        at = release = 0
        for j in range(1, b + 1):
            if ends[at][0] * w < j * ends[at][1]:
                at = bisect_left(ends, j, lo=at + 1, key=lambda e: e[0] * w // e[1])
            moment = alive[at] * j
            yield release, gone[at] - (-moment // w)
            release = gone[at] + moment // w

    return [windows(w, b) for w, b in zip(whole, blocks)]


def cycle_windows(parts: list[int], blocks: list[int]) -> list[Iterator[tuple[int, int]]]:
    """(release, due) of every block, in cycles of whole parts or what a source has left."""
    first = [0]
    for c in range(max(-(-b // p) for p, b in zip(parts, blocks))):
        first.append(first[-1] + sum(min(p, max(0, b - c * p)) for p, b in zip(parts, blocks)))

    def windows(p: int, b: int) -> Iterator[tuple[int, int]]:
        for c in range(-(-b // p)):
            amount, length = min(p, b - c * p), first[c + 1] - first[c]
            for j in range(amount):
                yield first[c] + j * length // amount, first[c] - (-(j + 1) * length // amount)

    return [windows(p, b) for p, b in zip(parts, blocks)]


def earliest_deadlines(windows: list[Iterator[tuple[int, int]]]) -> Iterator[tuple[int, int]]:
    """(source position, number of its block) of every slot. Of a source's blocks only the
    next one is held, as a block is released in the last slot of the one before at the earliest."""
    coming = [(*next(own), i, 0) for i, own in enumerate(windows)]
    heapq.heapify(coming)
    ready: list[tuple[int, int, int]] = []
    slot = 0
    while coming or ready:
        while coming and coming[0][0] <= slot:
            heapq.heappush(ready, heapq.heappop(coming)[1:])
        due, i, j = heapq.heappop(ready)
        if due <= slot:
            raise AssertionError("a block missed its deadline")
        yield i, j
        slot += 1
        if follows := next(windows[i], None):
            heapq.heappush(coming, (*follows, i, j + 1))


def source_weights(sizes: Mapping[str, int], weights: Mapping[str, float] | None, exponent: float) -> list[Fraction]:
    """Without ``weights`` a source weighs its row count to the power ``exponent``; one that
    ``weights`` does not name weighs 0."""
    found = [weights.get(s, 0) if weights else n ** exponent for s, n in sizes.items()]
    if not all(0 <= w < math.inf for w in found):
        raise ValueError("weights are finite and not negative")
    return [Fraction(w) for w in found]


def schedule(spark: SparkSession, names: list[str], groups: list[tuple[Sequence[int], list[Iterator]]]) -> DataFrame:
    """(source, block, slot) of every block; the groups, as positions of names and their
    windows, follow one another."""
    path = new_folder(spark, "schedule")
    turns = ((own[i], j) for own, windows in groups for i, j in earliest_deadlines(windows))
    known, done = pa.array(names, pa.string()), 0
    while True:
        part = list(islice(turns, CHUNK))
        at, block = (list(x) for x in zip(*part)) if part else ([], [])
        table = pa.table({"source": known.take(pa.array(at, pa.int64())), "block": pa.array(block, pa.int64()),
                          "slot": pa.array(range(done, done + len(part)), pa.int64())})
        frame = spark.createDataFrame(table)
        frame.write.mode("append").parquet(path)
        done += len(part)
        if len(part) < CHUNK:
            return spark.read.schema(frame.schema).parquet(path)


PLACES = ("mix_block", "mix_slot", "mix_position")


def with_positions(docs: DataFrame, **options) -> DataFrame:
    """Adds mix_block, mix_slot and mix_position, in place of columns of these names; rows in
    the order of mix_position are the mix."""
    return unpacked(positions(docs, **options), docs.columns, *PLACES)


def positions(docs: DataFrame, weights: Mapping[str, float] | None = None, exponent: float = 0.5,
              key: str = "doc_id", source: str = "source", block: int = BLOCK,
              resolution: int | None = None, seed: int = 11) -> DataFrame:
    """Rows of ``docs`` packed as ``row``, with their places."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    rows = docs.count()
    bits = max(0, math.ceil(math.log2(max(1, rows / RANGE_ROWS))))
    spread = F.xxhash64(F.col(key), F.lit(seed))
    ranged = packed(docs, _source=name, _hash=spread, _tie=row_hash(docs),
                    _range=F.shiftrightunsigned(spread, 64 - bits) if bits else F.lit(0).cast("long"))
    sizes = saved(ranged.groupBy(*SPOT).agg(F.count("*").alias("n")), "ranges")
    ahead = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.withColumn("offset", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    counts = sizes.groupBy(F.col("_source").alias("source")).agg(F.sum("n").alias("n"))
    held = {r.source: r.n for r in counts.orderBy("source").collect()}
    amounts = [-(-n // block) for n in held.values()]
    if resolution:
        parts = {r.source: r.parts for r in source_parts(counts, weights, exponent, resolution).collect()}
        groups = [(range(len(held)), cycle_windows([parts[s] for s in held], amounts))] if held else []
    else:
        share = source_weights(held, weights, exponent)
        weighed, rest = [i for i, w in enumerate(share) if w], [i for i, w in enumerate(share) if not w]
        groups = [(own, ideal_windows([w[i] for i in own], [amounts[i] for i in own]))
                  for own, w in ((weighed, share), (rest, [Fraction(1)] * len(share))) if own]
    plan = schedule(docs.sparkSession, list(held), groups).withColumnRenamed("source", "_source")
    blocks = ranges.select(*SPOT, "offset", F.explode(F.sequence(
        F.floor(F.col("offset") / block), F.floor((F.col("offset") + F.col("n") - 1) / block))).alias("block"))
    listed = blocks.join(plan, ["_source", "block"]).groupBy(*SPOT, F.col("offset").alias("_offset")).agg(
        F.array_sort(F.collect_list(F.struct("block", "slot"))).alias("_turns"))
    order = Window.partitionBy(*SPOT).orderBy("_hash", "_tie")
    ranked = ranged.withColumn("_row", F.row_number().over(order) - 1)
    placed = ranked.join(listed, SPOT).withColumn("_rank", F.col("_offset") + F.col("_row"))
    own = F.floor(F.col("_rank") / block)
    return placed.withColumns({
        "mix_block": own,
        "mix_slot": F.get("_turns", (own - F.floor(F.col("_offset") / block)).cast("int"))["slot"],
    }).withColumn("mix_position", F.col("mix_slot") * block + F.col("_rank") % block).select("row", *PLACES)


def row_hash(docs: DataFrame) -> Column:
    """Orders rows that share an id; only rows equal in all plain columns stay tied."""
    plain = ("string", "bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "binary")
    return F.xxhash64(*[F.col(f"`{c}`") for c, kind in docs.dtypes if kind in plain] or [F.lit(0)])


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, sorted by their place in the mix across and within partitions."""
    placed = positions(docs, **options)
    return unpacked(placed.repartitionByRange("mix_position").sortWithinPartitions("mix_position"), docs.columns)
