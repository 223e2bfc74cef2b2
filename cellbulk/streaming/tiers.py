"""Partial sums of many batches, kept in few folders.

Every batch writes its sums into a slot of the lowest tier. When a tier holds ``fan``
slots they are added up into one slot of the tier above, so ``n`` batches leave about
``fan`` slots for each of log(n) tiers, and a row is rewritten once per tier. The ledger
says which slots count: its entry for a batch is written last, and a batch counts from then
on. Slots and ledger entries are folders of fixed names that are overwritten when no entry
a reader may hold refers to them, so nothing has to be deleted and any store will do. One
writer at a time, as a streaming query is; any number of readers.
"""

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8
ENTRIES = 4  # ledger entries that stay; the slots of the last ENTRIES - 1 are not overwritten
LEDGER = "batch long, tier int, slot int"


class TieredSums:
    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[Column], fan: int = FAN):
        """``sums`` are aggregates that make rows of ``keys`` and sums from such rows."""
        self.spark, self.path, self.keys, self.sums, self.fan = spark, path.rstrip("/"), list(keys), list(sums), fan

    def entries(self) -> dict[int, set[tuple[int, int]]]:
        """Live (tier, slot) after each of the last batches; a slot of tier -1 stands for none."""
        try:
            rows = self.spark.read.schema(LEDGER).parquet(*[
                p for p in (f"{self.path}/ledger/{i}" for i in range(ENTRIES)) if self._holds_files(p)]).collect()
        except AnalysisException:
            rows = []
        found: dict[int, set[tuple[int, int]]] = {}
        for row in rows:
            found.setdefault(row.batch, set()).update({(row.tier, row.slot)} if row.tier >= 0 else set())
        return found

    def _holds_files(self, path: str) -> bool:
        try:
            return bool(self.spark.read.schema(LEDGER).parquet(path).inputFiles())
        except AnalysisException:
            return False

    def add(self, batch: int, made: Callable[[], DataFrame]) -> bool:
        """Add the sums of a batch; False, and nothing done, if it counts already."""
        entries = self.entries()
        last = max(entries, default=-1)
        if batch <= last:
            return False
        live = set(entries.get(last, set()))
        held = set().union(*[entries[b] for b in sorted(entries)[1 - ENTRIES:]]) if entries else set()

        def put(tier: int, frame: DataFrame) -> tuple[int, int]:
            slot = next(i for i in range(len(held) + 1) if (tier, i) not in held)
            frame.write.mode("overwrite").parquet(self._folder(tier, slot))
            held.add((tier, slot))
            return tier, slot

        live.add(put(0, made()))
        tier = 0
        while len(full := {s for s in live if s[0] == tier}) >= self.fan:
            live = live - full | {put(tier + 1, self._added(full))}
            tier += 1
        rows = [(batch, *s) for s in sorted(live)] or [(batch, -1, 0)]
        self.spark.createDataFrame(rows, LEDGER).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/ledger/{batch % ENTRIES}")
        return True

    def total(self) -> DataFrame:
        """Sums over all batches that count."""
        entries = self.entries()
        live = entries.get(max(entries, default=-1), set())
        if not live:
            raise ValueError(f"no batch has been added below {self.path}")
        return self._added(live)

    def _added(self, slots: set[tuple[int, int]]) -> DataFrame:
        return self.spark.read.parquet(*[self._folder(*s) for s in sorted(slots)]).groupBy(*self.keys).agg(*self.sums)

    def _folder(self, tier: int, slot: int) -> str:
        return f"{self.path}/tier{tier}/{slot}"
