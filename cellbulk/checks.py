"""Data checks that yield violation tables, and what to do with them."""

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cellbulk import schemas
from cellbulk.session import saved

log = logging.getLogger("cellbulk")


def metadata_violations(metadata: DataFrame) -> DataFrame:
    """Rows (rule, item) for every rule the cell metadata breaks."""
    missing = [c for c in schemas.METADATA_REQUIRED if c not in metadata.columns]
    if missing:
        raise ValueError(f"metadata lacks the columns {', '.join(missing)}")
    separators = metadata.where(F.col("subsample").contains("-")).select(
        F.lit("separator in subsample").alias("rule"), F.col("subsample").alias("item")
    ).distinct()
    repeated = metadata.groupBy("analysis_set_accession", "barcode_sample").agg(
        F.count("*").alias("_n")).where("_n > 1").select(
        F.lit("repeated barcode").alias("rule"),
        F.concat_ws("/", "analysis_set_accession", "barcode_sample").alias("item"))
    return separators.unionByName(repeated)


def checked_metadata(metadata: DataFrame) -> DataFrame:
    """The metadata itself; a row with a separator in its subsample stops the job."""
    message = F.concat(F.lit("subsample contains '-': "), F.col("subsample"))
    return metadata.withColumn(
        "subsample",
        F.when(F.col("subsample").contains("-"), F.raise_error(message).cast("string"))
        .otherwise(F.col("subsample")))


def act_on(violations: DataFrame, actions: Sequence[str], table_path: str | None = None) -> bool:
    """Apply every action to a violations table; True when there were none.

    ``warning`` logs a sample, ``sentinel`` writes the whole table, ``exception``
    raises, in this order.
    """
    unknown = set(actions) - {"exception", "warning", "sentinel"}
    if unknown:
        raise ValueError(f"unknown actions {sorted(unknown)}")
    if "sentinel" in actions and table_path is None:
        raise ValueError("the sentinel action needs a path")
    # Written once, however many actions look at it: the check itself may be a wide join.
    found = saved(violations, "violations") if "sentinel" in actions else violations
    sample = found.take(5)
    if not sample:
        return True
    text = "; ".join(str(row.asDict()) for row in sample)
    if "warning" in actions:
        log.warning("checks failed, for example: %s", text)
    if "sentinel" in actions:
        found.write.mode("append").parquet(table_path)
    if "exception" in actions:
        raise RuntimeError(f"checks failed, for example: {text}")
    return False


class Watch:
    """Conditions counted while a frame is written, so that no scan is made for them."""

    def __init__(self, rows: DataFrame, what: str, **conditions: Column):
        self.what, self._names = what, list(conditions)
        self._seen = Observation()
        # One row of each kind is kept as an example: the smallest, so runs agree.
        self.rows = rows.observe(
            self._seen, *[F.count_if(c).alias(f"n_{n}") for n, c in conditions.items()],
            *[F.min(F.when(c, F.struct(*[F.col(f"`{f.name}`") for f in rows.schema.fields if f.dataType.typeName() != "map"]))).alias(f"of_{n}")
              for n, c in conditions.items()])

    def counts(self) -> dict[str, int]:
        """Rows that met each condition; waits for the first action on ``rows``."""
        return {n: self._seen.get[f"n_{n}"] for n in self._names}

    def act(self, actions: Sequence[str]) -> bool:
        """``warning`` logs and ``exception`` raises if any condition was met; True if none was."""
        met = {n: k for n, k in self.counts().items() if k}
        if not met:
            return True
        text = "; ".join(f"{k} rows of {self.what} {n.replace('_', ' ')}, for example {self._seen.get[f'of_{n}']}" for n, k in met.items())
        if "warning" in actions:
            log.warning("checks failed: %s", text)
        if "exception" in actions:
            raise ValueError(text)
        return False


def placed(rows: DataFrame, columns: Sequence[str], what: str) -> Watch:
    """Watch for NULL in a column that places rows."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    return Watch(rows, what, **{f"without_{'_or_'.join(columns)}": missing})


def complete(rows: DataFrame, columns: Sequence[str], what: str) -> DataFrame:
    """``rows``, after one count of those with NULL in a column that places them."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    lost = rows.where(missing).count()
    if lost:
        raise ValueError(f"{lost} rows of {what} have no {' or '.join(columns)}")
    return rows
