"""Statistics behind a QC report: boxes, categories, outliers, input presence."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellbulk.functions import stats as S
from cellbulk.operators.ranking import cumulative_counts, picks_at


def to_long(frame: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(ids, metric, value) rows of numeric columns, NULLs dropped."""
    if not metrics:
        return frame.select(*ids, F.lit("").alias("metric"), F.lit(0.0).alias("value")).where(F.lit(False))
    numeric = frame.select(*ids, *[F.col(f"`{m}`").cast("double").alias(m) for m in metrics])
    return numeric.unpivot(list(ids), list(metrics), "metric", "value").where(
        F.col("value").isNotNull())


def box_stats(long: DataFrame, group: Sequence[str] = ("metric",)) -> DataFrame:
    """Five-number summary by nearest rank, with fences and the symlog choice."""
    group = list(group)
    cumulative = cumulative_counts(long, group, "value")
    last = F.col("total") - 1

    def at(q: float, name: str):
        return F.struct(F.lit(name).alias("name"), F.round(last * q).cast("long").alias("at"))

    wanted = F.array(at(0.0, "min"), at(0.25, "q1"), at(0.5, "median"), at(0.75, "q3"),
                     at(1.0, "max"))
    picked = picks_at(cumulative, wanted)
    stats = picked.groupBy(*group).agg(
        F.max("total").alias("n"),
        *[F.max(F.when(F.col("_pick.name") == name, F.col("value"))).alias(column)
          for name, column in (("min", "min_val"), ("q1", "q1"), ("median", "median"),
                               ("q3", "q3"), ("max", "max_val"))],
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    return stats.select(
        "*",
        F.greatest("min_val", F.col("q1") - 1.5 * F.col("iqr")).alias("low"),
        F.least("max_val", F.col("q3") + 1.5 * F.col("iqr")).alias("high"),
        S.symlog_width(F.col("max_val") - F.col("q1"), F.col("iqr"), F.col("q1"), F.col("q3"))
        .alias("symlog_width"),
    )


def box_stats_approx(long: DataFrame, group: Sequence[str] = ("metric",),
                     accuracy: int = 10_000) -> DataFrame:
    """Quartiles from one approximate aggregation, for interactive looks at large tables."""
    quartiles = F.percentile_approx("value", [0.25, 0.5, 0.75], accuracy)
    return long.groupBy(*group).agg(
        F.count("*").alias("n"), F.min("value").alias("min_val"), F.max("value").alias("max_val"),
        quartiles.alias("_q"),
    ).select(*group, "n", "min_val", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
             F.col("_q")[2].alias("q3"), "max_val")


def metric_sketches(long: DataFrame, group: Sequence[str] = ("analysis_set_accession", "metric"),
                    size: int = 1024) -> DataFrame:
    """(group, n, min_val, max_val, sketch): a KLL sketch of the values of each group.

    Sketches are kept per accession and merged when quantiles are asked for, so a new
    accession costs one pass over its own values. NaN is left out.
    """
    return long.where(~F.isnan("value")).groupBy(*group).agg(
        F.count("value").alias("n"), F.min("value").alias("min_val"), F.max("value").alias("max_val"),
        F.kll_sketch_agg_double("value", F.lit(size)).alias("sketch")).where("n > 0")


def sketched_quantiles(sketches: DataFrame, at: Sequence[float] = (0.25, 0.5, 0.75),
                       group: Sequence[str] = ("metric",)) -> DataFrame:
    """(group, n, quantile, value) from merged sketches.

    The share of values below ``value`` differs from ``quantile`` by less than 0.01 with
    sketches of size 1024 (their published error is 0.005 at 99 % confidence), however many
    were merged; 0 and 1 give the exact minimum and maximum.
    """
    whole = sketches.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min("min_val").alias("min_val"), F.max("max_val").alias("max_val"),
        F.kll_merge_agg_double("sketch").alias("sketch"))

    def value(q: float):
        inner = F.kll_sketch_get_quantile_double("sketch", F.lit(float(q)))
        return F.col("min_val") if q <= 0 else F.col("max_val") if q >= 1 else inner

    return whole.select(*group, "n", F.inline(F.array(*[
        F.struct(F.lit(float(q)).alias("quantile"), value(q).alias("value")) for q in at])))


def rank_errors(quantiles: DataFrame, long: DataFrame, group: Sequence[str] = ("metric",)) -> DataFrame:
    """``quantiles`` with ``error``: how far the quantile lies outside the ranks that its
    value has among ``long``, as a share of all values."""
    group = list(group)
    asked = quantiles.select(*group, "quantile", F.col("value").alias("_at"))
    ranks = long.join(asked, group).groupBy(*group, "quantile").agg(
        F.avg((F.col("value") < F.col("_at")).cast("double")).alias("_below"),
        F.avg((F.col("value") <= F.col("_at")).cast("double")).alias("_upto"))
    q = F.col("quantile")
    return quantiles.join(ranks, [*group, "quantile"]).withColumn(
        "error", F.greatest(F.col("_below") - q, q - F.col("_upto"), F.lit(0.0))).drop("_below", "_upto")


def outliers(long: DataFrame, index: str, most: int = 5, group: Sequence[str] = ("metric",)
             ) -> DataFrame:
    """Up to ``most`` values outside the fences, evenly spaced in value order.

    Which of several equal values stand for a pick is free; the smallest index
    values are taken.
    """
    group = list(group)
    boxes = box_stats(long, group)
    outside = long.join(boxes.select(*group, "low", "high", "symlog_width"), group).where(
        (F.col("value") > F.col("high")) | (F.col("value") < F.col("low")))
    cumulative = cumulative_counts(outside, group, "value")
    shown = F.least(F.col("total"), F.lit(most))
    step = F.coalesce(S.ratio(F.col("total") - 1, shown - 1), F.lit(0.0))
    # Half-way positions round to the even row.
    wanted = F.transform(
        F.sequence(F.lit(0), (shown - 1).cast("int")),
        lambda i: F.struct(F.bround(i * step).cast("long").alias("at")))
    per_value = picks_at(cumulative, wanted).groupBy(*group, "value").agg(
        F.count("*").alias("_picks"))
    ties = Window.partitionBy(*group, "value").orderBy(index)
    # The constant bound lets Spark cut each tie group before the shuffle.
    first = (
        outside.join(per_value, [*group, "value"])
        .withColumn("_rank", F.row_number().over(ties)).where(F.col("_rank") <= most)
    )
    return first.where(F.col("_rank") <= F.col("_picks")).select(
        *group, index, "value",
        S.symlog(F.col("value"), F.col("symlog_width")).alias("scaled_value"))


def category_pct(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of each category per column, NULLs dropped."""
    if not columns:
        return frame.sparkSession.createDataFrame([], "metric string, category string, count long, pct double")
    text = frame.select([F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "metric", "category").where(
        F.col("category").isNotNull())
    counted = long.groupBy("metric", "category").agg(F.count("*").alias("count"))
    # Totals by aggregation: a window would put a metric's categories into one task.
    totals = counted.groupBy("metric").agg(F.sum("count").alias("total"))
    return counted.join(totals, "metric").select(
        "metric", "category", "count", (F.col("count") * 100 / F.col("total")).alias("pct"))


def union_relaxed(*tables: DataFrame) -> DataFrame:
    """All rows of the tables under all their columns; a missing column is NULL.

    Where number types differ a column becomes double, where others differ text.
    """
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double")
    kinds: dict[str, set[str]] = {}
    for table in tables:
        for name, kind in table.dtypes:
            kinds.setdefault(name, set()).add(kind)

    def cast(table: DataFrame) -> DataFrame:
        changed = {name: F.col(f"`{name}`").cast("double" if kinds[name] <= set(numbers) else "string")
                   for name, _ in table.dtypes if len(kinds[name]) > 1}
        return table.withColumns(changed) if changed else table

    whole = cast(tables[0])
    for table in tables[1:]:
        whole = whole.unionByName(cast(table), allowMissingColumns=True)
    return whole


def input_presence(accessions: DataFrame, with_fragments: DataFrame,
                   with_matrix: DataFrame) -> DataFrame:
    """One row per accession and one summary row of input availability."""
    key = "accession"
    listed = accessions.select(key).distinct().withColumn("_listed", F.lit(True))
    frag = with_fragments.select(key).distinct().withColumn("_frag", F.lit(True))
    matrix = with_matrix.select(key).distinct().withColumn("_matrix", F.lit(True))
    joined = listed.join(frag, key, "full").join(matrix, key, "full").na.fill(
        False, ["_listed", "_frag", "_matrix"])
    f, m = F.col("_frag"), F.col("_matrix")
    flags = {"frag": f, "matrix": m, "only-frag": f & ~m, "only-matrix": m & ~f,
             "both": f & m, "neither": ~f & ~m}
    wide = joined.select(key, "_listed", *[c.cast("long").alias(n) for n, c in flags.items()])
    detail = wide.where("_listed").drop("_listed")
    summary = wide.agg(*[F.sum(f"`{n}`").alias(n) for n in flags]).select(
        F.lit("summary").alias(key), *[f"`{n}`" for n in flags]).na.fill(0)
    return summary.unionByName(detail)
