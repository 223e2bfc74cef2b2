"""Column expressions for ratios, Poisson scores, score combination and scaling."""

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from cellbulk import constants as C

LN10 = math.log(10.0)

# Executors need not have this package installed to run the Arrow function below.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def percent(num: Column, den: Column) -> Column:
    return ratio(num, den) * 100.0


def duplicated_pct(reads: Column, fragments: Column) -> Column:
    return percent(reads - fragments, reads)


def nucleosomal_signal(mono: Column, free: Column) -> Column:
    return (1 + mono) / (1 + free)


def tss_enrichment(center: Column, flank: Column, half_smooth: int = C.TSS_HALF_SMOOTH,
                   flank_width: int = C.TSS_FLANK) -> Column:
    """Mean of the central slots over the mean of both flanks plus a pseudocount."""
    center_mean = center / float(2 * half_smooth + 1)
    flank_mean = flank / float(2 * flank_width)
    return center_mean / (flank_mean + C.TSS_PSEUDOCOUNT)


def log_factorial(n: Column) -> Column:
    """ln(n!): exact product up to 20, Stirling's series beyond."""
    x = n.cast("double")
    series = (
        x * F.log(x) - x + 0.5 * F.log(2.0 * math.pi * x)
        + 1.0 / (12.0 * x) - 1.0 / (360.0 * x * x * x)
        + 1.0 / (1260.0 * F.pow(x, F.lit(5.0)))
    )
    small = F.log(F.factorial(F.least(n, F.lit(20)).cast("int")).cast("double"))
    return F.when(n <= 20, small).otherwise(series)


def _log_pmf(k: Column, lam: Column) -> Column:
    """ln P(X = k), for large k from the deviance, which stays exact near the mean."""
    x = F.greatest(k.cast("double"), F.lit(1.0))
    deviance = x * F.log(x / lam) - (x - lam)
    far = -deviance - 0.5 * F.log(2.0 * math.pi * x) - (
        1.0 / (12.0 * x) - 1.0 / (360.0 * x * x * x) + 1.0 / (1260.0 * F.pow(x, F.lit(5.0))))
    return F.when(k <= 20, k * F.log(lam) - lam - log_factorial(k)).otherwise(far)


def poisson_score(k: Column, lam: Column) -> Column:
    """-log10 P(X > k) for X ~ Poisson(lam); NULL unless k and lam are numbers and lam > 0.

    Above the mean the upper tail is summed upwards from k + 1, so it is never taken as
    1 - cdf. Below the mean the lower tail is summed downwards from k. Both series fall
    from their first term; their length grows with the root of lam.
    """
    whole = F.floor(k).cast("long")
    above = whole + 1 > lam
    start = F.when(above, whole + 1).otherwise(F.greatest(whole, F.lit(0)))
    length = F.ceil(12.0 * F.sqrt(lam + start) + 60.0).cast("int")

    def step(acc: Column, i: Column) -> Column:
        term = acc.term * F.when(above, lam / (start + i)).otherwise(
            F.greatest(start - i + 1, F.lit(0)) / lam)
        return F.struct(term.alias("term"), (acc.total + term).alias("total"))

    series = F.aggregate(
        F.sequence(F.lit(1), length), F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
        step, lambda acc: acc.total)
    log_sum = _log_pmf(start, lam) + F.log(series)
    score = F.when(above, -log_sum).otherwise(-F.log1p(-F.exp(log_sum))) / LN10
    sound = k.isNotNull() & lam.isNotNull() & ~F.isnan(k.cast("double")) & ~F.isnan(lam) & (lam > 0)
    return F.when(sound, F.when(whole < 0, F.lit(0.0)).otherwise(score))


def _tail_scores(k: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """``poisson_score`` of numbers; NaN where it is NULL."""
    out = np.full(k.shape, np.nan)
    sound = np.isfinite(k) & np.isfinite(lam) & (lam > 0)
    if not sound.any():
        return out
    k, lam = np.floor(k[sound]), lam[sound]
    above = k + 1 > lam
    start = np.where(above, k + 1, np.maximum(k, 0.0))
    small = np.array([math.lgamma(v + 1.0) for v in range(21)])
    x = np.maximum(start, 1.0)
    far = (-(x * np.log(x / lam) - (x - lam)) - 0.5 * np.log(2.0 * math.pi * x)
           - (1.0 / (12.0 * x) - 1.0 / (360.0 * x**3) + 1.0 / (1260.0 * x**5)))
    near = start * np.log(lam) - lam - small[np.minimum(start, 20).astype(np.int64)]
    log_first = np.where(start <= 20, near, far)
    total, term, live, i = np.ones_like(lam), np.ones_like(lam), np.arange(lam.size), 0
    while live.size:
        i += 1
        ratio = np.where(above[live], lam[live] / (start[live] + i),
                         np.maximum(start[live] - i + 1, 0.0) / lam[live])
        term[live] *= ratio
        total[live] += term[live]
        live = live[term[live] > 1e-17 * total[live]]
    log_sum = log_first + np.log(total)
    lower = -np.log1p(-np.exp(np.where(above, -1.0, log_sum)))
    out[sound] = np.where(k < 0, 0.0, np.where(above, -log_sum, lower) / LN10)
    return out


def _scores(k: pd.Series, lam: pd.Series) -> pd.Series:
    """Segments repeat few pairs, so each distinct pair is worked out once."""
    both = np.empty(len(k), np.complex128)
    both.real, both.imag = k.to_numpy(np.float64, na_value=np.nan), lam.to_numpy(np.float64, na_value=np.nan)
    place, distinct = pd.factorize(both)  # pairs with NaN get place -1, the last of the scores
    return pd.Series(np.append(_tail_scores(distinct.real, distinct.imag), np.nan)[place])  # NaN turns NULL


def segment_scores(extension: int, window: int, genome_size: int):
    """Background and score of segments from their depths and the tags of their set."""
    def derive(columns, carried):
        pileup, near = columns["pileup"], columns["near"]
        place, pairs = pd.factorize(pileup * (near.max(initial=0) + 1) + near)
        first = np.zeros(len(pairs), np.int64)
        first[place[::-1]] = np.arange(len(place))[::-1]
        rate = float(carried["tags"]) * float(extension) / float(genome_size)
        lam = np.maximum(near * float(extension) / float(window), rate)
        return {"lambda": lam, "score": _tail_scores(pileup[first].astype(np.float64), lam[first])[place]}

    return derive


def fisher_scores(extension: int, window: int, genome_size: int):
    """``fisher_combine`` of the scores of several sets from their depths; what is carried are their tags."""
    score = segment_scores(extension, window, genome_size)

    def derive(sets, carried):
        total = sum(score(columns, {"tags": tags})["score"] for columns, tags in zip(sets, carried.values()))
        s = total * LN10
        poly = 1.0
        for i in range(1, len(sets)):
            poly = poly + s**i / float(math.factorial(i))
        return {"value": (s - np.log(poly)) / LN10}

    return derive


# Declared non-deterministic so that a filter on the score is not pushed below it, which
# would plan the function twice: once to filter and once for the rows that are left.
poisson_score_arrow = pandas_udf(_scores, DoubleType()).asNondeterministic()


def fisher_combine(*scores: Column) -> Column:
    """-log10 p of Fisher's method over independent -log10 p scores.

    Twice the summed -ln p follows a chi-squared law with 2n degrees of freedom,
    whose tail is exp(-s) times a sum of n terms.
    """
    total = scores[0]
    for score in scores[1:]:
        total = total + score
    s = total * LN10
    poly = F.lit(1.0)
    for i in range(1, len(scores)):
        poly = poly + F.pow(s, F.lit(float(i))) / float(math.factorial(i))
    return (s - F.log(poly)) / LN10


def symlog(value: Column, linear: Column) -> Column:
    """Linear up to ``linear``, logarithmic beyond; unchanged when it is NULL."""
    size = F.abs(value)
    bent = F.signum(value) * (linear + F.log1p((size - linear) / LN10) / LN10)
    return F.when(linear.isNull() | (size < linear), value.cast("double")).otherwise(bent)


def inverse_symlog(value: Column, linear: Column) -> Column:
    size = F.abs(value)
    bent = F.signum(value) * (linear + LN10 * F.expm1(LN10 * (size - linear)))
    return F.when(linear.isNull() | (size < linear), value.cast("double")).otherwise(bent)


def symlog_width(max_q1_gap: Column, iqr: Column, q1: Column, q3: Column) -> Column:
    """Linear half-width of the symlog scale, NULL where a linear scale will do."""
    return F.when(
        max_q1_gap > 5 * iqr,
        F.greatest(F.lit(1e-3), F.least(F.abs(q1), F.abs(q3))),
    )


def value_slice(value: Column, per_unit: int = 256) -> Column:
    """Monotone slice number of a real value, fine near zero and coarse far out."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * float(per_unit)).cast("long")
