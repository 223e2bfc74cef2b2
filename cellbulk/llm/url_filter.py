"""URL verdicts: host and path rules, and a logistic regression for the rest.

The regression sees hashed character n-grams of host and path. It is trained on a
small labelled table of URLs; everything here is DataFrame and Spark ML code in the
JVM, with no Python on the executors.

Defined results: a null URL, or one without ``://``, has empty host and path, fits no
rule and gets the method's verdict. Repeated rows get one row each. Without a single
labelled URL every URL that no rule fits is allowed. Extra columns are carried along. A very
long URL is judged whole.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellbulk.llm.common import lower_ascii, packed, smallest_by_hash, unpacked


class Rule(NamedTuple):
    host: str
    path: str
    block: bool

    @property
    def text(self) -> str:
        return self.host + self.path


URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def with_url_parts(rows: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``."""
    text = F.coalesce(F.col(url), F.lit(""))
    return rows.withColumns({
        "host": lower_ascii(F.regexp_extract(text, URL_PARTS, 1)),
        "path": F.regexp_extract(text, URL_PARTS, 2),
    })


def matching_rule(rules: Sequence[Rule]) -> Column:
    """The longest rule that fits ``host`` and ``path``, as (rule, block), else null.

    Rules become one expression, so their number is bounded: at most 1,000.
    """
    if len(rules) > 1000:
        raise ValueError("rules are compiled into one expression; pass at most 1,000")
    found = F.lit(None).cast("struct<rule:string,block:boolean>")
    ordered = sorted(rules, key=lambda r: (len(r.text), len(r.host)))
    for rule in ordered:  # the longest ends up outermost and is tested first
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        found = F.when(
            fits & F.col("path").startswith(rule.path),
            F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.block).alias("block")),
        ).otherwise(found)
    return found


def char_ngrams(sizes: Sequence[int] = (3, 4)) -> Column:
    """Character n-grams of host and path with marks at both ends and between them."""
    chars = F.split(F.concat(F.lit("^"), F.col("host"), F.lit("|"), F.col("path"), F.lit("$")), "")

    def of(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.size(chars) - (n - 1))
        grams = F.transform(starts, lambda i: F.concat(*[F.get(chars, i + (k - 1)) for k in range(n)]))
        return F.when(F.size(chars) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(*[of(n) for n in sizes])


def hashed(rows: DataFrame, buckets: int) -> DataFrame:
    counted = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets, binary=True)
    return counted.transform(rows.withColumn("grams", char_ngrams())).drop("grams")


def labelled_urls(judged: DataFrame, most: int = 4000) -> DataFrame:
    """Distinct (host, path, label) of URLs that a rule decides: at most ``most`` per label,
    the smallest by hash. This bounds the training table, not what is judged."""
    known = judged.where("rule is not null").select(
        "host", "path", F.col("block").cast("double").alias("label"))
    counts = {r.label: r.n for r in known.groupBy("label").agg(
        F.approx_count_distinct(F.struct("host", "path")).alias("n")).collect()}

    def some(label: float) -> DataFrame:
        own = known.where(F.col("label") == label).distinct()
        return smallest_by_hash(own, ["host", "path"], most, counts.get(label, 0))

    return some(0.0).unionByName(some(1.0))


def train(labelled: DataFrame, buckets: int = 1 << 13):
    """Logistic regression on (host, path, label); None without rows."""
    rows = hashed(labelled, buckets).select("features", "label").cache()
    try:
        if rows.isEmpty():
            return None
        return LogisticRegression(maxIter=25, regParam=0.01, standardization=False).fit(rows)
    finally:
        rows.unpersist()


def judge(urls: DataFrame, rules: Sequence[Rule], url: str = "url",
          labelled: DataFrame | None = None, buckets: int = 1 << 13) -> DataFrame:
    """Adds host, path, rule, verdict and block_score (the method's probability of block),
    in place of columns of these names.

    ``labelled`` is a table (host, path, label); left out, it is drawn from the URLs that
    the rules decide.
    """
    parted = with_url_parts(packed(urls, url=F.col(url)), "url").withColumn("_fit", matching_rule(rules))
    judged = parted.withColumns({"rule": F.col("_fit.rule"), "block": F.col("_fit.block")}).drop("_fit")
    model = train(labelled_urls(judged) if labelled is None else labelled, buckets)
    if model is None:
        scored = judged.withColumn("block_score", F.lit(0.0))
    else:
        scored = model.transform(hashed(judged, buckets)).withColumn(
            "block_score", vector_to_array("probability")[1] if model.numClasses > 1 else F.lit(0.0))
    blocked = F.coalesce(F.col("block"), F.col("block_score") >= 0.5)
    return unpacked(scored.withColumn("verdict", F.when(blocked, "block").otherwise("allow")),
                    urls.columns, "host", "path", "rule", "verdict", "block_score")
