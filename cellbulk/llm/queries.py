"""One query per corpus operator, over whole tables, and the DuckDB statements for them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk.llm import decontamination, embedding_join, hard_negatives, language_mixture, mixing, phrases, quality, simhash, token_count, token_files, toxicity, url_filter, warc
from cellbulk.llm.common import fold_of, table
from cellbulk.llm.oracles import ORACLES
from cellbulk.session import new_folder, saved

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of every document to shards and read them back."""
    path = new_folder(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"))
    return token_files.write_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "length")


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a capture, read the archives back, assemble transactions."""
    path = new_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    records = saved(warc.read_records(spark, path, with_payload=False), "warc-records")
    return warc.assemble(records).select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"), "refers_to",
        F.col("request.method").alias("request_method"),
        F.col("response.status").alias("http_status"))


@query
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and near-duplicate classes of all embeddings at cosine 0.9."""
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the byte-level vocabulary."""
    return token_count.token_counts(
        table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every document in a mix of sources weighted by the root of their size."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.with_positions(docs)


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tag")


@query
def op8_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items with an edited passage in every document; the columns of
    op8_decontamination are fixed by its SQL."""
    return decontamination.near_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tag")


@query
def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))


# The rules of the URL contract.
URL_RULES = [
    url_filter.Rule("com", "/", False),
    url_filter.Rule("example.com", "/en/", True),
    url_filter.Rule("www.example.com", "/en/", False),
    url_filter.Rule("net", "/es/", True),
    url_filter.Rule("net", "/fr/", True),
]


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "block_score")


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest collocations of every language."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, and all languages it is a mixture of."""
    found = language_mixture.languages(table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 4) == 2)
    return found.withColumn("languages", F.concat_ws(",", "languages"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding, against all embeddings."""
    by_seven = F.col("vec_id") % 7 == 0
    return hard_negatives.hard_negatives(
        table(spark, sf_dir, "embeddings"), anchor=F.col("vec_id") % 50 == 0,
        label=F.when(by_seven, (F.col("label") + 1) % 10).otherwise(F.col("label")))
