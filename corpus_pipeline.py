"""Corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

1. Documents whose quality score is below 0.3 go.
2. One document of each SimHash class stays, the one with the smallest id.
3. Documents that hold a benchmark window go.
4. Sources are mixed to their target weights: the same rows, in the order of the mix.
5. The ids of every document are written to token shards in that order and read back.

Stages 1 to 4 return the columns of ``documents``; the last returns the index rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk.llm import decontamination, mixing, quality, simhash, token_files
from cellbulk.llm.common import table
from cellbulk.llm.queries import tokenizer_file
from cellbulk.session import new_folder, saved


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    placed, order = in_stored_order(docs)
    path = new_folder(spark, "pipeline-tokens")
    token_files.write_tokens(placed, path, tokenizer_file("word_bpe_49k.json"), order=order)
    return token_files.write_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32", "length")


def in_stored_order(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The place of each row in the files it is read from, which the mixing stage wrote in
    the order of the mix, by the number of the part; rows that come from no file are ordered
    by their id."""
    if not docs.inputFiles():
        return docs, ["doc_id"]
    file = F.col("_metadata.file_name")
    number = F.regexp_extract(file, "part-([0-9]+)", 1).try_cast("long")
    return docs.select("doc_id", "text", number.alias("_part"), file.alias("_file"),
                       F.col("_metadata.row_index").alias("_place")), ["_part", "_file", "_place"]


STAGES = [
    ("quality", quality_stage),
    ("near-duplicates", duplicate_stage),
    ("decontamination", benchmark_stage),
    ("mixing", mixing_stage),
    ("token-files", token_stage),
]

# Scores of a trained network and a tokenizer's ids are beyond SQL; tests compare the
# stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
