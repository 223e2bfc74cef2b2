"""MD5 of files of any size, spread over tasks, read in blocks."""

import hashlib
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cellbulk.sources.readers import file_listing

_BLOCK = 8 << 20

# Executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _digest(path: str) -> str:
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path)
    digest = hashlib.md5()
    with filesystem.open_input_stream(inner) as stream:
        while block := stream.read(_BLOCK):
            digest.update(block)
    return digest.hexdigest()


def _with_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        uris = batch["path"].str.replace(r"^file:/+", "file:///", regex=True)
        yield batch.assign(md5=[_digest(uri) for uri in uris])


def file_md5(spark: SparkSession, path: str, name_glob: str | None = None,
             tasks: int | None = None) -> DataFrame:
    """Name, length and MD5 of every file; contents stream through the tasks.

    The listing is dealt round robin to ``tasks``, by default one per file and at most
    10,000; a given number is not coalesced by adaptive execution.
    """
    files = file_listing(spark, path, name_glob)
    spread = files.repartition(tasks or min(10_000, max(1, files.count())))
    return spread.mapInPandas(_with_digests, "path string, name string, length long, md5 string")



def text_md5(text: Column) -> Column:
    """MD5 of the UTF-8 bytes of a text, lower-case hex."""
    return F.md5(text.cast("binary"))
