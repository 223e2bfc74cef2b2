"""Incremental barcode QC: fragment files are counted as they arrive.

All barcode counters are additive, so each micro-batch writes its own partial sums, which
are merged in tiers as they become many; nothing is kept in streaming state and no
watermark is needed.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cellbulk import schemas
from cellbulk.functions.genomics import accession_of
from cellbulk.operators.annotation import tss_sites
from cellbulk.operators.atac import BARCODE, barcode_counters, tss_band_weights
from cellbulk.session import saved
from cellbulk.streaming.tiers import TieredSums

SUMS = ("num_frags", "raw-num_reads", "raw-mono_nucleosomal_frags",
        "raw-nucleosome_free_frags", "raw-tss_center", "raw-tss_flank")


def fragment_stream(spark: SparkSession, folder: str, files_per_batch: int = 8) -> DataFrame:
    """Fragment files of a folder as a stream, a few files at a time."""
    raw = (spark.readStream.schema(schemas.FRAGMENT).option("sep", "\t")
           .option("maxFilesPerTrigger", files_per_batch)
           .option("recursiveFileLookup", True).csv(folder))
    return raw.select(
        accession_of(F.col("_metadata.file_name")).alias("analysis_set_accession"),
        *schemas.FRAGMENT.names)


def start_counting(stream: DataFrame, chrom_sizes: DataFrame, tss: DataFrame, partials: str,
                   checkpoint: str, once: bool = True) -> StreamingQuery:
    """Add the counters of every micro-batch to the sums below ``partials``.

    A batch that is replayed after a failure changes nothing if its sums were already
    added, and takes their place if they were not. The TSS bands are made once, before
    the stream starts.
    """
    bands = saved(tss_band_weights(tss_sites(tss)), "tss-bands")
    sums = TieredSums(stream.sparkSession, partials, BARCODE, added_up())

    def count(batch: DataFrame, batch_id: int) -> None:
        sums.add(batch_id, lambda: barcode_counters(batch, chrom_sizes, tss, bands=bands))

    writer = stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def added_up() -> list[Column]:
    """How counters of one barcode add up."""
    return [*[F.sum(f"`{c}`").alias(c) for c in SUMS],
            F.bool_or("_on_listed_contig").alias("_on_listed_contig")]


def counters_so_far(spark: SparkSession, partials: str) -> DataFrame:
    """Sum of all batches added so far, in the layout of ``barcode_counters``."""
    return TieredSums(spark, partials, BARCODE, added_up()).total()
