"""Session helpers: local test sessions and the shared working folder."""

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are planned for. On a cluster pass them to spark-submit;
# partition counts are left to adaptive execution.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}


def local_session(app: str = "cellbulk", cpus: str | int = "*", memory: str = "8g",
                  partitions: int = 8, shared: str | None = None) -> SparkSession:
    """``shared`` names the working folder; left out, the deployment's setting holds."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    The setting is read, never written: a session without it is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(frame: DataFrame, name: str, plain: bool = False) -> DataFrame:
    """Write a small or shared intermediate to the shared folder and read it back.

    The lineage ends there, so a lost executor does not recompute it, and Catalyst
    sees the table's measured size when it chooses between broadcast and shuffle.
    ``plain`` writes without compression or dictionaries: the size is then about that of
    the rows in memory. Tables that may be broadcast are written so, as millions of rows
    that repeat a few values fit into a compressed file below the broadcast threshold.
    """
    path = new_folder(frame.sparkSession, name)
    frame.write.options(**PLAIN if plain else {}).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def saved_bytes(frame: DataFrame) -> int:
    """Size of the files of a frame made by ``saved``; contents are not read."""
    files = frame.inputFiles()
    if not files:
        return 0
    listing = frame.sparkSession.read.format("binaryFile").load(files[0].rsplit("/", 1)[0])
    return listing.agg({"length": "sum"}).first()[0] or 0


def discard(frame: DataFrame) -> None:
    """Delete the files of a frame made by ``saved``; the frame is empty afterwards.

    An empty table overwrites them, so the delete goes through Spark's own writer and
    works on any store.
    """
    spark = frame.sparkSession
    held = frame.inputFiles()
    if not held:
        return
    path = held[0].rsplit("/", 1)[0]
    if not _plain(path).startswith(_plain(shared_dir(spark)) + "/"):
        raise ValueError(f"{path} is not below the shared folder")
    spark.createDataFrame([], frame.schema).write.mode("overwrite").parquet(path)


def _plain(path: str) -> str:
    """A local path without its scheme, however many slashes follow that."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith(("file:", "/")) else path
