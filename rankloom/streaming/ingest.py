"""Incremental ingest: new files of a folder become pages of a store, exactly once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import basename, file_type
from rankloom.sources.files import SKIPPED_NAMES, pages_of

_BINARY = "path string, modificationTime timestamp, length long, content binary"


def ingest_available(spark: SparkSession, folder: str, store: str, checkpoint: str, loaders: dict[str, Callable] | None = None, files_per_batch: int = 1000) -> None:
    """Take all files that came since the last call: pages go to store/pages and failures to store/rejected, by batch.

    A batch writes folders named by its number and overwrites them, so a batch that is run again after a
    failure leaves no row twice.
    """
    raw = spark.readStream.format("binaryFile").schema(_BINARY).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).load(folder)
    name = basename(F.col("path"))
    files = raw.filter(file_type("path").isNotNull() & ~name.startswith(".") & ~F.lower(name).isin(*SKIPPED_NAMES)).select(
        F.col("path").alias("rel_path"), name.alias("filename"), file_type("path").alias("file_type"), F.col("length").alias("size_bytes"), (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"), "content"
    )

    def write(batch: DataFrame, number: int) -> None:
        pages, rejected = pages_of(batch, loaders)
        pages.write.mode("overwrite").parquet(f"{store}/pages/batch={number}")
        rejected.write.mode("overwrite").parquet(f"{store}/rejected/batch={number}")

    query = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))


def stored_pages(spark: SparkSession, store: str) -> DataFrame:
    """The pages of all batches; of a file that came twice the latest batch counts."""
    rows = spark.read.parquet(f"{store}/pages")
    last = rows.groupBy("rel_path").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["rel_path", "batch"], "left_semi").drop("batch")
