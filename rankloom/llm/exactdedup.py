"""Exact dedup as a stateful stream over the documents' files.

The stream keeps keyed state on disk (RocksDB, checkpointed in the shared folder) without expiry: per
digest the winning identifier, that row's content locator (file and row number) and a count.  Texts
never enter the state or its shuffle.  A row whose digest another row has is a hit: hits' full bytes
are compared (grouped by digest and text, with copies folded before the shuffle), and the variant that
the state's locator points at owns the digest.  Texts that share a digest but not their bytes become
groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_path, materialize, text_or_empty

#: Bytes of files that one micro-batch takes.
BATCH_BYTES = 256 << 30
#: Digests of hits up to which every task gets them all; beyond, rows are joined to them.
HIT_ROWS = 500_000
_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _located(rows: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column], *more: Column) -> DataFrame:
    """doc_id, digest and locator of each row, and the columns in more."""
    return rows.select(
        F.col(id_col).alias("doc_id"),
        digest(text_or_empty(text_col)).alias("digest"),
        F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias("locator"),
        *more,
    )


def _best(pick: str) -> Column:
    """The largest (smallest) identifier and its locator, null last; locators break ties."""
    known = F.col("doc_id").isNotNull() if pick == "largest" else F.col("doc_id").isNull()
    return (F.max if pick == "largest" else F.min)(F.struct(known.alias("first"), F.col("doc_id"), F.col("locator")))


def _as_glob(path: str) -> str:
    """A pattern that only path matches: the file source takes a single file as a pattern alone."""
    return path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]"


class StreamingDedup:
    """State of digests seen under a checkpoint; advance() takes the files that came since."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        checkpoint: str,
        id_col: str = "doc_id",
        text_col: str = "text",
        pick: str = "largest",
        digest: Callable[[Column], Column] = sha256,
        batch_bytes: int = BATCH_BYTES,
        files_per_batch: int | None = None,
    ):
        self.spark, self.path, self.checkpoint, self.pick, self.digest = spark, path, checkpoint, pick, digest
        self.id_col, self.text_col, self.limit = id_col, text_col, {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {"maxBytesPerTrigger": str(batch_bytes)}
        self.schema: T.StructType = spark.read.parquet(path).schema

    def advance(self) -> None:
        """Feed all new files through the state and stop; a stopped run resumes where its checkpoint ends."""
        before = {k: self.spark.conf.get(k, None) for k in _CONF}
        for k, v in _CONF.items():
            self.spark.conf.set(k, v)
        try:
            rows = self.spark.readStream.schema(self.schema).options(**self.limit).parquet(_as_glob(self.path))
            state = _located(rows, self.id_col, self.text_col, self.digest).groupBy("digest").agg(_best(self.pick).alias("best"), F.count(F.lit(1)).alias("n"))
            query = state.writeStream.outputMode("update").format("noop").option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
            query.awaitTermination()
            if query.exception():
                raise RuntimeError(str(query.exception()))
        finally:
            for k, v in before.items():
                self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)

    def state(self) -> DataFrame:
        """digest, keep_id, locator, n of every digest seen, read from the checkpointed state."""
        kept = self.spark.read.format("statestore").load(self.checkpoint)
        best = kept.select(F.col("key.digest").alias("digest"), F.col("value.*")).toDF("digest", "best", "n")
        return best.select("digest", F.col("best.doc_id").alias("keep_id"), F.col("best.locator").alias("locator"), "n")

    def groups(self) -> DataFrame:
        """doc_id, keep_id, group_size, kept, digest of every row fed so far.

        A null text counts as empty.  A null id is a row like others but never kept while its group has
        another id.  Of rows that repeat the kept id, the one with the largest locator is kept.  A
        table without rows gives none; further columns are not read.
        """
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        seen = materialize(self.state(), "dedup-state")
        hits = seen.filter("n > 1").select("digest")
        n_hits = hits.count()
        text = text_or_empty(self.text_col)
        held = _located(rows, self.id_col, self.text_col, self.digest, text.alias("text"))
        held = held.join(F.broadcast(hits) if n_hits <= HIT_ROWS else hits, "digest", "left_semi")
        # Full bytes: rows of one digest part into variants of equal text.
        variants = held.groupBy("digest", "text").agg(_best(self.pick).alias("best"), F.count(F.lit(1)).alias("n"))
        variants = materialize(
            variants.select("digest", F.sha2(F.col("text").cast("binary"), 512).alias("variant"), F.octet_length("text").alias("bytes"), F.col("best.doc_id").alias("keep_id"), F.col("best.locator").alias("locator"), "n"),
            "dedup-variants",
        )
        clashes = variants.groupBy("digest").agg(F.count(F.lit(1)).alias("v")).filter("v > 1")
        single = seen.select("digest", "keep_id", "locator", "n")
        mine = _located(rows, self.id_col, self.text_col, self.digest)
        if clashes.isEmpty():
            out = mine.join(single.withColumnRenamed("locator", "__at"), "digest")
        else:
            # A digest that several texts share: its rows are told apart by a second digest and length.
            own = _located(rows, self.id_col, self.text_col, self.digest, F.sha2(text.cast("binary"), 512).alias("variant"), F.octet_length(text).alias("bytes"))
            split = variants.join(clashes.select("digest"), "digest", "left_semi").withColumnRenamed("locator", "__at")
            apart = own.join(split, ["digest", "variant", "bytes"]).drop("variant", "bytes")
            rest = mine.join(clashes.select("digest"), "digest", "left_anti").join(single.withColumnRenamed("locator", "__at"), "digest")
            out = rest.unionByName(apart)
        return out.select("doc_id", "keep_id", F.col("n").cast("long").alias("group_size"), (F.col("locator") == F.col("__at")).alias("kept"), "digest")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays; nulls, ties and empty tables: see StreamingDedup.groups()."""
    path = f"{sf_dir}/documents.parquet"
    dedup = StreamingDedup(spark, path, fresh_path(spark, "dedup-stream"))
    dedup.advance()
    return dedup.groups().withColumnRenamed("digest", "text_sha256")


OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM d WINDOW w AS (PARTITION BY text)
"""
