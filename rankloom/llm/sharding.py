"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Each (key, shard) pair hashes to a number u in (0, 1); a record goes to the shard with the
largest ``weight / -ln(u)`` (the smaller shard number on a tie).  A shard's score depends on
nothing but the key and that shard, so adding a shard only moves the records the new shard
wins, and removing one only moves the records that it held.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, text_or_empty

#: Rows that one slot bucket holds on average; it bounds the sort that numbers them.
SLOT_BUCKET_ROWS = 20_000


def _score(key: Column, shard: Column, weight: Column | float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, shard), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 53))
    weight = weight if isinstance(weight, Column) else F.lit(float(weight))
    return weight / -F.log(u)


def _best(key: Column, shards: range, weights: Sequence[float]) -> Column:
    if len(shards) <= 256:  # plain expressions stay in generated code
        each = [F.struct(_score(key, F.lit(i), weights[i]).alias("s"), F.lit(-i).alias("i")) for i in shards]
        return each[0] if len(each) == 1 else F.greatest(*each)
    table = F.array(*[F.lit(float(w)) for w in weights])
    return F.array_max(
        F.transform(
            F.sequence(F.lit(shards[0]), F.lit(shards[-1])),
            lambda i: F.struct(_score(key, i, F.element_at(table, i + 1)).alias("s"), (-i).alias("i")),
        )
    )


def rendezvous(key: Column, n_shards: int, weights: Sequence[float] | None = None) -> Column:
    """The shard (0 to n_shards - 1) that wins key; weights default to equal ones.

    A null key is a key like any other, so all null keys share a shard.
    """
    weights = list(weights) if weights is not None else [1.0] * n_shards
    if n_shards < 1 or len(weights) < n_shards or min(weights[:n_shards]) <= 0:
        raise ValueError("n_shards must be positive, with a positive weight for each shard")
    return (-_best(key, range(n_shards), weights)["i"]).cast("int")


def number_slots(df: DataFrame, shard: str, key: Column, order: Sequence[Column], n_rows: int, n_shards: int, out: str) -> DataFrame:
    """Gapless numbers from 0 within each shard, without a task that sees a whole shard.

    Rows fall by key into hash buckets of about SLOT_BUCKET_ROWS rows; a bucket's first number is the
    prefix sum of the counts before it, and only its own rows are sorted to number them.  Rows of
    one key share a bucket, so the key should tell apart all rows that differ.
    """
    buckets = max(1, -(-n_rows // (n_shards * SLOT_BUCKET_ROWS)))
    df = df.withColumn("__bucket", F.pmod(F.xxhash64(F.lit("slot"), key), F.lit(buckets)))
    counts = df.groupBy(shard, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(shard, "__bucket").orderBy(*order)
    return (
        df.withColumn("__at", F.row_number().over(within) - 1)
        .join(starts, [shard, "__bucket"])
        .withColumn(out, (F.col("__start") + F.col("__at")).cast("long"))
        .drop("__bucket", "__at", "__start")
    )


def op1_sharding(spark: SparkSession, sf_dir: str, n_shards: int = 40, weights: Sequence[float] | None = None) -> DataFrame:
    """All documents dealt to 40 shards of equal weight, with their place in each.

    Law ``key``: doc_id and the shard count alone decide.  A null text has no bytes (size 16, CRC
    of the empty text); a null doc_id is one more key, whose rows share a shard but are numbered apart
    by their texts; repeated rows land together in slots next to each other; an empty table gives no rows; further columns are not read.
    """
    docs = documents(spark, sf_dir)
    more = list(weights) if weights is not None else [1.0] * (n_shards + 1)
    text = text_or_empty()
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 16).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        _best(F.col("doc_id"), range(n_shards), more).alias("__won"),
    )
    new = F.struct(_score(F.col("doc_id"), F.lit(n_shards), more[n_shards]).alias("s"), F.lit(-n_shards).alias("i"))
    rows = rows.select(
        "doc_id",
        "size",
        "text_crc32",
        "law",
        (-F.col("__won.i")).cast("int").alias("shard"),
        (-F.greatest(F.col("__won"), new)["i"]).cast("int").alias("grown_shard"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    out = number_slots(rows, "shard", F.struct("doc_id", "text_crc32", "size"), order, docs.select("doc_id").count(), n_shards, "slot")
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
