"""Mixing sources to target weights, in DataFrame operations only.

Every document gets a hash-random key.  Within a source, key ranges of about BUCKET_ROWS rows form
a total order; prefix sums of the ranges' word counts (a small table) plus the running sum inside a
range give each document's place among its source's words, and the source's budget is cut there.
Budgets above a source's size repeat whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, materialize, n_words, text_or_empty, unused

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
#: Rows that one key range of a source holds on average; a range is what one task sorts at least.
BUCKET_ROWS = 5_000
_SPACE = float(16**15)


def random_key(col: str) -> Column:
    """60 hash-random bits of a row's identifier, the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """Water-filling: with source_size per source, the target of each (words).

    Sources in code point order, null last, weigh 3, 1, 2, 3, ... .  They share SHARE of all words by
    weight, none above MOST_EPOCHS times its size; what exceeds that is shared again by weight.  In the
    order of size / weight the first source that fits below its limit fixes the level of all later ones.
    The table has one row per source.
    """
    one = Window.partitionBy(F.lit(0))
    at = F.row_number().over(one.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (at % len(WEIGHTS) + 1).cast("int"))
    ordered = one.orderBy("__ratio", F.col("source").isNull(), F.col("source"))
    before, after = ordered.rowsBetween(Window.unboundedPreceding, -1), ordered.rowsBetween(0, Window.unboundedFollowing)
    filled = (
        sources.withColumn("__w", weight)
        .withColumn("__cap", F.col("source_size") * F.lit(float(MOST_EPOCHS)))
        .withColumn("__ratio", F.col("__cap") / F.col("__w"))
        .withColumn("__all", F.sum("source_size").over(one) * F.lit(SHARE))
        .withColumn("__level", (F.col("__all") - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__w").over(after))
        .withColumn("__fits", F.col("__level") <= F.col("__ratio"))
    )
    level = F.min(F.when(F.col("__fits"), F.struct("__ratio", "__level"))).over(one)["__level"]
    return filled.withColumn("target", F.when(level.isNull(), F.col("__cap")).otherwise(F.least(level * F.col("__w"), F.col("__cap")))).select(
        "source", "source_size", "n_rows", "target"
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", whole: bool = False) -> DataFrame:
    """id, source, size, source_size, target, taken: how many words of each row the mix takes.

    whole=False cuts the document at the edge of the budget to the word; whole=True takes it or leaves
    it, whichever comes nearer.  A null text has no words and is never taken; a text of any length counts whole; null
    sources are a source of their own; rows that repeat are rows of their own; an empty table gives no rows; further
    columns are not read.
    """
    rows = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            n_words(text_or_empty(text_col)).alias("size"),
            random_key(id_col).alias("__key"),
        ),
        "mix",
    )
    stats = materialize(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))), "mix-targets")
    ranges = F.greatest(F.lit(1.0), F.ceil(F.col("n_rows") / BUCKET_ROWS).cast("double"))
    placed = rows.join(_checked(stats.withColumnRenamed("source", "__source")), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    placed = placed.withColumn("__range", F.floor(F.col("__key") * ranges / F.lit(_SPACE)).cast("long"))
    sums = placed.groupBy("source", "__range").agg(F.sum("size").alias("__sum"))
    before = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("source").alias("__source"), F.col("__range").alias("__r"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start")
    )
    within = Window.partitionBy("source", "__range").orderBy("__key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("__in", F.coalesce(F.sum("size").over(within), F.lit(0))).join(
        starts, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__range") == F.col("__r"))
    )
    place = F.col("__start") + F.col("__in")
    budget = F.floor(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    over = budget - epochs * F.col("source_size") - place
    part = F.when(over * 2 >= F.col("size"), F.col("size")).otherwise(F.lit(0)) if whole else F.greatest(F.lit(0), F.least(F.col("size"), over))
    return placed.select("doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"))


def _checked(small: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """Broadcast a written table of a few columns if its rows are counted to be few; else leave it to the planner."""
    return F.broadcast(small) if small.count() <= most_rows else small


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs that whole documents of the mix make up, each as often as it is taken.

    The rows keep their columns, which may have any names.  A document of no words (null, empty) is never taken; texts of any length are
    taken whole; null sources are a source of their own; an empty table gives no rows.  Of rows that share id, source and size,
    as many are taken as the mix takes, those of the smallest text hash most often.
    """
    words, own_id, own_source, own_size, place, nth, times, epoch = unused(docs.columns, "words", "own_id", "own_source", "own_size", "place", "nth", "times", "epoch")
    taken = materialize(mix(docs, id_col, text_col, source_col, whole=True).select("doc_id", "source", "size", "taken"), "mix-taken")
    key = ["doc_id", "source", "size"]
    again = materialize(taken.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*key), "mix-repeats")
    named = {"doc_id": own_id, "source": own_source, "size": own_size}
    at_home = [F.col(id_col).eqNullSafe(F.col(own_id)), F.col(source_col).eqNullSafe(F.col(own_source)), F.col(words) == F.col(own_size)]
    same = at_home[0] & at_home[1] & at_home[2]
    often = F.expr("taken div size").alias(times)
    repeated = [F.col(c).eqNullSafe(F.col(f"r_{c}")) for c in key]
    sized = docs.withColumn(words, n_words(text_or_empty(text_col)))
    some = taken.filter("taken > 0")
    if again.isEmpty():
        joined = sized.join(some.select(*[F.col(c).alias(n) for c, n in named.items()], often), same)
    else:
        # Rows that share a key are numbered on both sides; all others have number 1.
        twice = again.select(*[F.col(c).alias(n) for c, n in named.items()])
        ours = sized.join(twice, same, "left_semi").withColumn(nth, F.row_number().over(Window.partitionBy(id_col, source_col, words).orderBy(F.xxhash64(text_or_empty(text_col)))))
        ours = ours.unionByName(sized.join(twice, same, "left_anti").withColumn(nth, F.lit(1)))
        of_mix = some.join(again.select(*[F.col(c).alias(f"r_{c}") for c in key]), repeated[0] & repeated[1] & repeated[2], "left_semi")
        of_mix = of_mix.withColumn(place, F.row_number().over(Window.partitionBy(*key).orderBy(F.col("taken").desc())))
        rest = some.join(again.select(*[F.col(c).alias(f"r_{c}") for c in key]), repeated[0] & repeated[1] & repeated[2], "left_anti").withColumn(place, F.lit(1))
        theirs = of_mix.unionByName(rest).select(*[F.col(c).alias(n) for c, n in named.items()], place, often)
        joined = ours.join(theirs, same & (F.col(nth) == F.col(place)))
    return joined.withColumn(epoch, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document a mix takes that shares 150% of all words by source weight.

    Nulls, ties and empty tables: see mix().
    """
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


OP8_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)) AS BIGINT) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS pos FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][CAST(pos % 3 AS INT) + 1] AS DOUBLE) AS w, source_size * 2.0::DOUBLE AS cap FROM s),
r AS (SELECT *, cap / w AS ratio, CAST(sum(source_size) OVER () AS DOUBLE) * 1.5::DOUBLE AS total FROM w),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, least(coalesce(arg_min(level, ratio) FILTER (WHERE level <= ratio) OVER () * w, cap), cap) AS target FROM l),
p AS (SELECT d.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - place)) END AS BIGINT) AS taken
FROM p
"""
