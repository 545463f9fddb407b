"""Paired comparison of two systems: matching, permutation test, bootstrap interval.

Signs and resamples come from hashes, so results are the same on any cluster and in any engine with MD5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .datasets import hash_number
from .store import number_pages

#: Differences that go to every task.
FEW = 1_000_000


def paired(a: DataFrame, b: DataFrame) -> DataFrame:
    """pos, diff of two score tables (pos, query, score): by position where both have as many rows, else by query text.

    By text, the last row of b with a text counts, and rows of a without one drop out.
    """
    if a.count() == b.count():
        return a.select("pos", F.col("score").alias("sa")).join(b.select("pos", F.col("score").alias("sb")), "pos").select("pos", "sa", "sb", (F.col("sa") - F.col("sb")).alias("diff"))
    last = b.groupBy("query").agg(F.max_by("score", "pos").alias("sb"))
    return a.join(last, "query").select("pos", F.col("score").alias("sa"), "sb", (F.col("score") - F.col("sb")).alias("diff"))


def comparison(pairs: DataFrame) -> DataFrame:
    """n_queries, mean_a, mean_b, delta."""
    return pairs.agg(F.count(F.lit(1)).alias("n_queries"), F.avg("sa").alias("mean_a"), F.avg("sb").alias("mean_b"), F.avg("diff").alias("delta"))


def permutation_test(pairs: DataFrame, n: int = 10_000, seed: int = 42) -> DataFrame:
    """p_value: the share of n random sign flips of the differences whose mean is at least as far from 0.

    Each task adds up its own rows' signed differences per flip before n sums are exchanged.
    """
    flips = pairs.select("pos", "diff", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    sign = F.when(F.pmod(hash_number("pos", "i", F.lit(seed)), F.lit(2)) == 0, 1).otherwise(-1)
    sums = flips.groupBy("i").agg(F.round(F.abs(F.sum(F.col("diff") * sign)), 9).alias("s"))
    seen = pairs.agg(F.round(F.abs(F.sum("diff")), 9).alias("observed"))
    return sums.join(F.broadcast(seen)).agg((F.count_if(F.col("s") >= F.col("observed")) / F.lit(float(n))).alias("p_value"))  # one row


def bootstrap_interval(pairs: DataFrame, n: int = 10_000, alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """ci_lower, ci_upper of the mean difference over n resamples of as many rows.

    Resample i draws for slot j the row whose number is the hash of (i, j, seed) modulo the rows: how often each row is
    drawn is counted before it meets the difference.
    """
    rows = pairs.count()
    numbered = number_pages(pairs.select("pos", "diff", F.lit(0).alias("all")), "all", "pos", "at").select("diff", (F.col("at") - 1).cast("long").alias("at"))
    slots = pairs.sparkSession.range(rows).select(F.col("id").alias("j"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    drawn = slots.select("i", F.pmod(hash_number("i", "j", F.lit(seed)), F.lit(max(rows, 1))).alias("at"))
    # The draws look as small as the rows to the planner: they must never be the side that is broadcast.
    both = drawn.join(F.broadcast(numbered), "at") if rows <= FEW else drawn.hint("merge").join(numbered.hint("merge"), "at")  # 16 bytes a row
    means = both.groupBy("i").agg(F.round(F.avg("diff"), 12).alias("m"))
    return means.agg(F.percentile("m", alpha / 2).alias("ci_lower"), F.percentile("m", 1 - alpha / 2).alias("ci_upper"))
