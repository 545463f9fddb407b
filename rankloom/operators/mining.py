"""Hard-negative mining: fused candidate lists, exclusions, and set-wise judging by a verdict table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.refs import page_window
from rankloom.functions.vectors import cosine
from rankloom.plans.shared import materialize

from .bm25 import bm25_topk
from .graph import near_duplicate_flags

RRF_K = 60


@dataclass(frozen=True)
class Limits:
    """Sizes and thresholds of a mining run."""

    pool: int = 200
    rerank_pool: int = 300
    top: int = 150
    min_similarity: float = 0.25
    near_duplicate: float = 0.90
    buffer: int = 2
    per_file: int = 2
    judge_calls: int = 20
    desired: int = 10


def excluded_pages(positives: DataFrame, buffer: int = 2) -> DataFrame:
    """q, file, page of the positives (q, file, page) and the pages within buffer of them."""
    return positives.select("q", "file", F.explode(page_window("page", buffer)).alias("page")).distinct()


def renumbered(rows: DataFrame) -> DataFrame:
    """rows (q, id, ..., rank) ranked anew without gaps."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("rank")).cast("long"))


def first_of_each(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Of the rows of equal `by` the first in the order of a column; the others are suppressed.  Its minimum is taken before the shuffle."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(*by).agg(F.min_by(whole, order).alias("__row")).select("__row.*")


def bm25_candidates(queries: DataFrame, pages: DataFrame, excluded: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, DataFrame]:
    """The BM25 list (q, id, file, page, rank) and the rows that vectors may rerank (q, id, file, page).

    The pool is cut before exclusions; pages: id, file, page, text.
    """
    keys = pages.select("id", "file", "page")
    most = max(limits.pool, limits.rerank_pool)
    scored = materialize(bm25_topk(queries, pages.select("id", "text"), most, zero_scores=True), "bm25").join(keys, "id")
    scored = materialize(scored, "bm25-pages")
    free = scored.join(excluded, ["q", "file", "page"], "left_anti")
    words = renumbered(free.filter((F.col("rank") <= limits.pool) & (F.col("score") > 0))).filter(F.col("rank") <= limits.top)
    return words.select("q", "id", "file", "page", "rank"), free.filter(F.col("rank") <= limits.rerank_pool).select("q", "id", "file", "page")


def vector_rerank(queries: DataFrame, candidates: DataFrame, vectors: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The vector list (q, id, file, page, sim, rank) of the candidates; queries: q, vec; vectors: id, vec."""
    q = queries.select("q", F.col("vec").cast("array<double>").alias("qv"))
    v = vectors.select("id", F.col("vec").cast("array<double>").alias("vec"))
    sims = candidates.join(v, "id").join(q, "q").withColumn("sim", F.round(cosine("qv", "vec"), 6)).filter(F.col("sim") >= limits.min_similarity)
    w = Window.partitionBy("q").orderBy(F.col("sim").desc(), "id")
    return sims.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= limits.top).select("q", "id", "file", "page", "sim", "rank")


def rrf(first: DataFrame, second: DataFrame, k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of two lists (q, id, file, page, rank): q, id, file, page, score, rank.

    A query for which one list is empty takes the other as it is (the same order as its fused one).
    Ties go to the item of the first list, then to its rank there, then to the id.
    """
    one = first.select("q", "id", "file", "page", F.lit(0).alias("list"), "rank")
    both = one.unionByName(second.select("q", "id", "file", "page", F.lit(1).alias("list"), "rank"))
    fused = both.groupBy("q", "id", "file", "page").agg(F.round(F.sum(1 / (F.lit(float(k)) + F.col("rank"))), 9).alias("score"), F.min(F.struct("list", "rank")).alias("seen"))
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), "seen", "id")
    return fused.withColumn("rank", F.row_number().over(w).cast("long")).drop("seen")


def reached(candidates: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of candidates that the walk of judged() asks the judge about; a row without a tier counts as rejected."""
    by_file = Window.partitionBy("q", "file").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("q").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    ok = F.col("tier").isNotNull().cast("int")
    open_rows = candidates.filter(~F.col("near_dup")).withColumn("__in_file", F.coalesce(F.sum(ok).over(by_file), F.lit(0)))
    seen = open_rows.filter(F.col("__in_file") < limits.per_file).withColumn("__judged", F.count(F.lit(1)).over(upto)).withColumn("__accepted", F.coalesce(F.sum(ok).over(upto), F.lit(0)))
    return seen.filter((F.col("__judged") < limits.judge_calls) & (F.col("__accepted") < 2 * limits.desired))


def judged(candidates: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The chosen negatives (q, id, file, page, tier, position) of candidates (q, id, file, page, rank, near_dup, tier).

    Same as walking each list in order: near-duplicates and rows of a file that already gave per_file accepted
    ones are skipped unjudged; the walk ends with judge_calls verdicts or twice the desired accepted ones;
    tier 1 then fills the places before tier 2.  Lists are at most the pool's length.
    """
    kept = reached(candidates, limits).filter(F.col("tier").isNotNull())
    w = Window.partitionBy("q").orderBy("tier", "rank")
    return kept.withColumn("position", F.row_number().over(w).cast("long")).filter(F.col("position") <= limits.desired).select("q", "id", "file", "page", "tier", "position")


def hard_negatives(
    queries: DataFrame, pages: DataFrame, vectors: DataFrame, positives: DataFrame, verdicts: DataFrame, limits: Limits = Limits()
) -> DataFrame:
    """The whole run.  queries: q, text, vec; pages: id, file, page, text; vectors: id, vec; positives: q, id, file, page;
    verdicts: id (and q, if they depend on it), tier.  Without a verdict a candidate is rejected."""
    excluded = materialize(excluded_pages(positives, limits.buffer), "excluded")
    words, pool = bm25_candidates(queries.select("q", "text"), pages, excluded, limits)
    near = vector_rerank(queries.filter(F.col("vec").isNotNull()).select("q", "vec"), pool, vectors, limits)
    fused = materialize(rrf(words, near), "fused")
    flags = near_duplicate_flags(fused, positives.select("q", F.col("id").alias("pos")), vectors, limits.near_duplicate)
    on = ["q", "id"] if "q" in verdicts.columns else ["id"]
    return judged(flags.join(verdicts, on, "left"), limits)
