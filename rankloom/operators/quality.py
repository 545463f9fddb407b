"""Verdict filters and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOOD, USABLE = ("good",), ("good", "mediocre")
ANSWERABLE, PARTLY = ("answerable",), ("answerable", "partial")


def passes_strict() -> Column:
    return (F.col("query_quality") == "good") & (F.col("source_answerability") == "answerable")


def passes_relaxed() -> Column:
    return F.col("query_quality").isin(*USABLE) & F.col("source_answerability").isin(*PARTLY)


def apply_verdicts(rows: DataFrame, verdicts: DataFrame, relaxed: bool = False) -> DataFrame:
    """The rows (row_index, ...) whose verdict passes; rows without one fail."""
    keys = verdicts.filter(passes_relaxed() if relaxed else passes_strict()).select("row_index").distinct()
    return rows.join(keys, "row_index", "left_semi")


def drop_unknown(rows: DataFrame, col: str) -> DataFrame:
    """Rows whose list text doesn't hold the word "unknown" (in any case); nulls stay."""
    return rows.filter(~F.coalesce(F.lower(col).contains("unknown"), F.lit(False)))


def filter_judged(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows whose query check passes and then whose source check does; errors and rows without a verdict fail."""
    keys = verdicts.filter("qc = 'pass' and sa = 'pass'").select("row_index").distinct()
    return rows.join(keys, "row_index", "left_semi")


def _share(n: Column, of: Column) -> Column:
    return F.round(n / F.greatest(of, F.lit(1)) * 100, 1)


def vision_report(verdicts: DataFrame, *by: str) -> DataFrame:
    """Counts and rates of query_quality and source_answerability, in all or per group."""
    q, s, n = F.col("query_quality"), F.col("source_answerability"), F.count(F.lit(1))
    strict, relaxed = F.count_if(passes_strict()), F.count_if(passes_relaxed())
    return verdicts.groupBy(*by).agg(
        n.alias("evaluated"),
        *[F.count_if(q == v).alias(f"qc_{v}") for v in ("good", "mediocre", "bad", "error")],
        *[F.count_if(s == v).alias(f"sa_{v}") for v in ("answerable", "partial", "not_answerable", "error")],
        _share(F.count_if(q == "good"), n).alias("good_rate"),
        _share(F.count_if(q.isin(*USABLE)), n).alias("good_or_mediocre_rate"),
        _share(F.count_if(s == "answerable"), n).alias("answerable_rate"),
        _share(F.count_if(s.isin(*PARTLY)), n).alias("answerable_or_partial_rate"),
        strict.alias("strict_kept"),
        _share(strict, n).alias("strict_rate"),
        relaxed.alias("relaxed_kept"),
        _share(relaxed, n).alias("relaxed_rate"),
    )


def validation_report(verdicts: DataFrame, *by: str) -> DataFrame:
    """Counts of qc and sa verdicts and hard-negative verdicts (array hn; skipped ones aren't evaluated).

    fully_passing: both checks pass and every hard negative passes or was skipped.
    answers: array of booleans beside hn, true where a hard negative answers the query (a false negative).
    """
    names = ("pass", "fail", "borderline", "error")
    hn = F.coalesce("hn", F.array().cast("array<string>"))
    count = lambda v: F.sum(F.size(F.filter(hn, lambda x: x == v)).cast("long"))
    full = (F.col("qc") == "pass") & (F.col("sa") == "pass") & F.forall(hn, lambda x: x.isin("pass", "skipped"))
    wrong = F.sum(F.size(F.filter(F.arrays_zip(hn.alias("v"), F.col("answers").alias("a")), lambda x: (x["v"] != "skipped") & x["a"])).cast("long"))
    out = [
        F.count(F.lit(1)).alias("evaluated"),
        *[F.count_if(F.col(c) == v).alias(f"{c}_{v}") for c in ("qc", "sa") for v in names],
        F.sum(F.size(hn).cast("long")).alias("hn_total"),
        *[count(v).alias(f"hn_{v}") for v in (*names, "skipped")],
        F.count_if(full).alias("fully_passing"),
    ]
    return verdicts.groupBy(*by).agg(*out, *([wrong.alias("hn_false_negatives")] if "answers" in verdicts.columns else []))
