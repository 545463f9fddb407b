"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain, count

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.plans.shared import fresh_path, materialize, ship

__all__ = ["WS", "documents", "fresh_path", "materialize", "n_words", "ship", "text_or_empty", "unused", "words"]

#: ASCII white space, as the contracts define it (space and \x09 to \x0D).
WS = r"\x20\x09-\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(col: str | Column = "text") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(""))


def words(text: Column) -> Column:
    """Maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(text, f"[{WS}]+"), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def unused(columns: Iterable[str], *stems: str) -> list[str]:
    """A name for each stem that none of the columns has (names don't tell case apart, as in Spark)."""
    taken, out = {c.lower() for c in columns}, []
    for stem in stems:
        name = next(n for n in chain([stem], (f"{stem}_{k}" for k in count())) if n.lower() not in taken)
        taken.add(name.lower())
        out.append(name)
    return out
