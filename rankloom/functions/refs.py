"""Page references "file (page N)", JSON list columns, and page windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The last " (page " of a reference splits it, so a file name may hold one itself.
REF = r"(?s)\A(.*) \(page ([0-9]{1,9})\)\z"
LOOSE_REF = r"(?s)\A(.+?)\s*\(page\s+([0-9]{1,9})\)\z"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ref(c: str | Column, pattern: str = REF) -> Column:
    """struct<file, page> of a reference; null if it isn't one."""
    c = _col(c)
    pair = F.struct(F.regexp_extract(c, pattern, 1).alias("file"), F.regexp_extract(c, pattern, 2).try_cast("int").alias("page"))
    return F.when(c.rlike(pattern), pair)


def format_ref(file: str | Column, page: str | Column) -> Column:
    """The reference of a page; the bare file name where there is no page."""
    file, page = _col(file), _col(page)
    return F.when(page.isNull(), file).otherwise(F.concat(file, F.lit(" (page "), page.cast("string"), F.lit(")")))


def json_list(c: str | Column) -> Column:
    """A JSON list of strings as an array; anything else as an empty one."""
    c = F.trim(_col(c))
    return F.coalesce(F.when(c.startswith("["), F.from_json(c, "array<string>")), F.array().cast("array<string>"))


def parse_refs(c: str | Column) -> Column:
    """The parsable references of a JSON list column, in order."""
    return F.filter(F.transform(json_list(c), lambda x: parse_ref(x)), lambda r: r.isNotNull())


def reference_contexts(c: str | Column) -> Column:
    """Contexts of a cell: a JSON list, else the trimmed text itself; none if blank."""
    c = F.trim(_col(c))
    parsed = F.from_json(c, "array<string>")
    several = F.when(c.startswith("[") & c.endswith("]"), F.filter(parsed, lambda x: x.isNotNull()))
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.coalesce(several, F.array(c)))


def expand_hard_negatives(c: str | Column) -> dict[str, Column]:
    """hard_negative_files and hard_negative_pages: parallel JSON lists of the parsable references."""
    refs = parse_refs(c)
    return {"hard_negative_files": F.to_json(F.transform(refs, lambda r: r["file"])), "hard_negative_pages": F.to_json(F.transform(refs, lambda r: r["page"]))}


def page_window(page: str | Column, buffer: int = 2) -> Column:
    """The pages within buffer of a page, none below 1."""
    page = _col(page)
    return F.filter(F.sequence(page - buffer, page + buffer), lambda p: p >= 1)
