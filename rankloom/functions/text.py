"""Scalar text functions as column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str methods see it.
SPACE = r"[\s\x1c-\x1f]"
#: Fixed: phrases that point at a text which the reader of a query can't see.
REFERENTIAL = (
    r"\bthis case\b",
    r"\bthis matter\b",
    r"\bthis document\b",
    r"\bthis agreement\b",
    r"\bthe above\b",
    r"\bherein\b",
    r"\bhereinafter\b",
    r"\baforementioned\b",
    r"\bin this (case|matter|document|agreement)\b",
    r"\bthe parties\b",
)
CHUNK, OVERLAP = 3000, 200


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), rf"(?U)\A{SPACE}+|{SPACE}+\z", "")


def collapse(c: str | Column) -> Column:
    return F.regexp_replace(_col(c), rf"(?U){SPACE}+", " ")


def is_blank(c: str | Column) -> Column:
    """Null, or nothing but Unicode white space."""
    c = _col(c)
    return c.isNull() | ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def is_empty(c: str | Column) -> Column:
    """Null, or nothing but spaces."""
    c = _col(c)
    return c.isNull() | (F.trim(c) == "")


def clean(c: str | Column) -> Column:
    """NUL bytes as spaces, then stripped; a null is empty."""
    return strip(F.translate(F.coalesce(_col(c), F.lit("")), "\x00", " "))


def normalize_ws(c: str | Column) -> Column:
    """Lower case with single spaces and none at the ends."""
    return F.trim(collapse(F.lower(_col(c))))


def extractive_summary(c: str | Column, max_chars: int = 450) -> Column:
    """The first max_chars characters with single spaces, without the word that the cut falls in."""
    t = F.trim(collapse(clean(c)))
    head = F.rtrim(F.substring(t, 1, max_chars))
    return F.when(F.length(t) <= max_chars, t).otherwise(F.when(head.contains(" "), F.rtrim(F.regexp_replace(head, r" [^ ]*\z", ""))).otherwise(head))


def truncate_middle(c: str | Column, max_chars: int, head_percent: int) -> Column:
    """Head and tail of a text with dots between where it is longer than max_chars."""
    t, head = clean(c), max_chars * head_percent // 100
    return F.when(F.length(t) <= max_chars, t).otherwise(F.concat(F.substring(t, 1, head), F.lit("\n...\n"), F.right(t, F.lit(max_chars - head))))


def truncate_for_judge(c: str | Column, max_chars: int = 8000) -> Column:
    return truncate_middle(c, max_chars, 65)


def truncate_for_profile(c: str | Column, max_chars: int = 2500) -> Column:
    return truncate_middle(c, max_chars, 70)


def strip_hop(c: str | Column) -> Column:
    """Without a leading hop marker such as <2-hop>."""
    return F.regexp_replace(_col(c), rf"(?Ui)\A{SPACE}*<[0-9]+-hop>{SPACE}*", "")


def is_referential(c: str | Column) -> Column:
    return _col(c).rlike("(?i)" + "|".join(REFERENTIAL))


def json_object(c: str | Column) -> Column:
    """The text from the first { to the last } outside a code fence; null if it doesn't parse."""
    t = strip(c)
    t = F.when(t.startswith("```"), strip(F.regexp_replace(F.regexp_replace(t, r"\A```[a-zA-Z0-9_-]*\n?", ""), "```", ""))).otherwise(t)
    blob = F.regexp_extract(t, r"(?s)\{.*\}", 0)
    return F.when((blob != "") & F.try_parse_json(blob).isNotNull(), blob)


def yes_no(c: str | Column) -> Column:
    s = F.lower(strip(_col(c).cast("string")))
    return F.when(s.isin("yes", "y", "true", "1"), "yes").when(s.isin("no", "n", "false", "0"), "no").otherwise("uncertain")


def topical_similarity(c: str | Column) -> Column:
    s = F.lower(strip(_col(c).cast("string")))
    return F.when(s.isin("high", "h"), "high").when(s.isin("medium", "med", "m", "moderate"), "medium").when(s.isin("low", "l"), "low").otherwise("none")


def judge_tier(verdict_json: str | Column, passage: str | Column) -> Column:
    """1 or 2 for a hard negative by a judge's answer, null for a rejected one.

    "answerable" rejects only with a quote that stands in the passage as the judge saw it; then, and where it is
    doubtful, the rank comes from relevance and topical similarity.
    """
    get = lambda k: F.get_json_object(json_object(verdict_json), f"$.{k}")
    relevant, answerable, topic, quote = yes_no(get("relevant")), yes_no(get("answerable")), topical_similarity(get("topical_similarity")), get("evidence")
    proven = (answerable == "yes") & (F.coalesce(quote, F.lit("")) != "") & truncate_for_judge(passage).contains(quote)
    return (
        F.when(json_object(verdict_json).isNull() | proven | (relevant == "no"), F.lit(None).cast("int"))
        .when((answerable == "no") & (relevant == "yes") & (topic == "high"), 1)
        .when((answerable == "no") & relevant.isin("yes", "uncertain") & topic.isin("high", "medium"), 2)
    )


def sanitize_model(c: str | Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(_col(c), r"[^a-zA-Z0-9]+", "_"), r"\A_+|_+\z", ""))


def file_type(path: str | Column) -> Column:
    """The kind of a supported file by its lower-cased ending; null for others."""
    from rankloom.sources.loaders import FILE_TYPES

    ext = F.lower(F.regexp_extract(_col(path), r"(\.[^./\\]+)\z", 1))
    return F.when(ext.isin(*FILE_TYPES), F.substring(ext, 2, 10))


def basename(path: str | Column) -> Column:
    return F.regexp_extract(_col(path), r"([^/]*)/*\z", 1)


def stem(path: str | Column) -> Column:
    return F.regexp_replace(basename(path), r"(?<=.)\.[^.]*\z", "")


def folder_hints(path: str | Column) -> Column:
    """The folders of a path, outermost first."""
    return F.filter(F.slice(F.split(_col(path), "/"), 1, F.greatest(F.size(F.split(_col(path), "/")) - 1, F.lit(0))), lambda p: p != "")


def relative_path(path: str | Column, root: str) -> Column:
    """path below root; the path itself where it lies elsewhere."""
    p, base = _col(path), root.rstrip("/") + "/"
    return F.when(p.startswith(base), F.substring(p, len(base) + 1, 1 << 30)).otherwise(p)


def under(path: str | Column, folder: str | Column) -> Column:
    """Whether path lies in a folder or is it."""
    p, f = _col(path), F.regexp_replace(F.lit(folder) if isinstance(folder, str) else folder, r"/+\z", "")
    return (p == f) | p.startswith(F.concat(f, F.lit("/")))


def content_hash(c: str | Column) -> Column:
    return F.sha2(_col(c).cast("binary"), 256)


def fingerprint(*cols: Column | str) -> Column:
    """16 hexadecimal digits of the canonical JSON of some columns."""
    return F.substring(F.sha2(F.to_json(F.struct(*cols)).cast("binary"), 256), 1, 16)


def chunks(text: str, size: int = CHUNK, overlap: int = OVERLAP) -> list[str]:
    """Pieces of at most size characters, cut at the last space past the middle, each starting overlap characters back."""
    text = text.strip()
    out, start = [], 0
    while start + size < len(text):
        space = text.rfind(" ", start, start + size)
        end = space if space - start > size // 2 else start + size
        out.append(text[start:end].strip())
        start = max(0, end - overlap)
    out.append(text[start:].strip())
    return [c for c in out if c]


def chunk_text(c: str | Column, size: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """chunks() as an array column; a null text has none."""
    if overlap >= size // 2:
        raise ValueError("overlap must be below half the size")

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: chunks(t, size, overlap) if t else [])

    return run(_col(c))
