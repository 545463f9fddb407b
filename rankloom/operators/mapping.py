"""Where a context comes from: equal, contained and partly contained texts.

Contexts are the query side: their parts travel to the pages in bounded blocks as one automaton, which
finds all of them in a single pass over each page's text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.functions.refs import format_ref
from rankloom.functions.text import basename, is_blank, normalize_ws, strip, strip_hop
from rankloom.plans.shared import materialize, ship

#: Bytes of contexts that one pass over the pages takes along.
BLOCK_BYTES = 8 << 20
CHUNK, HEAD, EDGE = 100, 100, 50


def fuzzy_parts(ctx: str) -> list[tuple[str, str]]:
    """(how, part): whole text; aligned chunks of the first 500 characters; first and last 50 characters."""
    out = [("whole", ctx)]
    if len(ctx) > CHUNK:
        out += [("chunk", c) for i in range(0, min(len(ctx), 500), CHUNK) if len(c := ctx[i : i + CHUNK]) > EDGE]
    if len(ctx) > EDGE:
        out += [("edge", ctx[:EDGE]), ("edge", ctx[-EDGE:])]
    return out


def strict_parts(ctx: str) -> list[tuple[str, str]]:
    return [("whole", ctx), *([("head", ctx[:HEAD])] if len(ctx) > HEAD else [])]


def _blocks(contexts: DataFrame, most: int) -> Iterator[list[tuple[int, str]]]:
    held, size = [], 0
    for r in contexts.orderBy("c").toLocalIterator():
        held.append((r["c"], r["ctx"]))
        size += len(r["ctx"]) * 4
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def contained(contexts: DataFrame, pages: DataFrame, parts=fuzzy_parts, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """c, id, how, overlap of each context (c, ctx) and page (id, txt) of which one holds the other, or a part of it.

    how: "whole" (context in page), "within" (page in context), or the kind of a part; overlap in characters.
    Blank contexts and pages match nothing.
    """
    spark: SparkSession = pages.sparkSession
    ship(spark)
    given = pages.select(F.col("id").cast("long").alias("id"), F.col("txt"))
    passes = []
    for block in _blocks(contexts.filter("ctx <> ''").select(F.col("c").cast("long").alias("c"), "ctx"), block_bytes):
        sent = spark.sparkContext.broadcast(block)  # block_bytes of text at most, or one context

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            import ahocorasick

            found: dict[str, set[tuple[int, str]]] = {}
            for c, ctx in sent.value:
                for how, part in parts(ctx):
                    found.setdefault(part, set()).add((c, how))
            auto = ahocorasick.Automaton()
            for part, whose in found.items():
                auto.add_word(part, (len(part), sorted(whose)))
            auto.make_automaton()
            longest = max(len(ctx) for _, ctx in sent.value)
            for batch in batches:
                rows: set[tuple[int, int, str, int]] = set()
                for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    text = t.as_py()
                    if not text:
                        continue
                    for _, (n, whose) in auto.iter(text):
                        rows.update((c, i, how, n) for c, how in whose)
                    if len(text) <= longest:
                        rows.update((c, i, "within", len(text)) for c, ctx in sent.value if text in ctx)
                c, i, how, n = zip(*sorted(rows), strict=True) if rows else ((),) * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array(i, pa.int64()), pa.array(how, pa.string()), pa.array(n, pa.int64())], ["c", "id", "how", "overlap"])

        passes.append(given.mapInArrow(run, "c long, id long, how string, overlap long"))
    return reduce(DataFrame.unionByName, passes) if passes else spark.createDataFrame([], "c long, id long, how string, overlap long")


def find_sources(contexts: DataFrame, pages: DataFrame) -> DataFrame:
    """c, id of every page (id, text) that matches a context (c, text) in any way; lower-cased and stripped first."""
    ctx = contexts.select("c", strip(F.lower(strip_hop(F.coalesce("text", F.lit(""))))).alias("ctx"))
    own = pages.select("id", strip(F.lower(F.coalesce("text", F.lit("")))).alias("txt"))
    return contained(ctx, own).select("c", "id").distinct()


def find_source_strict(contexts: DataFrame, pages: DataFrame) -> DataFrame:
    """c, id, level: the one page (id, text) that each context (c, text) comes from.

    Levels: 1 equal, 2 equal with single spaces, 3 the longest containment, 4 that with single spaces, 5 the first
    100 characters.  The lowest level that matches counts; then the larger overlap; then the smaller id.
    Hop markers are stripped at all levels.  Contexts without a match have no row.
    """
    ctx = materialize(contexts.select(F.col("c").cast("long").alias("c"), strip_hop(F.coalesce("text", F.lit(""))).alias("t")).select("c", strip(F.lower("t")).alias("ctx"), normalize_ws("t").alias("flat")).filter("ctx <> ''"), "contexts")
    own = pages.filter(~is_blank("text")).select(F.col("id").cast("long").alias("id"), strip(F.lower("text")).alias("txt"), normalize_ws("text").alias("pflat"))
    first = lambda key: own.groupBy(F.sha2(F.col(key).cast("binary"), 256).alias("h")).agg(F.min("id").alias("id"))
    by_hash = lambda col, key, level: ctx.withColumn("h", F.sha2(F.col(col).cast("binary"), 256)).join(first(key), "h").select("c", "id", F.lit(level).alias("level"))
    equal = by_hash("ctx", "txt", 1).unionByName(by_hash("flat", "pflat", 2))
    equal = materialize(equal.groupBy("c").agg(F.min(F.struct("level", "id")).alias("m")).select("c", "m.id", "m.level"), "equal-contexts")
    rest = materialize(ctx.join(equal, "c", "left_anti"), "other-contexts")
    exact = contained(rest.select("c", "ctx"), own.select("id", "txt"), lambda x: [("whole", x)]).withColumn("level", F.lit(3))
    flat = contained(rest.select("c", F.col("flat").alias("ctx")), own.select("id", F.col("pflat").alias("txt")), strict_parts)
    flat = flat.withColumn("level", F.when(F.col("how") == "head", 5).otherwise(4)).withColumn("overlap", F.when(F.col("how") == "head", 0).otherwise(F.col("overlap")))
    found = exact.unionByName(flat).groupBy("c").agg(F.min(F.struct("level", (-F.col("overlap")).alias("o"), "id")).alias("m"))
    return equal.unionByName(found.select("c", "m.id", "m.level"))


def source_columns(rows: DataFrame, matches: DataFrame, pages: DataFrame) -> DataFrame:
    """rows (r, ...) with the five source columns, from matches (r, id) and pages (id, path, page).

    Lists are JSON in the order of page ids; a row without a source has "unknown" in each.
    """
    keys = pages.select("id", basename("path").alias("file"), "page")
    found = matches.select("r", "id").distinct().join(keys, "id").withColumn("ref", format_ref("file", "page"))
    w = Window.partitionBy("r", "ref").orderBy("id")
    found = found.withColumn("__n", F.row_number().over(w)).filter("__n = 1")
    lists = found.groupBy("r").agg(F.sort_array(F.collect_list(F.struct("id", "file", "page", "ref"))).alias("x"))
    lists = lists.select("r", F.array_distinct("x.file").alias("files"), F.col("x.ref").alias("refs"), F.col("x.page").alias("pages"))
    unknown = F.array(F.lit("unknown"))
    out = rows.join(lists, "r", "left").withColumns({"files": F.coalesce("files", unknown), "refs": F.coalesce("refs", unknown), "pages": F.coalesce("pages", F.array(F.lit(None).cast("int")))})
    return out.withColumns(
        {
            "source_files": F.to_json("files"),
            "source_files_with_pages": F.to_json("refs"),
            "page_numbers": F.to_json("pages"),
            "source_files_readable": F.array_join("files", ", "),
            "source_files_with_pages_readable": F.array_join("refs", ", "),
        }
    ).drop("files", "refs", "pages")


def first_page(refs: DataFrame, pages: DataFrame) -> DataFrame:
    """refs (file, page, ...) with doc_content of the page; of several files of one name the smallest path counts."""
    w = Window.partitionBy("file", "page").orderBy("path")
    own = pages.select(basename("path").alias("file"), "page", "path", F.col("text").alias("doc_content")).withColumn("__n", F.row_number().over(w)).filter("__n = 1")
    return refs.join(own.drop("__n", "path"), ["file", "page"], "left")


def positive_content(rows: DataFrame, pages: DataFrame) -> DataFrame:
    """r, content: the pages of each row's references (r, refs: array of struct file, page), in their order, a blank line between."""
    each = rows.select("r", F.posexplode("refs").alias("i", "ref")).select("r", "i", "ref.file", "ref.page")
    texts = first_page(each, pages).filter(F.col("doc_content").isNotNull())
    return texts.groupBy("r").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "doc_content"))), lambda x: x["doc_content"]), "\n\n").alias("content"))
