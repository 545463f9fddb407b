"""The page store: numbering, freshness, upserts, work lists, and page choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankloom.functions.text import content_hash, extractive_summary, is_blank, truncate_for_profile

#: Ids in one step of number_pages().
STEP = 8192
PAGE_SCHEMA = T.StructType(
    [
        T.StructField("file_sha256", T.StringType(), False),
        T.StructField("rel_path", T.StringType(), False),
        T.StructField("filename", T.StringType(), False),
        T.StructField("file_type", T.StringType(), False),
        T.StructField("size_bytes", T.LongType(), False),
        T.StructField("mtime_ns", T.LongType()),
        T.StructField("page_number", T.IntegerType(), False),
        T.StructField("doc_content", T.StringType(), False),
        T.StructField("content_sha256", T.StringType(), False),
        T.StructField("content_chars", T.IntegerType(), False),
        T.StructField("summary", T.StringType()),
        T.StructField("summary_model", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)
EMBEDDING_SCHEMA = T.StructType(
    [T.StructField("rel_path", T.StringType(), False), T.StructField("page_number", T.IntegerType(), False), T.StructField("model", T.StringType(), False), T.StructField("dims", T.IntegerType(), False), T.StructField("vec", T.ArrayType(T.FloatType()), False)]
)
SUMMARY_MODEL = "extractive_v1"


def number_pages(rows: DataFrame, file: str, id_col: str, out: str = "page") -> DataFrame:
    """Numbers from 1 in each file in the order of a whole-number id.

    A file's ids fall into steps of STEP; counts of the steps before (a small table) plus the place in the own
    step give the number, so no task sorts a whole file, however large.
    """
    step = rows.withColumn("__step", F.floor(F.col(id_col) / STEP).cast("long"))
    counts = step.groupBy(file, "__step").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(file).orderBy("__step").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(file).alias("__file"), F.col("__step").alias("__s"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(file, "__step").orderBy(id_col)
    return (
        step.withColumn("__at", F.row_number().over(within))
        .join(starts, F.col(file).eqNullSafe(F.col("__file")) & (F.col("__step") == F.col("__s")))
        .withColumn(out, (F.col("__start") + F.col("__at")).cast("int"))
        .drop("__step", "__at", "__file", "__s", "__start")
    )


def complete_pages(rows: DataFrame) -> DataFrame:
    """Loaded pages (file_sha256, rel_path, ..., doc_content, metadata) with digest, length and summary."""
    text = F.coalesce("doc_content", F.lit(""))
    own = rows.withColumns({"doc_content": text, "content_sha256": content_hash(text), "content_chars": F.length(text), "summary": extractive_summary(text), "summary_model": F.lit(SUMMARY_MODEL)})
    return own.select(*[F.col(f.name).cast(f.dataType) for f in PAGE_SCHEMA])


def fill_summaries(pages: DataFrame) -> DataFrame:
    """Pages with the extractive summary where summary or its model is missing or blank."""
    lacks = is_blank("summary") | is_blank("summary_model")
    return pages.withColumns({"summary": F.when(lacks, extractive_summary("doc_content")).otherwise(F.col("summary")), "summary_model": F.when(lacks, F.lit(SUMMARY_MODEL)).otherwise(F.col("summary_model"))})


def freshness(pages: DataFrame, listing: DataFrame, file: str = "rel_path") -> DataFrame:
    """state of each file of listing (file, size_bytes, mtime_ns) against its stored pages: fresh, or why it is stale."""
    own = pages.groupBy(file).agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{n}_{c}") for c in ("size_bytes", "mtime_ns", "page_number") for n, f in (("lo", F.min), ("hi", F.max))],
        F.count_distinct("page_number").alias("n_pages"),
    )
    mixed = lambda c: (F.col(f"lo_{c}") != F.col(f"hi_{c}")) | (F.col(f"lo_{c}") != F.col(c))
    state = (
        F.when(F.col("n").isNull(), "missing")
        .when(mixed("size_bytes"), "size")
        .when(F.coalesce(mixed("mtime_ns"), F.col("mtime_ns").isNotNull()), "mtime")
        .when((F.col("lo_page_number") != 1) | (F.col("hi_page_number") != F.col("n")) | (F.col("n_pages") != F.col("n")), "pages")
        .otherwise("fresh")
    )
    return listing.join(own, file, "left").select(file, state.alias("state"))


def upsert(stored: DataFrame, new: DataFrame, keys: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """stored with the rows of new in place of those of equal keys; columns in keep fall back to the stored value where null."""
    if keep:
        old = stored.select(*keys, *[F.col(c).alias(f"__{c}") for c in keep])
        new = new.join(old, keys, "left").withColumns({c: F.coalesce(c, f"__{c}") for c in keep}).drop(*[f"__{c}" for c in keep])
    return stored.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replace_files(stored: DataFrame, new: DataFrame, file: str = "rel_path") -> DataFrame:
    """stored with whole files replaced, so pages that a file no longer has don't stay."""
    return upsert(stored, new, [file])


def missing(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not done yet: the work list of a resumed or cached step."""
    return rows.join(done.select(*keys).distinct(), keys, "left_anti")


def cached_or_missing(rows: DataFrame, cache: DataFrame, keys: list[str], model_tag: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their cached value of this model tag, and those without one."""
    own = cache.filter(F.col("model_tag") == model_tag).select(*keys, "value")
    return rows.join(own, keys), rows.join(own, keys, "left_anti")


def best_page(pages: DataFrame, entities: DataFrame | None = None, least_chars: int = 200, first: int = 10) -> DataFrame:
    """The page of each file (file, page, text, chars) to write queries from.

    Among its first `first` pages of least_chars or more: those that hold an entity of the file (file, entity),
    if any; then the longest; then the earliest.
    """
    w = Window.partitionBy("file").orderBy("page")
    head = pages.filter(F.col("chars") >= least_chars).withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= first)
    hit: Column = F.lit(False)
    if entities is not None:
        sets = entities.filter("entity <> ''").groupBy("file").agg(F.collect_set(F.lower("entity")).alias("__e"))
        head = head.join(sets, "file", "left")
        hit = F.coalesce(F.exists("__e", lambda e: F.lower("text").contains(e)), F.lit(False))
    order = Window.partitionBy("file").orderBy(hit.desc(), F.col("chars").desc(), "page")
    return head.withColumn("__hit", hit).withColumn("__n", F.row_number().over(order)).filter("__n = 1").withColumnRenamed("__hit", "has_entity").drop("__n", "__e")


def profile_excerpt(pages: DataFrame, most_pages: int = 3, max_chars: int = 2500) -> DataFrame:
    """file, excerpt: its first pages, cut and labelled; files whose first pages are all blank have none."""
    w = Window.partitionBy("file").orderBy("page")
    head = pages.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= most_pages)
    cut = head.select("file", "page", truncate_for_profile("text", max_chars).alias("t")).filter("t <> ''")
    label = F.concat(F.lit("--- PAGE "), F.col("page").cast("string"), F.lit(" ---\n"), F.col("t"))
    return cut.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", label.alias("x")))), lambda r: r["x"]), "\n\n").alias("excerpt"))


def counts_by(rows: DataFrame, by: str, chars: str) -> DataFrame:
    """n and total characters per kind, the largest first."""
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n_pages"), F.sum(F.col(chars).cast("long")).alias("total_chars")).orderBy(F.col("n_pages").desc(), by)


def coverage(pages: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """One row: pages that can be embedded, have a vector, and lack one."""
    own = pages.filter(~is_blank("text")).select(key).join(vectors.select(key, F.lit(1).alias("__v")).distinct(), key, "left")
    return own.agg(F.count(F.lit(1)).alias("total"), F.count("__v").alias("embedded"), F.count_if(F.col("__v").isNull()).alias("missing"))
