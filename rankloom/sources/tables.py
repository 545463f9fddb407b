"""Reading and writing datasets, evaluations, profiles, personas and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

REQUIRED = ("user_input", "source_files_with_pages")
PROFILE = T.StructType(
    [
        T.StructField("title_guess", T.StringType()),
        T.StructField("doc_type", T.StringType()),
        T.StructField("summary", T.StringType()),
        *[T.StructField(c, T.ArrayType(T.StringType())) for c in ("topics", "key_entities", "likely_user_intents")],
        T.StructField("confidence", T.DoubleType()),
    ]
)
#: Most entries that a profile keeps of each list.
PROFILE_LIMITS = {"topics": 12, "key_entities": 12, "likely_user_intents": 8}


def read_dataset(spark: SparkSession, path: str, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """A dataset in CSV, JSON (an array, or lines as write_dataset() leaves them), JSON lines or Parquet, by the ending of its path.

    All columns of text files are strings.
    """
    kind = path.rstrip("/").rpartition(".")[2].lower()
    if kind == "csv":
        rows = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    elif kind in ("json", "jsonl"):
        rows = spark.read.options(multiLine=kind == "json" and not _in_lines(spark, path), primitivesAsString=True).json(path)
    elif kind == "parquet":
        rows = spark.read.parquet(path)
    else:
        raise ValueError(f"datasets of kind {kind!r} aren't read")
    if lacking := [c for c in required if c not in rows.columns]:
        raise ValueError(f"{path} lacks the columns {', '.join(lacking)}")
    return rows


def _in_lines(spark: SparkSession, path: str) -> bool:
    """Whether the first line with anything in it is a whole JSON object."""
    line = spark.read.text(path).filter("trim(value) <> ''").select((F.ltrim("value").startswith("{") & F.try_parse_json("value").isNotNull()).alias("whole")).first()
    return bool(line and line["whole"])


def write_dataset(rows: DataFrame, path: str, formats: tuple[str, ...] = ("csv", "json", "parquet")) -> list[str]:
    """Write rows under path, a folder per format; lists and structs go to CSV as JSON.  Unknown formats are refused."""
    if unknown := set(formats) - {"csv", "json", "parquet"}:
        raise ValueError(f"unknown formats: {', '.join(sorted(unknown))}")
    out = []
    for kind in formats:
        nested = [f.name for f in rows.schema if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
        own = rows.withColumns({c: F.to_json(c) for c in nested}) if kind == "csv" and nested else rows
        writer = own.write.mode("overwrite")
        target = f"{path}.{kind}"
        if kind == "csv":
            writer.options(header=True, escape='"').csv(target)
        else:
            getattr(writer, kind)(target)
        out.append(target)
    return out


def write_splits(rows: DataFrame, path: str) -> None:
    """rows with a column split as Parquet, a folder per split."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def read_per_query(spark: SparkSession, path: str, metric: str) -> DataFrame:
    """pos, query, score of an evaluation file's entries; those with an error or without the metric are left out."""
    entries = T.ArrayType(T.StructType([T.StructField("query", T.StringType()), T.StructField("error", T.StringType()), T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())), T.StructField(metric, T.DoubleType())]))
    own = spark.read.schema(T.StructType([T.StructField("per_query", entries)])).option("multiLine", True).json(path)
    each = own.select(F.posexplode("per_query").alias("pos", "e"))
    score = F.coalesce(F.col("e")[metric], F.col("e.metrics")[metric])
    return each.filter(F.col("e.error").isNull() & score.isNotNull()).select(F.col("pos").cast("long").alias("pos"), "e.query", score.alias("score"))


def write_evaluation(summary: DataFrame, per_query: DataFrame, path: str) -> None:
    """A folder with the one-row summary and the per-query records, both JSON."""
    summary.write.mode("overwrite").json(f"{path}/summary")
    per_query.write.mode("overwrite").json(f"{path}/per_query")


def parse_profiles(rows: DataFrame, col: str = "profile_json") -> DataFrame:
    """rows with a struct column profile from JSON, its lists cut to their limits; null where it doesn't parse."""
    p = F.from_json(col, PROFILE)
    fields = [F.slice(p[f.name], 1, PROFILE_LIMITS[f.name]).alias(f.name) if f.name in PROFILE_LIMITS else p[f.name].alias(f.name) for f in PROFILE]
    return rows.withColumn("profile", F.when(p.isNotNull(), F.struct(*fields)))


def format_profile(profile: str = "profile") -> Column:
    """A profile as lines for a prompt; empty parts are left out."""
    p = F.col(profile)
    line = lambda title, value: F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit(f"{title}: "), value))
    joined = lambda c: F.array_join(p[c], ", ")
    return F.concat_ws("\n", line("Title", p["title_guess"]), line("Type", p["doc_type"]), line("Summary", p["summary"]), line("Topics", joined("topics")), line("Entities", joined("key_entities")), line("Intents", joined("likely_user_intents")))


def read_personas(spark: SparkSession, path: str) -> DataFrame:
    """name, role_description from a JSON list, an object with a list "personas", or JSON lines; the first of a name counts.

    Entries without either are an error.
    """
    kind = T.StructType([T.StructField("name", T.StringType()), T.StructField("role_description", T.StringType())])
    raw = spark.read.text(path, wholetext=not path.endswith(".jsonl"))
    if path.endswith(".jsonl"):
        each = raw.filter("trim(value) <> ''").select(F.monotonically_increasing_id().alias("i"), F.from_json("value", kind).alias("p"))
    else:
        listed = F.coalesce(F.from_json("value", T.ArrayType(kind)), F.from_json(F.get_json_object("value", "$.personas"), T.ArrayType(kind)))
        boxed = F.when(F.ltrim("value").startswith("["), F.from_json("value", T.ArrayType(kind))).otherwise(F.from_json(F.get_json_object("value", "$.personas"), T.ArrayType(kind)))
        each = raw.select(F.posexplode(F.coalesce(boxed, listed)).alias("i", "p"))
    rows = each.select("i", "p.name", "p.role_description")
    if not rows.filter("coalesce(trim(name), '') = '' or coalesce(trim(role_description), '') = ''").isEmpty():
        raise ValueError(f"{path} has personas without a name or role_description")
    w = Window.partitionBy("name").orderBy("i")
    return rows.withColumn("n", F.row_number().over(w)).filter("n = 1").orderBy("i").select("name", "role_description")


def update_leaderboard(board: DataFrame, runs: DataFrame, metric: str) -> DataFrame:
    """The best run per config key: an old entry yields only to a strictly better one."""
    ranked = board.withColumn("__new", F.lit(0)).unionByName(runs.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy("config_key").orderBy(F.col(metric).desc_nulls_last(), "__new")
    return ranked.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__new")
