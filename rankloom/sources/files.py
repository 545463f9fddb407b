"""Folders of files as tables of files and of pages."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.functions.text import basename, file_type, relative_path
from rankloom.operators.store import complete_pages
from rankloom.plans.shared import ship

from .loaders import load_pages

#: Fixed: files that are never taken, whatever their ending.
SKIPPED_NAMES = (".ds_store", "thumbs.db", "desktop.ini")
_FILE_ROW = "file_sha256 string, rel_path string, filename string, file_type string, size_bytes long, mtime_ns long"


def _plain_path(c: str) -> Column:
    return F.regexp_replace(F.col(c), r"\Afile:/*", "/")


def listing(spark: SparkSession, root: str, kinds: tuple[str, ...] = (), glob: str | None = None, content: bool = False) -> DataFrame:
    """rel_path, filename, file_type, size_bytes, mtime_ns (whole milliseconds), taken, extension of all files below root, and content if asked.

    Not taken: hidden and junk files, unsupported kinds, and kinds other than those given.  Without content
    no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    raw = (reader.option("pathGlobFilter", glob) if glob else reader).load(root)
    name, kind = basename(F.col("path")), file_type("path")
    wanted = ~F.lower(name).isin(*SKIPPED_NAMES) & ~name.startswith(".") & kind.isNotNull()
    wanted = wanted & kind.isin(*kinds) if kinds else wanted
    plain = _plain_path("path")
    return raw.select(
        relative_path(plain, re.sub(r"^file:/*", "/", root)).alias("rel_path"),
        name.alias("filename"),
        kind.alias("file_type"),
        F.col("length").alias("size_bytes"),
        (F.unix_micros("modificationTime") * 1000).alias("mtime_ns"),
        F.coalesce(wanted, F.lit(False)).alias("taken"),
        F.lower(F.regexp_extract("path", r"(\.[^./\\]+)\z", 1)).alias("extension"),
        *([F.col("content")] if content else []),
    )


def skipped_extensions(files: DataFrame, n: int = 10) -> DataFrame:
    """The most frequent extensions among files not taken."""
    return files.filter("not taken").groupBy("extension").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "extension").limit(n)


def read_pages(spark: SparkSession, root: str, kinds: tuple[str, ...] = (), loaders: dict[str, Callable] | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages of all files below root in the store's schema, and rejected files (rel_path, error)."""
    files = listing(spark, root, kinds, content=True).filter("taken")
    return pages_of(files, loaders)


def pages_of(files: DataFrame, loaders: dict[str, Callable] | None = None) -> tuple[DataFrame, DataFrame]:
    """The same for files (rel_path, filename, file_type, size_bytes, mtime_ns, content): one file that fails stops no other."""
    ship(files.sparkSession)
    given = files.select(F.sha2("content", 256).alias("file_sha256"), "rel_path", "filename", "file_type", "size_bytes", "mtime_ns", "content")
    names = given.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1)
                try:
                    found = [(n, t, list(m.items()), None) for n, t, m in load_pages(own.column(6)[0].as_py(), own.column(2)[0].as_py(), loaders)]
                except Exception as e:  # the file goes to the table of rejected ones
                    found = [(None, None, None, f"{type(e).__name__}: {e}")]
                if not found:
                    continue
                take = pa.array([0] * len(found))
                n, t, m, e = zip(*found, strict=True)
                extra = [pa.array(n, pa.int32()), pa.array(t, pa.string()), pa.array(m, pa.map_(pa.string(), pa.string())), pa.array(e, pa.string())]
                yield pa.RecordBatch.from_arrays([*[own.column(k).take(take) for k in range(6)], *extra], [*names, "page_number", "doc_content", "metadata", "error"])

    rows = given.mapInArrow(run, f"{_FILE_ROW}, page_number int, doc_content string, metadata map<string,string>, error string")
    return complete_pages(rows.filter("error is null")), rows.filter("error is not null").select("rel_path", "error")
