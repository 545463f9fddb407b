"""Knowledge graph tables: nodes per page and chunk, typed edges, cached extractions, and query mixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.text import is_blank, strip

from .graph import entity_overlap, similarity_links
from .store import cached_or_missing


def document_nodes(pages: DataFrame) -> DataFrame:
    """node, type, rel_path, page_number, doc_content of each page (rel_path, page_number, doc_content)."""
    key = F.concat_ws("#", "rel_path", F.col("page_number").cast("string"))
    return pages.select(F.xxhash64(key).alias("node"), F.lit("DOCUMENT").alias("type"), "rel_path", "page_number", "doc_content")


def usable_headlines(nodes: DataFrame) -> DataFrame:
    """Nodes whose column headlines (array) has one that isn't blank and, in any case, stands in the text."""
    text = F.lower("doc_content")
    return nodes.filter(~is_blank("doc_content") & F.coalesce(F.exists("headlines", lambda h: (strip(h) != "") & text.contains(F.lower(strip(h)))), F.lit(False)))


def split_by_headlines(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of nodes at their headlines (in the order of the text), and edges (src, dst, type) from node to chunk.

    Nodes without a headline in their text stay as they are.  Chunks keep the node's path and page.
    """
    low = F.lower("doc_content")
    found = F.filter(F.transform(F.coalesce("headlines", F.array().cast("array<string>")), lambda h: F.when(strip(h) != "", F.instr(low, F.lower(strip(h))))), lambda p: p > 0)
    starts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1)), found)))
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.length("doc_content") + 1))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda s: F.substring(F.col("doc_content"), s["a"], s["b"] - s["a"]))
    cut = nodes.withColumn("__parts", F.filter(parts, lambda p: strip(p) != "")).filter(F.size("__parts") > 1)
    own = cut.select("node", "rel_path", "page_number", F.posexplode("__parts").alias("part", "chunk"))
    chunks = own.select(F.xxhash64("node", "part").alias("node"), F.lit("CHUNK").alias("type"), "rel_path", "page_number", F.col("chunk").alias("doc_content"), F.col("node").alias("parent"))
    return chunks, chunks.select(F.col("parent").alias("src"), F.col("node").alias("dst"), F.lit("child").alias("type"))


def extractions(nodes: DataFrame, cache: DataFrame, kind: str, model_tag: str) -> tuple[DataFrame, DataFrame]:
    """Nodes with the cached value of a kind of extraction and those that need a call."""
    return cached_or_missing(nodes, cache.filter(F.col("kind") == kind), ["rel_path", "page_number"], model_tag)


def write_back(nodes: DataFrame, cache: DataFrame, kind: str, model_tag: str) -> DataFrame:
    """The cache (rel_path, page_number, kind, model_tag, value) with the values of nodes; of a page's nodes the first part counts."""
    w = Window.partitionBy("rel_path", "page_number").orderBy(F.col("type").desc(), "node")
    new = nodes.filter(F.col("value").isNotNull()).withColumn("__n", F.row_number().over(w)).filter("__n = 1").select("rel_path", "page_number", F.lit(kind).alias("kind"), F.lit(model_tag).alias("model_tag"), "value")
    return cache.join(new.select("rel_path", "page_number", "kind"), ["rel_path", "page_number", "kind"], "left_anti").unionByName(new)


def similar_nodes(vectors: DataFrame, threshold: float = 0.5) -> DataFrame:
    """node, n_links, class_id of nodes (id, vec) at a cosine of at least threshold."""
    return similarity_links(vectors, threshold).withColumnRenamed("id", "node")


def entity_edges(entities: DataFrame) -> DataFrame:
    """src, dst, type, jaccard between classes of nodes (node, entity) that share an entity."""
    links, _ = entity_overlap(entities)
    return links.select(F.col("a").alias("src"), F.col("b").alias("dst"), F.lit("entities_overlap").alias("type"), "jaccard")


def candidate_pages(nodes: DataFrame) -> DataFrame:
    """file, page, page_content, vec of document nodes; the last node of a page counts, a summary's vector stands in for a missing one."""
    w = Window.partitionBy("rel_path", "page_number").orderBy(F.col("node").desc())
    vec = F.coalesce("vec", "summary_vec") if "summary_vec" in nodes.columns else F.col("vec")
    own = nodes.filter("type = 'DOCUMENT'").withColumn("__n", F.row_number().over(w)).filter("__n = 1")
    return own.select(F.regexp_extract("rel_path", r"([^/]*)\z", 1).alias("file"), F.col("page_number").alias("page"), F.col("doc_content").alias("page_content"), vec.alias("vec"))


def query_mix(specs: list[str], known: list[str], aliases: dict[str, str] | None = None, usable: set[str] | None = None) -> list[tuple[str, float]]:
    """Shares of query kinds from "name" and "name=weight": repeats add up, kinds that aren't usable drop out, shares sum to 1."""
    weights: dict[str, float] = {}
    for spec in filter(None, map(str.strip, specs)):
        name, _, given = spec.partition("=")
        name = name.strip().lower()
        name = (aliases or {}).get(name, name)
        try:
            w = float(given) if given.strip() else 1.0
        except ValueError:
            raise ValueError(f"{spec!r} has a weight that isn't a number") from None
        if name not in known:
            raise ValueError(f"{name!r} is no kind of query")
        if not w > 0:
            raise ValueError(f"{spec!r} needs a positive weight")
        weights[name] = weights.get(name, 0.0) + w
    kept = {k: w for k, w in weights.items() if usable is None or k in usable}
    if not kept:
        raise ValueError("no kind of query is left")
    return [(k, w / sum(kept.values())) for k, w in kept.items()]


def profiles_of(rows: DataFrame, profiles: DataFrame, most: int) -> DataFrame:
    """r, profiles: formatted profiles (rel_path, text) of a row's sources (r, rel_path), at most `most` distinct ones in path order."""
    w = Window.partitionBy("r").orderBy("rel_path")
    own = rows.select("r", "rel_path").distinct().join(profiles, "rel_path").withColumn("n", F.row_number().over(w)).filter(F.col("n") <= most)
    return own.groupBy("r").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("n", "text"))), lambda x: x["text"]), "\n\n").alias("profiles"))
