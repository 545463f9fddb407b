"""Whole jobs over a page store: ingest, embed, profile, generate, mine, validate, evaluate, train, compare.

A job joins operators and writes nothing that it isn't given a place for.  Model calls go through providers, and
every job that makes them works on what is still missing, so a stopped job goes on where it was.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.functions import refs, text
from rankloom.operators import adapter as adapters
from rankloom.operators import datasets, mapping, mining, quality, retrieval, stats, store
from rankloom.operators.providers import Embedder, Generator, complete, embed_missing
from rankloom.sources import files, tables
from rankloom.sources.versions import VersionedTable

from .shared import materialize

PAGE_KEY = ["rel_path", "page_number"]


def page_id() -> Column:
    """A number for a page that its path and page number decide."""
    return F.xxhash64("rel_path", "page_number")


def ingest(spark: SparkSession, folder: str, pages: VersionedTable, kinds: tuple[str, ...] = (), reprocess: bool = False, loaders: dict[str, Callable] | None = None) -> DataFrame:
    """Bring the store up to a folder: files that are new or changed are read, others stay.  Returns the rejected files.

    Pages are keyed by path and replaced file by file.
    """
    stored = pages.read(store.PAGE_SCHEMA)
    listed = files.listing(spark, folder, kinds).filter("taken")
    stale = listed if reprocess else listed.join(store.freshness(stored, listed.select("rel_path", "size_bytes", "mtime_ns")).filter("state <> 'fresh'"), "rel_path", "left_semi")
    stale = materialize(stale.select("rel_path"), "stale-files")
    if stale.isEmpty() and pages.exists():
        return spark.createDataFrame([], "rel_path string, error string")
    content = files.listing(spark, folder, kinds, content=True).join(stale, "rel_path", "left_semi")
    new, rejected = files.pages_of(content, loaders)
    failed = materialize(rejected, "rejected-files")
    pages.write(store.replace_files(stored, materialize(new, "new-pages")), "file_type")
    return failed


def embed(pages: DataFrame, vectors: VersionedTable, make: Callable[[], Embedder], **how) -> DataFrame:
    """Give every page that isn't blank a vector of the provider's model."""
    done = vectors.read(store.EMBEDDING_SCHEMA)
    return vectors.write(done.unionByName(embed_missing(pages, done, make, PAGE_KEY, **how)), "model")


def profile(pages: DataFrame, profiles: VersionedTable, make: Callable[[], Generator]) -> DataFrame:
    """Give every file with text a profile (rel_path, model, profile_json) from its first pages."""
    done = profiles.read("rel_path string, model string, profile_json string")
    excerpt = store.profile_excerpt(pages.select(F.col("rel_path").alias("file"), F.col("page_number").alias("page"), F.col("doc_content").alias("text")))
    todo = store.missing(excerpt.withColumnRenamed("file", "rel_path"), done, ["rel_path"])
    ask = F.concat(F.lit("Describe this document as JSON with title_guess, doc_type, summary, topics, key_entities, likely_user_intents and confidence.\n\n"), "excerpt")
    got = complete(todo, make, ask).select("rel_path", F.lit(make().model).alias("model"), text.json_object("response").alias("profile_json"))
    return profiles.write(done.unionByName(got.filter("profile_json is not null")))


def single_hop(
    pages: DataFrame, make: Callable[[], Generator], n: int, personas: DataFrame | None = None, profiles: DataFrame | None = None, done: DataFrame | None = None, styles: tuple[str, ...] = ("plain",), lengths: tuple[str, ...] = ("short", "medium", "long"), seed: int = 42
) -> DataFrame:
    """n question rows from the best pages of sampled files.  profiles: rel_path, entity; done: rows with row_index to skip.

    Style, length and persona of a row come from the hash of its number, so they don't depend on the cluster.
    """
    own = pages.select(F.col("rel_path").alias("file"), F.col("page_number").alias("page"), F.col("doc_content").alias("text"), F.col("content_chars").alias("chars"))
    entity = profiles.select(F.col("rel_path").alias("file"), "entity") if profiles is not None else None
    best = materialize(store.best_page(own, entity), "best-pages")
    drawn = materialize(datasets.sampled(best.select("file"), n, "file", seed=seed), "drawn-files")
    numbered = drawn.withColumn("row_index", F.xxhash64("file", "draw")).join(best, "file")
    numbered = store.missing(numbered, done, ["row_index"]) if done is not None else numbered
    pick = lambda options, salt: F.element_at(F.array(*map(F.lit, options)), (F.pmod(datasets.hash_number("row_index", F.lit(f"{salt}{seed}")), F.lit(len(options))) + 1).cast("int"))
    rows = numbered.withColumns({"query_style": pick(styles, "s"), "query_length": pick(lengths, "l")})
    people = materialize(datasets.numbered_names(personas, "name"), "personas") if personas is not None else None
    if people is None or not (n_people := people.count()):
        rows = rows.withColumn("persona_name", F.lit("reader"))
    else:
        drawn_at = F.pmod(datasets.hash_number("row_index", F.lit(f"p{seed}")), F.lit(n_people)).cast("long")
        rows = rows.withColumn("at", drawn_at).join(people.withColumnRenamed("name", "persona_name"), "at").drop("at")
    ask = F.concat(F.lit('Write a question that this page alone answers, as JSON {"query", "answer"}. Style: '), "query_style", F.lit(", length: "), "query_length", F.lit(", asked by: "), "persona_name", F.lit("\n\n"), text.truncate_for_judge("text"))
    got = materialize(complete(rows, make, ask), "generated")
    reply = text.json_object("response")
    ref = refs.format_ref(text.basename("file"), "page")
    return (
        got.select("*", F.get_json_object(reply, "$.query").alias("user_input"), F.get_json_object(reply, "$.answer").alias("reference"))
        .filter(~text.is_blank("user_input"))
        .select(
            "row_index",
            "user_input",
            "reference",
            F.to_json(F.array("text")).alias("reference_contexts"),
            F.col("file").alias("rel_path"),
            text.basename("file").alias("source_file"),
            ref.alias("source_file_with_page"),
            F.to_json(F.array(text.basename("file"))).alias("source_files"),
            F.to_json(F.array(ref)).alias("source_files_with_pages"),
            F.to_json(F.array("page")).alias("page_numbers"),
            "persona_name",
            "query_style",
            "query_length",
            F.lit("single_hop").alias("synthesizer_name"),
            text.is_referential("user_input").alias("referential"),
        )
    )


def row_refs(rows: DataFrame, col: str = "source_files_with_pages") -> DataFrame:
    """q, file, page of each row's references (row_index and a JSON list)."""
    return rows.select(F.col("row_index").alias("q"), F.explode(refs.parse_refs(col)).alias("r")).select("q", "r.file", "r.page").distinct()


def corpus(pages: DataFrame, vectors: DataFrame, model: str) -> DataFrame:
    """id, file, page, vec of the pages that have a vector of the model."""
    own = vectors.filter((F.col("model") == model) & (F.size("vec") == F.col("dims")))
    keys = pages.filter(~text.is_blank("doc_content")).select(*PAGE_KEY, "filename")
    return keys.join(own, PAGE_KEY).select(page_id().alias("id"), F.col("filename").alias("file"), F.col("page_number").alias("page"), "vec")


def embed_queries(rows: DataFrame, make: Callable[[], Embedder]) -> DataFrame:
    """q, vec of user_input; rows that fail are left out."""
    none = rows.sparkSession.createDataFrame([], "row_index long, model string")
    return embed_missing(rows.select("row_index", "user_input"), none, make, ["row_index"], "user_input").select(F.col("row_index").alias("q"), "vec")


def evaluate(rows: DataFrame, queries: DataFrame, pages: DataFrame, ks: tuple[int, ...] = retrieval.TOP_K) -> tuple[DataFrame, DataFrame]:
    """Per-query records and a one-row summary of a dataset (row_index, user_input, source_files_with_pages, hard_negatives).

    queries: q, vec; pages: corpus().  Positives that the corpus lacks still count in average precision and ideal gain.
    """
    pages = materialize(pages, "corpus")
    pos = materialize(row_refs(rows), "positives")
    hn = materialize(row_refs(rows, "hard_negatives"), "negatives") if "hard_negatives" in rows.columns else pos.limit(0)
    keys = pages.select("id", "file", "page")
    where = lambda r: r.join(keys, ["file", "page"]).select("q", "id").distinct()
    p, h = where(pos), where(hn)
    known = queries.filter("vec is not null").join(pos.select("q").distinct(), "q", "left_semi")
    ranks = materialize(retrieval.target_ranks(known, pages, p.unionByName(h), exclude_self=False), "ranks")
    n_pos = pos.groupBy("q").agg(F.count(F.lit(1)).alias("n_pos")).join(known.select("q"), "q", "left_semi")
    each = materialize(retrieval.per_query_metrics(ranks.join(p, ["q", "id"], "left_semi"), n_pos, ranks.join(h, ["q", "id"], "left_semi"), ks), "per-query")
    named = each.join(rows.select(F.col("row_index").alias("q"), F.col("user_input").alias("query")), "q")
    summary = retrieval.mean_metrics(each, ks).crossJoin(retrieval.hard_negative_analysis(each)).crossJoin(retrieval.positive_set_diagnostics(each.select("q", "n_pos")).drop("n_queries"))  # one row each
    return named, summary


def judge_prompt() -> Column:
    return F.concat(
        F.lit('Is the PASSAGE relevant to the QUESTION, and does it answer it? Use the passage alone. Reply as JSON {"relevant": yes|no|uncertain, "answerable": yes|no|uncertain, "topical_similarity": high|medium|low|none, "evidence": quote}.\n\nQUESTION:\n'),
        "question",
        F.lit("\n\nPASSAGE:\n"),
        text.truncate_for_judge("passage"),
    )


def judge_candidates(candidates: DataFrame, questions: DataFrame, passages: DataFrame, make: Callable[[], Generator], limits: mining.Limits = mining.Limits(), most_rounds: int = 40) -> DataFrame:
    """q, id, tier of all candidates (q, id, file, page, rank, near_dup) that a walk through each list reaches.

    questions: q, question; passages: id, passage.  A round asks for all rows that the walk meets without a verdict.
    """
    spark = candidates.sparkSession
    candidates = materialize(candidates, "candidates")
    verdicts = spark.createDataFrame([], "q long, id long, tier int")
    for _ in range(most_rounds):
        known = candidates.join(verdicts.withColumn("__has", F.lit(True)), ["q", "id"], "left")
        todo = materialize(mining.reached(known, limits).filter(F.col("__has").isNull()).select("q", "id"), "to-judge")
        if todo.isEmpty():
            return verdicts
        asked = todo.join(questions, "q").join(passages, "id")
        got = complete(asked, make, judge_prompt()).select("q", "id", text.judge_tier("response", "passage").cast("int").alias("tier"))
        verdicts = materialize(verdicts.unionByName(todo.join(got, ["q", "id"], "left").select("q", "id", "tier")), "verdicts")
    raise RuntimeError(f"judging did not end in {most_rounds} rounds")


def mine(rows: DataFrame, queries: DataFrame, pages: DataFrame, vectors: DataFrame, make: Callable[[], Generator], limits: mining.Limits = mining.Limits(), least_chars: int = 100) -> DataFrame:
    """rows with hard_negatives, hard_negative_files and hard_negative_pages (JSON lists)."""
    from rankloom.operators.graph import near_duplicate_flags

    own = materialize(pages.filter(F.col("content_chars") >= least_chars).select(page_id().alias("id"), F.col("filename").alias("file"), F.col("page_number").alias("page"), F.col("doc_content").alias("text")), "candidate-pages")
    pos = materialize(row_refs(rows), "positives")
    ask = rows.select(F.col("row_index").alias("q"), F.col("user_input").alias("text"))
    words, pool = mining.bm25_candidates(ask, own, materialize(mining.excluded_pages(pos, limits.buffer), "excluded"), limits)
    fused = materialize(mining.rrf(words, mining.vector_rerank(queries, pool, vectors, limits)), "fused")
    flags = near_duplicate_flags(fused, pos.join(own.select("id", "file", "page"), ["file", "page"]).select("q", F.col("id").alias("pos")), vectors, limits.near_duplicate)
    verdicts = judge_candidates(flags, ask.withColumnRenamed("text", "question"), own.select("id", F.col("text").alias("passage")), make, limits)
    chosen = mining.judged(materialize(flags, "flags").join(verdicts, ["q", "id"], "left"), limits)
    lists = chosen.groupBy("q").agg(F.to_json(F.transform(F.sort_array(F.collect_list(F.struct("position", refs.format_ref("file", "page").alias("ref")))), lambda x: x["ref"])).alias("hard_negatives"))
    out = rows.drop("hard_negatives").join(lists.withColumnRenamed("q", "row_index"), "row_index", "left").withColumn("hard_negatives", F.coalesce("hard_negatives", F.lit("[]")))
    return out.withColumns(refs.expand_hard_negatives("hard_negatives"))


def validate(rows: DataFrame, pages: DataFrame, make: Callable[[], Generator]) -> DataFrame:
    """row_index, qc, sa, hn (a verdict per hard negative), answers, synthesizer_name from a judge's replies; a failed reply is "error"."""
    store_pages = pages.select(F.col("rel_path").alias("path"), F.col("page_number").alias("page"), F.col("doc_content").alias("text"))
    content = mapping.positive_content(rows.select(F.col("row_index").alias("r"), refs.parse_refs("source_files_with_pages").alias("refs")), store_pages)
    known = rows.join(content.withColumnRenamed("r", "row_index"), "row_index", "left")
    known = known.withColumn("content", F.coalesce("content", F.array_join(refs.reference_contexts("reference_contexts"), "\n\n")) if "reference_contexts" in rows.columns else F.coalesce("content", F.lit("")))
    kinds = ("pass", "fail", "borderline")
    verdict = lambda c: F.coalesce(F.when(F.lower(F.get_json_object(text.json_object(c), "$.verdict")).isin(*kinds), F.lower(F.get_json_object(text.json_object(c), "$.verdict"))), F.lit("error"))
    qc = F.concat(F.lit('Does this question stand by itself? Reply as JSON {"verdict": pass|fail|borderline}.\n\n'), "user_input")
    sa = F.concat(F.lit('Does the SOURCE answer the QUESTION? Reply as JSON {"verdict": pass|fail|borderline}.\n\nQUESTION:\n'), "user_input", F.lit("\n\nSOURCE:\n"), text.truncate_for_judge("content"))
    name = F.col("synthesizer_name") if "synthesizer_name" in rows.columns else F.lit(None).cast("string")
    base = known.select("row_index", "user_input", "content", name.alias("synthesizer_name"))
    checked = complete(complete(base, make, qc, "__qc"), make, sa, "__sa").select("row_index", "synthesizer_name", verdict("__qc").alias("qc"), verdict("__sa").alias("sa"))
    if "hard_negatives" not in rows.columns:
        return checked.withColumns({"hn": F.array().cast("array<string>"), "answers": F.array().cast("array<boolean>")})
    each = rows.select("row_index", "user_input", F.posexplode(refs.parse_refs("hard_negatives")).alias("i", "ref")).select("row_index", "user_input", "i", "ref.file", "ref.page")
    asked = mapping.first_page(each, store_pages)
    ask = F.concat(F.lit('The PASSAGE should be close to the QUESTION and not answer it. Reply as JSON {"verdict": pass|fail|borderline, "answers_the_query": yes|no}.\n\nQUESTION:\n'), "user_input", F.lit("\n\nPASSAGE:\n"), text.truncate_for_judge("doc_content"))
    judged = complete(asked.filter("doc_content is not null"), make, ask, "__hn").select("row_index", "i", verdict("__hn").alias("v"), (text.yes_no(F.get_json_object(text.json_object("__hn"), "$.answers_the_query")) == "yes").alias("a"))
    lost = asked.filter("doc_content is null").select("row_index", "i", F.lit("skipped").alias("v"), F.lit(False).alias("a"))
    lists = judged.unionByName(lost).groupBy("row_index").agg(F.sort_array(F.collect_list(F.struct("i", "v", "a"))).alias("x"))
    return checked.join(lists.select("row_index", F.col("x.v").alias("hn"), F.col("x.a").alias("answers")), "row_index", "left").withColumns(
        {"hn": F.coalesce("hn", F.array().cast("array<string>")), "answers": F.coalesce("answers", F.array().cast("array<boolean>"))}
    )


def keep_passing(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows that name a source and whose query and source checks pass."""
    return quality.filter_judged(quality.drop_unknown(rows, "source_files_with_pages"), verdicts)


def triplets(rows: DataFrame, pages: DataFrame, n_soft: int = 10, seed: int = 42) -> DataFrame:
    """q, pos, neg (page ids), neg_type of a dataset with hard negatives; pages: corpus()."""
    keys = materialize(pages.select("id", "file", "page"), "keys")
    where = lambda r, name: r.join(keys, ["file", "page"]).select("q", F.col("id").alias(name)).distinct()
    pos, neg = materialize(where(row_refs(rows), "pos"), "positives"), materialize(where(row_refs(rows, "hard_negatives"), "neg"), "negatives")
    spread = keys.select("id", F.pmod("id", F.lit(4096)).alias("part"))
    numbered = materialize(_numbered(spread), "numbered")
    soft = datasets.soft_triplets(pos, numbered, neg.withColumnRenamed("neg", "id"), n_soft, seed=seed)
    return datasets.combine(datasets.hard_triplets(pos, neg), soft)


def _numbered(rows: DataFrame) -> DataFrame:
    """at (0, 1, ...) for each id, by parts: counts of the parts before, and the place in the own one."""
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # 4096 rows
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = rows.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("id")) - 1)
    return own.join(starts, "part").select("id", (F.col("start") + F.col("k")).cast("long").alias("at"))


def train_adapter(triples: DataFrame, queries: DataFrame, pages: DataFrame, kind: str = "full_rank", most: int = 200_000, seed: int = 42, **how) -> tuple[adapters.Adapter, DataFrame, list[tuple[float, float]]]:
    """An adapter fitted on the train part of triples (q, pos, neg), the split (q, component, split), and losses per epoch.

    Training takes at most `most` triplets, those of the smallest hash.
    """
    parts = materialize(datasets.split(materialize(datasets.query_components(triples.select("q", "pos").distinct()), "query-components"), seed=seed), "split")
    named = triples.join(parts.select("q", "split"), "q").filter("split in ('train', 'val')")
    few = datasets.shuffled(named, "q", "pos", "neg", seed=seed).limit(most)
    rows = adapters.triplet_vectors(few.select("q", "pos", "neg"), queries, pages.select("id", "vec")).join(parts.select("q", "split"), "q").orderBy("q", "pos", "neg")
    held: dict[str, list[np.ndarray]] = {"train": [], "val": []}
    for r in rows.toLocalIterator():  # `most` rows
        held[r["split"]].append(np.array([r["qv"], r["pv"], r["nv"]], np.float32))
    if not held["train"]:
        raise ValueError("no triplet of the train split has all its vectors")
    own = {k: np.stack(v).astype(float) if v else np.zeros((0, 3, 1)) for k, v in held.items()}
    best, losses = adapters.train(adapters.Adapter.new(kind, own["train"].shape[2]), own["train"], own["val"], seed=seed, **how)
    return best, parts, losses


def metric_delta(a: DataFrame, b: DataFrame, names: list[str]) -> DataFrame:
    """metric, a, b, delta of two one-row summaries."""
    long = lambda df, out: df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias(out)) for n in names])).alias("x")).select("x.*")
    return long(a, "a").join(long(b, "b"), "metric").withColumn("delta", F.col("b") - F.col("a"))


def compare(spark: SparkSession, paths: list[str], metric: str, n: int = 10_000, alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """A row for each pair of evaluation files: means, difference, p-value, interval, and whether p is below alpha."""
    out = []
    for a, b in combinations(paths, 2):
        pairs = materialize(stats.paired(*(materialize(tables.read_per_query(spark, p, metric), "scores") for p in (a, b))), "pairs")
        one = stats.comparison(pairs).crossJoin(stats.permutation_test(pairs, n, seed)).crossJoin(stats.bootstrap_interval(pairs, n, alpha, seed))  # one row each
        out.append(one.select(F.lit(a).alias("file_a"), F.lit(b).alias("file_b"), F.lit(metric).alias("metric"), "*", (F.col("p_value") < alpha).alias("significant")))
    return datasets.combine(*out)
