"""BM25 (Okapi) ranking of a query set against all pages.

Term statistics are one aggregation over the corpus.  For scoring, the weights of the queries' own terms travel
to every task in blocks, and each task keeps only its best k per query.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.plans.shared import materialize, ship

from .retrieval import TopK, ranked

K1, B, EPSILON = 1.5, 0.75, 0.25
#: Terms of queries (repeats included) that one pass over the pages takes along.
BLOCK_TERMS = 200_000


def term_frequencies(pages: DataFrame) -> DataFrame:
    """id, dl, term, tf of pages (id, text): lower-cased words between white space.  No shuffle: a page is whole in a task."""
    ship(pages.sparkSession)
    given = pages.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                words = text.as_py().lower().split()
                tf = Counter(words)
                if tf:
                    n = len(tf)
                    yield pa.RecordBatch.from_arrays([pa.array([i.as_py()] * n, pa.int64()), pa.array([len(words)] * n, pa.int64()), pa.array(list(tf)), pa.array(list(tf.values()), pa.int64())], ["id", "dl", "term", "tf"])

    return given.mapInArrow(run, "id long, dl long, term string, tf long")


def statistics(pages: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """term, df (written) of all pages, and n_pages, avg_len and mean_idf.

    Pages are read once: each gives a row per distinct term and one without a term that carries its length.
    """
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    own = F.transform(F.array_distinct("ws"), lambda w: F.struct(w.alias("term"), F.lit(0).cast("long").alias("len")))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.size("ws").cast("long").alias("len")))
    each = pages.select(words.alias("ws")).select(F.explode(F.concat(own, whole)).alias("x")).select("x.*")
    counts = materialize(each.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("len").alias("len")), "document-frequencies")
    total = counts.filter("term is null").first()
    n, df = total["df"] if total else 0, counts.filter("term is not null").select("term", "df")
    idf = F.log(F.lit(float(n)) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    mean = df.agg(F.avg(idf).alias("m")).first()["m"] or 0.0
    return df, {"n_pages": n, "avg_len": (total["len"] or 0) / n if n else 0.0, "mean_idf": mean}


def _weights(queries: DataFrame, df: DataFrame, stats: dict[str, float]) -> DataFrame:
    """q, term, w: each query term's idf times its repeats; a term in over half the pages weighs EPSILON of the mean."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    terms = queries.select(F.col("q").cast("long").alias("q"), F.explode(words).alias("term")).groupBy("q", "term").agg(F.count(F.lit(1)).alias("qtf"))
    idf = F.log(F.lit(float(stats["n_pages"])) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    return terms.join(df, "term").select("q", "term", (F.col("qtf") * F.when(idf < 0, F.lit(EPSILON * stats["mean_idf"])).otherwise(idf)).alias("w"))


def bm25_topk(queries: DataFrame, pages: DataFrame, k: int, zero_scores: bool = False, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """q, id, score, rank: the k best pages (id, text) per query (q, text), scores rounded to 6 places.

    Pages of score 0 or less are left out unless zero_scores; ties go to the smaller id.
    """
    spark = pages.sparkSession
    ship(spark)
    df, stats = statistics(pages)
    weights = materialize(_weights(queries, df, stats), "query-weights")
    given = pages.select(F.col("id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    avg = stats["avg_len"] or 1.0
    all_q = queries.select(F.col("q").cast("long").alias("q")).distinct().orderBy("q")
    passes = []
    for block in _blocks(all_q, weights, block_terms):
        sent = spark.sparkContext.broadcast(block)  # block_terms entries at most, or one query's

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, terms, rows, cols, w = sent.value
            by_term = [(rows[a:b], w[a:b]) for a, b in zip(*_spans(cols, len(terms)), strict=True)]
            top = TopK(len(ids), k)
            for batch in batches:
                for at in range(0, batch.num_rows, 512):
                    part = batch.slice(at, 512)
                    found = np.zeros((part.num_rows, len(ids)))
                    for row, text in zip(found, part.column(1), strict=True):
                        words = text.as_py().lower().split()
                        base = K1 * (1 - B + B * len(words) / avg)
                        for term, tf in Counter(filter(terms.__contains__, words)).items():
                            q, weight = by_term[terms[term]]
                            row[q] += weight * (tf * (K1 + 1) / (tf + base))
                    score = np.round(found.T, 6) + 0.0
                    if not zero_scores:
                        score[score <= 0] = -np.inf
                    top.add(score, part.column(0).to_numpy())
            q, own, s = top.rows()
            yield pa.RecordBatch.from_arrays([pa.array(ids[q]), pa.array(own), pa.array(s)], ["q", "id", "score"])

        passes.append(given.mapInArrow(run, "q long, id long, score double"))
    if not passes:
        return spark.createDataFrame([], "q long, id long, score double, rank long")
    return ranked(reduce(DataFrame.unionByName, passes), k, "score")


def _spans(cols: np.ndarray, n: int) -> tuple[list[int], list[int]]:
    return np.searchsorted(cols, np.arange(n)).tolist(), np.searchsorted(cols, np.arange(n), side="right").tolist()


def _blocks(all_q: DataFrame, weights: DataFrame, most: int) -> Iterator[tuple[np.ndarray, dict[str, int], np.ndarray, np.ndarray, np.ndarray]]:
    """Query ids, term numbers, and per entry query number, term number (sorted) and weight, for blocks of queries."""
    rows = all_q.join(weights.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("x")), "q", "left").orderBy("q").toLocalIterator()
    ids: list[int] = []
    held: list[tuple[int, str, float]] = []

    def packed():
        terms = {t: i for i, t in enumerate(sorted({h[1] for h in held}))}
        each = sorted((terms[t], q, w) for q, t, w in held)
        return np.array(ids, np.int64), terms, np.array([e[1] for e in each], np.int64), np.array([e[0] for e in each], np.int64), np.array([e[2] for e in each], float)

    for r in rows:
        own = r["x"] or []
        if ids and len(held) + len(own) > most:
            yield packed()
            ids, held = [], []
        held += [(len(ids), x["term"], x["w"]) for x in own]
        ids.append(r["q"])
    if ids:
        yield packed()

