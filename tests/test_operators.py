import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankloom.operators import adapter, bm25, centroids, datasets, graph, knowledge, mapping, mining, providers, quality, retrieval, stats, store


def test_ranks_and_metrics_by_hand(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(np.round(rng.normal(size=(60, 4)), 1))]
    rows += [(60, [0.0] * 4), (61, rows[5][1]), (62, None)]
    corpus = spark.createDataFrame(rows, "id long, vec array<double>").repartition(3)
    queries = spark.createDataFrame([(0, rows[0][1]), (7, rows[7][1])], "q long, vec array<double>")
    targets = spark.createDataFrame([(0, 5), (0, 61), (0, 60), (7, 0), (7, 999)], "q long, id long")
    unit = {i: np.array(v) / max(np.linalg.norm(v), 1e-300) for i, v in rows if v}
    order = {}
    for q in (0, 7):
        sims = sorted((-round(float(unit[q] @ u), 6) + 0.0, i) for i, u in unit.items() if i != q)
        order[q] = [i for _, i in sims]
    got = {(r["q"], r["id"]): r["rank"] for r in retrieval.target_ranks(queries, corpus, targets, block_bytes=8).collect()}
    assert got == {(q, i): order[q].index(i) + 1 for q, i in [(0, 5), (0, 61), (0, 60), (7, 0)]}
    top = {}
    for r in retrieval.cosine_topk(queries, corpus, 10, block_bytes=8).collect():
        top.setdefault(r["q"], {})[r["rank"]] = r["id"]
    assert {q: [t[k] for k in sorted(t)] for q, t in top.items()} == {q: o[:10] for q, o in order.items()}


def test_metrics(spark):
    ranks = spark.createDataFrame([(1, 2), (1, 5), (2, 1)], "q long, rank long")
    n = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "q long, n_pos long")
    hn = spark.createDataFrame([(1, 1), (1, 7), (2, 4)], "q long, rank long")
    got = {r["q"]: r for r in retrieval.per_query_metrics(ranks, n, hn).collect()}
    assert got[1]["recall_1"] == 0 and got[1]["recall_5"] == 1 and got[1]["mrr"] == 0.5 and got[1]["mrr_1"] == 0
    assert math.isclose(got[1]["map"], (1 / 2 + 2 / 5) / 3)
    ideal = sum(1 / math.log2(i + 1) for i in (1, 2, 3))
    assert math.isclose(got[1]["ndcg_5"], (1 / math.log2(3) + 1 / math.log2(6)) / ideal)
    assert got[2]["map"] == 1 and got[2]["ndcg_1"] == 1 and got[3]["map"] == 0 and got[3]["first_positive_rank"] is None
    assert got[1]["hard_neg_outranks_positive"] and not got[2]["hard_neg_outranks_positive"] and got[3]["n_hn"] == 0
    whole = retrieval.hard_negative_analysis(retrieval.per_query_metrics(ranks, n, hn)).first()
    assert (whole["queries_with_hard_negatives"], whole["mean_hard_negative_rank"], whole["outranks_share"]) == (2, 4.0, 0.5)


def test_no_queries(spark):
    none = spark.createDataFrame([], "q long, vec array<double>")
    corpus = spark.createDataFrame([(1, [1.0])], "id long, vec array<double>")
    assert retrieval.cosine_topk(none, corpus, 5).count() == 0
    empty = spark.createDataFrame([], "id long, vec array<double>")
    assert retrieval.cosine_topk(spark.createDataFrame([(1, [1.0])], "q long, vec array<double>"), empty, 5).count() == 0


def test_bm25_formula(spark):
    texts = ["the cat sat", "the dog sat on the mat", "the bird", "", None]
    pages = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    queries = spark.createDataFrame([(0, "The cat CAT"), (1, "the"), (2, "zebra"), (3, None)], "q long, text string")
    docs = [(t or "").lower().split() for t in texts]
    n, avg = len(docs), sum(map(len, docs)) / len(docs)
    df = {w: sum(w in d for d in docs) for d in docs for w in d}
    idf = {w: math.log(n - k + 0.5) - math.log(k + 0.5) for w, k in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: 0.25 * mean if x < 0 else x for w, x in idf.items()}

    def score(q, d):
        return round(sum(idf.get(w, 0) * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / avg)) for w in q), 6)

    want = {}
    for q, t in enumerate(["the cat cat".split(), ["the"], ["zebra"], []]):
        hits = sorted((-score(t, d), i) for i, d in enumerate(docs) if score(t, d) > 0)[:3]
        want.update({(q, i): -s for s, i in hits})
    got = {(r["q"], r["id"]): r["score"] for r in bm25.bm25_topk(queries, pages, 3, block_terms=1).collect()}
    assert got == pytest.approx(want)
    assert bm25.bm25_topk(queries, pages, 9, zero_scores=True).count() == 4 * 5


def walk(rows, limits):
    """The same choice by walking the list."""
    one, two, files, judged = [], [], {}, 0
    for _, i, file, near, tier in sorted(rows):
        if near or files.get(file, 0) >= limits.per_file:
            continue
        judged += 1
        if tier:
            files[file] = files.get(file, 0) + 1
            (one if tier == 1 else two).append(i)
        if len(one) + len(two) >= 2 * limits.desired or judged >= limits.judge_calls:
            break
    return (one + two[: max(0, limits.desired - len(one))])[: limits.desired]


def test_judging_like_a_walk(spark):
    rng = random.Random(5)
    limits = mining.Limits(per_file=2, judge_calls=9, desired=3)
    rows = [(q, i, f"f{rng.randrange(6)}", i, rng.random() < 0.2, rng.choice([None, None, 1, 2])) for q in range(60) for i in range(rng.randrange(0, 25))]
    df = spark.createDataFrame([(q, i, f, 1, r, n, t) for q, i, f, r, n, t in rows], "q long, id long, file string, page int, rank long, near_dup boolean, tier int")
    got = {}
    for r in mining.judged(df, limits).orderBy("q", "position").collect():
        got.setdefault(r["q"], []).append(r["id"])
    want = {q: w for q in range(60) if (w := walk([(r, i, f, n, t) for x, i, f, r, n, t in rows if x == q], limits))}
    assert got == want


def test_rrf(spark):
    cols = "q long, id long, file string, page int, rank long"
    a = spark.createDataFrame([(1, 10, "a", 1, 1), (1, 11, "a", 2, 2)], cols)
    b = spark.createDataFrame([(1, 11, "a", 2, 1), (1, 12, "b", 1, 2), (2, 5, "c", 1, 1)], cols)
    got = [(r["q"], r["id"]) for r in mining.rrf(a, b).orderBy("q", "rank").collect()]
    assert got == [(1, 11), (1, 10), (1, 12), (2, 5)]


def test_hard_negatives_end_to_end(spark):
    texts = ["red fox runs", "red fox jumps", "blue whale swims", "red car drives", "green tree", "red fox sleeps", "old stone", "tall hill"]
    pages = spark.createDataFrame([(i, "f" if i < 4 else "g", i % 4 + 1, t) for i, t in enumerate(texts)], "id long, file string, page int, text string")
    v = spark.createDataFrame([(i, [1.0, 0.1 * i]) for i in range(8)], "id long, vec array<double>")
    q = spark.createDataFrame([(0, "red fox", [1.0, 0.0])], "q long, text string, vec array<double>")
    pos = spark.createDataFrame([(0, 0, "f", 1)], "q long, id long, file string, page int")
    tiers = spark.createDataFrame([(i, 1) for i in range(8)], "id long, tier int")
    got = [r["id"] for r in mining.hard_negatives(q, pages, v, pos, tiers, mining.Limits(near_duplicate=0.999)).orderBy("position").collect()]
    assert 0 not in got and 1 not in got and 2 not in got  # within two pages of the positive
    assert got[0] == 5


def test_sources(spark):
    long = " ".join(f"w{i}" for i in range(80))
    pages = spark.createDataFrame([(1, f"Intro {long} end"), (2, "tiny"), (3, "  \n"), (4, long[:120] + " other"), (5, None)], "id long, text string")
    ctx = spark.createDataFrame([(0, f"<1-hop> {long}"), (1, "this TINY thing"), (2, " "), (3, "nowhere to be found at all")], "c long, text string")
    assert {(r["c"], r["id"]) for r in mapping.find_sources(ctx, pages).collect()} == {(0, 1), (0, 4), (1, 2)}
    got = {r["c"]: (r["id"], r["level"]) for r in mapping.find_source_strict(ctx, pages).collect()}
    assert got == {0: (1, 3), 1: (2, 3)}
    same = spark.createDataFrame([(0, "TINY"), (1, long.replace(" ", "\n", 1) + " x")], "c long, text string")
    got = {r["c"]: (r["id"], r["level"]) for r in mapping.find_source_strict(same, pages).collect()}
    assert got[0] == (2, 1) and got[1][1] == 5


def test_source_columns(spark):
    rows = spark.createDataFrame([(1,), (2,)], "r long")
    found = spark.createDataFrame([(1, 11), (1, 10), (1, 11)], "r long, id long")
    pages = spark.createDataFrame([(10, "x/a.pdf", 1), (11, "x/a.pdf", 2)], "id long, path string, page int")
    got = {r["r"]: r for r in mapping.source_columns(rows, found, pages).collect()}
    assert got[1]["source_files"] == '["a.pdf"]' and got[1]["page_numbers"] == "[1,2]"
    assert got[2]["source_files_readable"] == "unknown" and got[2]["page_numbers"] == "[null]"
    texts = spark.createDataFrame([("x/a.pdf", 1, "one"), ("y/a.pdf", 1, "other"), ("x/a.pdf", 2, "two")], "path string, page int, text string")
    want = spark.createDataFrame([(1, [("a.pdf", 2), ("a.pdf", 1), ("b", 1)])], "r long, refs array<struct<file: string, page: int>>")
    assert mapping.positive_content(want, texts).first()["content"] == "two\n\none"


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (7, 7)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 150: 100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_similarity_links(spark):
    rng = np.random.default_rng(1)
    vecs = [v for c in rng.normal(size=(5, 6)) for v in c + rng.normal(scale=0.2, size=(40, 6))] + [np.zeros(6)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vecs)], "id long, vec array<double>")
    unit = np.array([v / max(np.linalg.norm(v), 1e-300) for v in vecs])
    near = np.round(unit @ unit.T, 6) >= 0.95
    np.fill_diagonal(near, False)
    root = list(range(len(vecs)))
    for _ in range(len(vecs)):
        new = [min([root[i], *[root[j] for j in np.nonzero(near[i])[0]]]) for i in range(len(vecs))]
        if new == root:
            break
        root = new
    got = {r["id"]: (r["n_links"], r["class_id"]) for r in graph.similarity_links(df, 0.95).collect()}
    assert got == {i: (int(near[i].sum()), root[i]) for i in range(len(vecs))}


def test_pages_and_store(spark):
    rows = spark.createDataFrame([(i, "a" if i % 3 else "b") for i in range(0, 40000, 7)], "i long, f string")
    got = store.number_pages(rows, "f", "i").collect()
    for f in "ab":
        own = sorted((r["i"], r["page"]) for r in got if r["f"] == f)
        assert [p for _, p in own] == list(range(1, len(own) + 1))
    cols = "rel_path string, size_bytes long, mtime_ns long, page_number int"
    pages = spark.createDataFrame([("a", 1, 1, 1), ("a", 1, 1, 2), ("b", 1, 1, 2), ("c", 2, 1, 1), ("d", 1, None, 1), ("e", 1, 9, 1)], cols)
    files = spark.createDataFrame([(f, 1, 1) for f in "abcdef"], "rel_path string, size_bytes long, mtime_ns long")
    state = {r["rel_path"]: r["state"] for r in store.freshness(pages, files).collect()}
    assert state == {"a": "fresh", "b": "pages", "c": "size", "d": "mtime", "e": "mtime", "f": "missing"}


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, "x", "e1"), ("b", 1, "y", "e2")], "k string, p int, t string, e string")
    new = spark.createDataFrame([("a", 1, "z", None), ("c", 1, "w", None)], "k string, p int, t string, e string")
    got = sorted(tuple(r) for r in store.upsert(old, new, ["k", "p"], ("e",)).select("k", "p", "t", "e").collect())
    assert got == [("a", 1, "z", "e1"), ("b", 1, "y", "e2"), ("c", 1, "w", None)]
    whole = store.replace_files(old.withColumnRenamed("k", "rel_path"), new.withColumnRenamed("k", "rel_path"))
    assert whole.count() == 3


def test_best_page(spark):
    pages = spark.createDataFrame([("f", p, t, len(t)) for p, t in [(1, "x" * 199), (2, "y" * 300), (3, "Acme" + "z" * 220), (4, "y" * 300)]], "file string, page int, text string, chars int")
    assert store.best_page(pages).first()["page"] == 2
    entity = spark.createDataFrame([("f", "acme"), ("f", "")], "file string, entity string")
    assert store.best_page(pages, entity).first()["page"] == 3


def test_quality(spark):
    v = spark.createDataFrame([(0, "good", "answerable"), (1, "mediocre", "partial"), (2, "bad", "answerable"), (3, "error", "error")], "row_index long, query_quality string, source_answerability string")
    rows = spark.range(5).withColumnRenamed("id", "row_index")
    assert [r[0] for r in quality.apply_verdicts(rows, v).collect()] == [0]
    assert sorted(r[0] for r in quality.apply_verdicts(rows, v, relaxed=True).collect()) == [0, 1]
    report = quality.vision_report(v).first()
    assert (report["good_rate"], report["relaxed_kept"], report["qc_error"]) == (25.0, 2, 1)
    names = spark.createDataFrame([("Unknown",), ("a",), (None,)], "s string")
    assert quality.drop_unknown(names, "s").count() == 2
    hn = spark.createDataFrame([("pass", "pass", ["pass", "skipped"], [False, True]), ("pass", "pass", ["fail"], [True]), ("pass", "error", None, None)], "qc string, sa string, hn array<string>, answers array<boolean>")
    got = quality.validation_report(hn).first()
    assert (got["fully_passing"], got["hn_skipped"], got["hn_false_negatives"]) == (1, 1, 1)


def test_allocation(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 98), ("d", 0)], "world string, n long")
    got = {r["world"]: r["share"] for r in datasets.allocate(df, 10).collect()}
    assert got == {"a": 1, "b": 1, "c": 7, "d": 1}


def test_split_has_no_leak(spark):
    pos = spark.createDataFrame([(q, q // 3 if q < 60 else 1000 + q) for q in range(100)] + [(0, 19)], "q long, pos long")
    members = datasets.query_components(pos)
    got = datasets.split(members).collect()
    by = {}
    for r in got:
        by.setdefault(r["component"], set()).add(r["split"])
    assert all(len(s) == 1 for s in by.values()) and len(got) == 100
    assert {r["component"] for r in got if r["q"] in (0, 1, 2, 57, 58, 59)} == {0}
    assert 70 <= sum(r["split"] == "train" for r in got) <= 76


def test_triplets(spark):
    pos = spark.createDataFrame([(1, 0), (1, 1), (2, 2)], "q long, pos long")
    hard = spark.createDataFrame([(1, 3), (1, 4)], "q long, neg long")
    assert datasets.hard_triplets(pos, hard).count() == 4
    corpus = spark.createDataFrame([(i, i) for i in range(50)], "at long, id long")
    soft = datasets.soft_triplets(pos, corpus, hard.withColumnRenamed("neg", "id"), n=5)
    rows = soft.collect()
    assert len(rows) == 15 and not {(r["q"], r["neg"]) for r in rows} & {(1, 0), (1, 1), (1, 3), (1, 4), (2, 2)}
    assert datasets.soft_triplets(pos, corpus.filter("at < 3"), hard.withColumnRenamed("neg", "id"), n=5).count() <= 5
    got = datasets.triplet_stats(datasets.combine(datasets.hard_triplets(pos, hard), soft)).first()
    assert (got["n"], got["n_hard"], got["n_soft"], got["queries_with_hard"]) == (19, 4, 15, 1)


def test_statistics(spark):
    a = spark.createDataFrame([(i, f"t{i}", float(i % 2)) for i in range(12)], "pos long, query string, score double")
    same = stats.paired(a, a)
    assert stats.permutation_test(same, 200).first()["p_value"] == 1.0
    ci = stats.bootstrap_interval(same, 200).first()
    assert ci["ci_lower"] == ci["ci_upper"] == 0
    better = stats.paired(a.withColumn("score", F.col("score") + 1), a)
    assert stats.permutation_test(better, 2000).first()["p_value"] < 0.01
    b = spark.createDataFrame([(0, "t1", 5.0), (1, "t1", 6.0), (2, "zz", 7.0)], "pos long, query string, score double")
    assert [tuple(r) for r in stats.paired(a, b).collect()] == [(1, 1.0, 6.0, -5.0)]


def test_pca(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(80, 3)) * [5, 2, 0.1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "k long, center array<double>")
    model = centroids.pca(df, 2)
    xy = np.array([[r["x"], r["y"]] for r in centroids.project(df, model).collect()])
    assert np.allclose(xy.mean(axis=0), 0, atol=1e-9) and model["explained"][0] > model["explained"][1] > 0
    assert np.allclose(np.abs(model["components"][0]), [1, 0, 0], atol=0.05)


def test_adapter_gradients_and_training(spark):
    rng = np.random.default_rng(2)
    q, p, n = (rng.normal(size=(6, 5)) for _ in range(3))
    for kind in adapter.KINDS:
        own = adapter.Adapter.new(kind, 5, 3)
        assert np.allclose(own(q), q)
        own.weights = {k: w + rng.normal(scale=0.1, size=w.shape) for k, w in own.weights.items()}
        loss, grads = adapter.triplet_loss(own, q, p, n, 0.5)
        for k, w in own.weights.items():
            at = tuple(0 for _ in w.shape)
            step = w.copy()
            step[at] += 1e-6
            moved = adapter.triplet_loss(adapter.Adapter(kind, {**own.weights, k: step}), q, p, n, 0.5)[0]
            assert math.isclose((moved - loss) / 1e-6, grads[k][at], rel_tol=1e-3, abs_tol=1e-5)
    turn = np.linalg.qr(rng.normal(size=(5, 5)))[0]
    base = rng.normal(size=(400, 5))
    trip = np.stack([base, base @ turn.T, rng.normal(size=(400, 5))], axis=1)
    best, losses = adapter.train(adapter.Adapter.new("full_rank", 5), trip[:300], trip[300:], rate=0.02, epochs=30)
    assert losses[-1][1] < 0.5 * losses[0][0]
    df = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 0.0]), (2, None)], "q long, vec array<double>")
    got = {r["q"]: r["vec"] for r in adapter.apply(df, best).collect()}
    assert got[2] is None and np.allclose(got[1], best(np.array([[1.0, 0, 0, 0, 0]]))[0])
    assert np.allclose(adapter.Adapter.from_json(best.to_json()).weights["w"], best.weights["w"])


class Flaky:
    model = "m"

    def embed(self, texts):
        if len(texts) > 1 or "bad" in texts[0]:
            raise RuntimeError("no")
        return [[1.0, 2.0]]


def test_providers(spark):
    pages = spark.createDataFrame([("a", 1, "good"), ("a", 2, "bad"), ("b", 1, " "), ("c", 1, "fine")], "rel_path string, page_number int, doc_content string")
    done = spark.createDataFrame([("c", 1, "m")], "rel_path string, page_number int, model string")
    got = providers.embed_missing(pages, done, Flaky, ["rel_path", "page_number"], tries=1, sleep=lambda s: None).collect()
    assert [(r["rel_path"], r["page_number"], r["dims"], r["vec"]) for r in got] == [("a", 1, 2, [1.0, 2.0])]
    stub = providers.HashEmbedder(8).embed(["a b", "b a", "c"])
    assert np.allclose(stub[0], stub[1]) and not np.allclose(stub[0], stub[2])
    out = providers.complete(pages, lambda: providers.RuleGenerator(str.upper), "doc_content").select("response").collect()
    assert sorted(r[0] for r in out) == [" ", "BAD", "FINE", "GOOD"]


def test_knowledge(spark):
    pages = spark.createDataFrame([("a", 1, "Intro text Alpha one Beta two"), ("a", 2, "plain")], "rel_path string, page_number int, doc_content string")
    nodes = knowledge.document_nodes(pages).withColumn("headlines", F.when(F.col("page_number") == 1, F.array(F.lit("beta"), F.lit(" ALPHA "), F.lit("none"))))
    assert knowledge.usable_headlines(nodes).count() == 1
    chunks, edges = knowledge.split_by_headlines(nodes)
    assert sorted(r["doc_content"] for r in chunks.collect()) == ["Alpha one ", "Beta two", "Intro text "] and edges.count() == 3
    cache = spark.createDataFrame([("a", 1, "summary", "m1", "old")], "rel_path string, page_number int, kind string, model_tag string, value string")
    have, lack = knowledge.extractions(nodes, cache, "summary", "m1")
    assert have.count() == 1 and lack.count() == 1
    back = knowledge.write_back(nodes.withColumn("value", F.lit("new")), cache, "summary", "m2").collect()
    assert {(r["page_number"], r["value"], r["model_tag"]) for r in back} == {(1, "new", "m2"), (2, "new", "m2")}
    ent = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (2, "y"), (3, "y"), (4, "z")], "node long, entity string")
    assert [(r["src"], r["dst"], r["jaccard"]) for r in knowledge.entity_edges(ent).collect()] == [(1, 3, 0.5)]
    assert knowledge.query_mix(["a=1", "b", "A=2"], ["a", "b", "c"]) == [("a", 0.75), ("b", 0.25)]
    for bad in (["x"], ["a=0"], ["a=no"], []):
        with pytest.raises(ValueError):
            knowledge.query_mix(bad, ["a"])


def test_numbered_names(spark):
    """All distinct names, however many, have numbers from 0 without gaps."""
    from rankloom.operators.datasets import numbered_names

    people = spark.range(3000).selectExpr("concat('n', id % 2500) as name").unionByName(spark.createDataFrame([(None,)], "name string"))
    got = numbered_names(people, "name").collect()
    assert len({r["name"] for r in got}) == 2500 and sorted(r["at"] for r in got) == list(range(2500))


def test_links_of_small_blocks_meet_by_keys(spark, monkeypatch):
    """Many blocks and parts of a cell: the same links as all pairs, and no join without equal keys."""
    monkeypatch.setattr(graph, "BLOCK", 8)
    monkeypatch.setattr(graph, "PART", 2)
    rng = np.random.default_rng(3)
    near = rng.normal(size=(12, 6))[rng.integers(0, 12, 600)] + 0.15 * rng.normal(size=(600, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(near)], "id long, vec array<double>")
    unit = near / np.linalg.norm(near, axis=1, keepdims=True)
    links = (np.round(unit @ unit.T, 6) >= 0.97) & ~np.eye(600, dtype=bool)
    assert {r["id"]: r["n_links"] for r in graph.similarity_links(df, 0.97).collect()} == dict(enumerate(links.sum(axis=1).tolist()))
    plan = graph._meetings(graph._packed(df), 0.2)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    none = spark.createDataFrame([], "id long, vec array<double>")
    assert graph.similarity_links(none, 0.9).count() == 0


def test_hot_entities_are_parted(spark):
    """An entity that all nodes hold gives the same links in parts of 3 holders as in one group, and as all pairs do."""
    rng = np.random.default_rng(5)
    sets = {n: {"all", *(f"e{x}" for x in rng.integers(0, 30, rng.integers(0, 5)))} for n in range(60)}
    df = spark.createDataFrame([(n, e) for n, s in sets.items() for e in s], "node long, entity string")
    found = [({(r["a"], r["b"], r["shared"], round(r["jaccard"], 9)) for r in links.collect()}, {r["node"]: r["rep"] for r in members.collect()}) for links, members in (graph.entity_overlap(df, h) for h in (3, 2048))]
    rep = {n: min(m for m in sets if sets[m] == s) for n, s in sets.items()}
    tops = sorted(set(rep.values()))
    want = {(a, b, len(sets[a] & sets[b]), round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9)) for a in tops for b in tops if a < b and sets[a] & sets[b]}
    assert found[0] == found[1] == (want, rep)


def test_pairs_that_share_many_entities_are_made_once(spark, monkeypatch):
    """Sets of common entities meet as blocks: no join makes a row for each entity of a pair, and links are those of all pairs."""
    monkeypatch.setattr(graph, "LEAST", 8)
    monkeypatch.setattr(graph, "WORDS", 7)
    rng = np.random.default_rng(8)
    sets = {f"n{n:03}": {f"e{x}" for x in rng.integers(0, 20, 12)} for n in range(90)}
    df = spark.createDataFrame([(n, e) for n, s in sets.items() for e in s], "node string, entity string")
    links, members = graph.entity_overlap(df)
    rep = {n: min(m for m in sets if sets[m] == s) for n, s in sets.items()}
    tops = sorted(set(rep.values()))
    want = {(a, b, len(sets[a] & sets[b]), round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 9)) for a in tops for b in tops if a < b and sets[a] & sets[b]}
    rows = links.collect()
    assert {(r["a"], r["b"], r["shared"], round(r["jaccard"], 9)) for r in rows} == want and len(rows) == len(want)
    assert {r["node"]: r["rep"] for r in members.collect()} == rep
    assert "Join" not in links._jdf.queryExecution().executedPlan().toString()
    assert graph.entity_overlap(df.limit(0))[0].count() == 0


def test_topk_holds_few_queries_at_a_time(spark, monkeypatch):
    """A task's memory doesn't grow with queries times rows: 3,000 queries against 4,096 rows take less than 100 MB."""
    import tracemalloc

    import pyarrow as pa

    held = []
    monkeypatch.setattr(retrieval, "_passes", lambda q, c, one, end, *_: held.append((one, end)) or spark.range(0).selectExpr("id as q", "id", "0d as sim"))
    retrieval.cosine_topk(spark.createDataFrame([(0, [1.0])], "q long, vec array<double>"), spark.createDataFrame([(0, [1.0])], "id long, vec array<double>"), 5)
    rng, (one, end) = np.random.default_rng(2), held[0]
    vecs = rng.normal(size=(4096, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(4096)), pa.array(vecs.tolist()), pa.array(np.zeros(4096, np.int64))], ["id", "vec", "label"])
    sent, state = (np.arange(3000), retrieval._unit(vecs[:3000]), np.zeros(3000, np.int64)), {}
    tracemalloc.start()
    one(sent, batch, state)
    found = end(sent, state)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6 and found.num_rows == 15000
    sims = np.round(retrieval._unit(vecs) @ retrieval._unit(vecs[:3000]).T, 6).T
    np.fill_diagonal(sims, -2)
    assert np.allclose(np.sort(found.column(2).to_numpy().reshape(3000, 5), axis=1), np.sort(sims, axis=1)[:, -5:])


def test_metrics_of_classes_pull_no_pairs(spark, monkeypatch, tmp_path):
    """Ranks of whole classes: those of all pairs put in order, with equal vectors, null labels and zeros; only queries come to the driver."""
    from pyspark.sql.classic.dataframe import DataFrame

    from rankloom.operators import strips
    from rankloom.plans import queries as plans

    rng = np.random.default_rng(9)
    vecs = np.round(rng.normal(size=(450, 4)), 1)
    vecs[7], vecs[300] = 0, vecs[200]
    labels = [None if i % 37 == 5 else int(i % 5) for i in range(450)]
    spark.createDataFrame([(i, v.tolist(), c) for i, (v, c) in enumerate(zip(vecs, labels, strict=True))], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    pulled, own = [], DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda df: pulled.append(t := own(df)) or t)
    monkeypatch.setattr(retrieval, "WORTH", 0)
    monkeypatch.setattr(retrieval, "HELD_BYTES", 4 * 900)
    monkeypatch.setattr(retrieval, "PACKED", 50)
    monkeypatch.setattr(strips, "BRANCHES", 2)
    got = {r["q"]: r for r in plans.per_query(spark, str(tmp_path), hard=True).collect()}
    v32 = vecs.astype(np.float32).astype(float)
    unit = v32 / np.maximum(np.linalg.norm(v32, axis=1, keepdims=True), 1e-300)
    assert sum(t.num_rows for t in pulled) <= 5 and sorted(got) == [0, 100, 200, 300, 400]
    for q, r in got.items():
        sims = np.round(unit @ unit[q], 6) + 0.0
        order = sorted((i for i in range(450) if i != q), key=lambda i: (-sims[i], i))
        pos, neg = ([n + 1 for n, i in enumerate(order) if labels[q] is not None and labels[i] == labels[q] + s] for s in (0, 1))
        assert (r["n_pos"], r["first_positive_rank"], r["n_hn"], r["sum_hn_rank"], r["min_hn_rank"]) == (len(pos), pos[0], len(neg), sum(neg), min(neg, default=None))
        assert math.isclose(r["map"], sum((i + 1) / p for i, p in enumerate(pos)) / len(pos))
        assert math.isclose(r["ndcg_20"], sum(1 / math.log2(p + 1) for p in pos if p <= 20) / sum(1 / math.log2(i + 2) for i in range(20)))


def test_positives_are_counted_by_label(spark):
    """As in SQL each row counts, also of a repeated id, without the query's own; a null label has none, and no pair is made."""
    rows = [(i, i % 3 if i % 7 else None) for i in range(60)] + [(4, 1), (200, 2)]
    v = spark.createDataFrame(rows, "id long, label int")
    queries = spark.createDataFrame([(10, 1), (7, None), (11, 2), (99, 5)], "q long, label int")
    got = {r["q"]: r["n_pos"] for r in retrieval.class_sizes(queries, v).collect()}
    assert got == {q: sum(c is not None and x == c and i != q for i, x in rows) for q, c in [(10, 1), (7, None), (11, 2), (99, 5)]}


def test_triplets_of_classes(spark, monkeypatch):
    """Triplets of whole classes are those of their pairs; hard ones need no shuffle of pairs, soft ones no row for each attempt."""
    rng = np.random.default_rng(4)
    rows = [(i, i * 3 + 1, int(rng.integers(0, 3)) if i % 9 else None) for i in range(80)]
    corpus = spark.createDataFrame(rows, "at long, id long, label int")
    queries = corpus.filter("at % 10 = 3").select(F.col("id").alias("q"), "label")
    neg = queries.crossJoin(corpus.select(F.col("id").alias("neg"), F.col("label").alias("nl"))).filter("label <> nl and (q + neg) % 5 = 0").select("q", "neg")
    pos = queries.join(corpus, "label").filter("q <> id").select("q", F.col("id").alias("pos"))
    rows_of = lambda df: sorted(tuple(r) for r in df.select("q", "pos", "neg", "neg_type").collect())
    hard, soft = datasets.class_hard_triplets(queries, corpus, neg), datasets.class_soft_triplets(queries, corpus, neg, 6, 20)
    assert rows_of(hard) == rows_of(datasets.hard_triplets(pos, neg))
    assert rows_of(soft) == rows_of(datasets.soft_triplets(pos, corpus, neg.withColumnRenamed("neg", "id"), 6, 20))
    assert "Generate" not in soft._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(datasets, "LOOKUP", 10)
    assert rows_of(datasets.class_soft_triplets(queries, corpus, neg, 6, 20)) == rows_of(soft)


def test_links_in_strips(spark, monkeypatch):
    """Vectors of all directions: strips of blocks give the links and classes of all pairs, and no join makes pairs of blocks of them."""
    from rankloom.operators import strips

    monkeypatch.setattr(graph, "BLOCK", 8)
    monkeypatch.setattr(graph, "STRIP", 40)
    monkeypatch.setattr(graph, "FEW_MEETINGS", 0)
    monkeypatch.setattr(strips, "BRANCHES", 3)
    monkeypatch.setattr(graph, "_met_by_keys", None)
    rng = np.random.default_rng(6)
    vecs = np.concatenate([rng.normal(size=(250, 6)), np.repeat(rng.normal(size=(1, 6)), 90, axis=0), np.zeros((2, 6))])
    df = spark.createDataFrame([(int(i) * 5 - 300, v.tolist()) for i, v in enumerate(rng.permutation(vecs))], "id long, vec array<double>")
    rows = {r["id"]: np.array(r["vec"]) for r in df.collect()}
    ids = np.array(sorted(rows))
    unit = np.array([rows[i] / max(np.linalg.norm(rows[i]), 1e-300) for i in ids])
    near = np.round(unit @ unit.T, 6) >= 0.8
    np.fill_diagonal(near, False)
    root = ids.copy()
    for _ in ids:
        root = np.minimum(root, np.where(near, root, 1 << 40).min(axis=1))
    assert {r["id"]: (r["n_links"], r["class_id"]) for r in graph.similarity_links(df, 0.8).collect()} == {int(i): (int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1), root, strict=True)}


def test_draws_of_the_bootstrap_are_not_broadcast(spark, monkeypatch):
    """n draws for each row: whichever way they meet the rows, not as a broadcast of the draws."""
    pairs = spark.createDataFrame([(i, float(i % 3)) for i in range(20)], "pos long, diff double")
    from pyspark.sql.classic.dataframe import DataFrame

    seen, own = [], DataFrame.join
    monkeypatch.setattr(DataFrame, "join", lambda a, b, on=None, how=None: seen.append(j := own(a, b, on, how)) or j)
    small = stats.bootstrap_interval(pairs, 50).first()
    assert "BuildRight" in seen[-1]._jdf.queryExecution().sparkPlan().toString().split("BroadcastHashJoin")[1].split("\n")[0]
    monkeypatch.setattr(stats, "FEW", 5)
    assert stats.bootstrap_interval(pairs, 50).first() == small
