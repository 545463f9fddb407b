"""The jobs from a folder of files to a compared and trained system, with stub providers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rankloom.operators import mining, retrieval
from rankloom.operators.providers import HashEmbedder, RuleGenerator
from rankloom.plans import jobs
from rankloom.plans.shared import materialize
from rankloom.sources.versions import VersionedTable


def embedder():
    return HashEmbedder(16)


def writer():
    return RuleGenerator(lambda p: json.dumps({"query": "which " + " ".join(p.split("\n\n", 1)[1].split()[:6]), "answer": "this"}))


def judge():
    def rule(p):
        if "QUESTION" in p and "PASSAGE" in p and "should be close" not in p:
            return '{"relevant": "yes", "answerable": "no", "topical_similarity": "high"}' if len(p) % 3 else '{"relevant": "no"}'
        return '{"verdict": "pass", "answers_the_query": "no"}'

    return RuleGenerator(rule)


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("job")
    (root / "in").mkdir()
    rng = random.Random(1)
    words = [f"word{i}" for i in range(80)]
    for k in range(8):
        (root / "in" / f"f{k}.txt").write_text(" ".join(rng.choice(words) for _ in range(1500)))
    (root / "in" / "bad.xlsx").write_bytes(b"x")
    pages = VersionedTable(spark, str(root / "pages"))
    rejected = jobs.ingest(spark, str(root / "in"), pages)
    return root, pages, [r["rel_path"] for r in rejected.collect()]


def test_ingest_again(spark, store):
    root, pages, rejected = store
    assert rejected == ["bad.xlsx"]
    first = pages.read()
    assert first.select("rel_path").distinct().count() == 8 and first.filter("page_number > 1").count() > 8
    assert first.columns and set(first.columns) >= {"content_sha256", "summary", "metadata"}
    (root / "in" / "bad.xlsx").unlink()
    (root / "in" / "f0.txt").write_text("now short")
    jobs.ingest(spark, str(root / "in"), pages)
    assert [(r["page_number"], r["doc_content"]) for r in pages.read().filter("rel_path = 'f0.txt'").collect()] == [(1, "now short")]
    assert pages.read().select("rel_path").distinct().count() == 8
    before = pages._versions()
    jobs.ingest(spark, str(root / "in"), pages)
    assert pages._versions() == before


def test_from_pages_to_adapter(spark, store):
    root, table, _ = store
    pages = table.read()
    vectors = VersionedTable(spark, str(root / "vectors"))
    v = jobs.embed(pages, vectors, embedder)
    assert v.count() == pages.count() and jobs.embed(pages, vectors, embedder).count() == v.count()

    profiles = jobs.profile(pages, VersionedTable(spark, str(root / "profiles")), lambda: RuleGenerator(lambda p: '{"title_guess": "t"}'))
    assert profiles.count() == 8

    rows = materialize(jobs.single_hop(pages, writer, 12), "rows")
    assert rows.count() == 12 and rows.select("row_index").distinct().count() == 12
    assert jobs.single_hop(pages, writer, 12, done=rows.select("row_index")).count() == 0

    queries = materialize(jobs.embed_queries(rows, embedder), "queries")
    corpus = materialize(jobs.corpus(pages, v, "hash"), "corpus")
    each, summary = jobs.evaluate(rows, queries, corpus)
    got = summary.first()
    assert got["n_queries"] == 12 and 0 < got["mrr"] <= 1 and got["recall_20"] >= got["recall_1"] and got["queries_with_hard_negatives"] == 0
    assert each.filter("query is not null").count() == 12

    mined = materialize(jobs.mine(rows, queries, pages, corpus.select("id", "vec"), judge, mining.Limits(near_duplicate=0.9999)), "mined")
    lists = [json.loads(r["hard_negatives"]) for r in mined.collect()]
    assert len(lists) == 12 and any(lists) and all(len(x) <= 10 for x in lists)
    for r in mined.collect():
        assert r["source_file_with_page"] not in json.loads(r["hard_negatives"])
        assert len(json.loads(r["hard_negative_files"])) == len(json.loads(r["hard_negatives"]))
    assert jobs.evaluate(mined, queries, corpus)[1].first()["queries_with_hard_negatives"] > 0

    verdicts = materialize(jobs.validate(mined, pages, judge), "verdicts")
    assert {r["qc"] for r in verdicts.collect()} == {"pass"} and jobs.keep_passing(mined, verdicts).count() == 12

    triples = materialize(jobs.triplets(mined, corpus, n_soft=3), "triplets")
    assert {r["neg_type"] for r in triples.select("neg_type").distinct().collect()} == {"hard", "soft"}
    best, parts, losses = jobs.train_adapter(triples, queries, corpus, epochs=2)
    assert parts.count() == 12 and losses
    from rankloom.operators import adapter

    after = jobs.evaluate(rows, adapter.apply(queries, best), corpus)[1]
    assert {r["metric"] for r in jobs.metric_delta(summary, after, retrieval.metric_names()).collect()} == set(retrieval.metric_names())


def test_judging_asks_for_what_the_walk_meets(spark):
    rng = random.Random(3)
    rows = [(q, i, f"f{rng.randrange(4)}", 1, i, rng.random() < 0.1) for q in range(12) for i in range(40)]
    df = spark.createDataFrame(rows, "q long, id long, file string, page int, rank long, near_dup boolean")
    tiers = {(q, i): rng.choice([None, 1, 2]) for q in range(12) for i in range(40)}
    say = {1: '{"relevant": "yes", "answerable": "no", "topical_similarity": "high"}', 2: '{"relevant": "yes", "answerable": "no", "topical_similarity": "medium"}', None: "{}"}

    def make():
        return RuleGenerator(lambda p: say[tiers[int(p.split("QUESTION:\n")[1].split("\n")[0]), int(p.split("PASSAGE:\n")[1])]])

    questions = spark.range(12).select(F.col("id").alias("q"), F.col("id").cast("string").alias("question"))
    passages = spark.range(40).select("id", F.col("id").cast("string").alias("passage"))
    limits = mining.Limits(judge_calls=9, desired=3)
    got = jobs.judge_candidates(df, questions, passages, make, limits)
    full = spark.createDataFrame([(q, i, t) for (q, i), t in tiers.items()], "q long, id long, tier int")
    show = lambda v: sorted(tuple(r) for r in mining.judged(df.join(v, ["q", "id"], "left"), limits).collect())
    assert show(got) == show(full)


def test_compare(spark, tmp_path):
    for name, shift in (("a", 0.0), ("b", 0.5), ("c", 0.0)):
        (tmp_path / f"{name}.json").write_text(json.dumps({"per_query": [{"query": f"q{i}", "mrr": i / 20 + shift} for i in range(12)]}))
    got = {(r["file_a"][-6], r["file_b"][-6]): r for r in jobs.compare(spark, [str(tmp_path / f"{n}.json") for n in "abc"], "mrr", n=500).collect()}
    assert len(got) == 3 and got["a", "b"]["significant"] and not got["a", "c"]["significant"] and abs(got["a", "b"]["delta"] + 0.5) < 1e-9


def test_command_line(spark, tmp_path, capsys):
    from rankloom.__main__ import main

    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / f"f{k}.txt").write_text(" ".join(f"word{(k * 7 + i) % 30}" for i in range(200)))
    p = lambda name: str(tmp_path / name)
    own = "tests.test_jobs"
    main(["ingest", "--folder", p("in"), "--pages", p("pages")], spark)
    main(["embed", "--pages", p("pages"), "--vectors", p("vectors"), "--embedder", f"{own}:embedder"], spark)
    main(["generate", "--pages", p("pages"), "--generator", f"{own}:writer", "--out", p("data"), "--n", "3"], spark)
    main(["evaluate", "--dataset", p("data.parquet"), "--pages", p("pages"), "--vectors", p("vectors"), "--embedder", f"{own}:embedder", "--out", p("eval")], spark)
    assert spark.read.json(p("eval/summary")).first()["n_queries"] == 3
    assert [json.loads(x) for x in capsys.readouterr().out.split("\n") if x] == [{"pages": 3, "rejected": 0}, {"vectors": 3}]
