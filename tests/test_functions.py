import math

from pyspark.sql import functions as F

from rankloom.functions import refs, text, vectors


def one(spark, value, kind, *exprs):
    return spark.createDataFrame([(value,)], f"x {kind}").select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).first()


def values(spark, rows, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(rows)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


def test_page_refs(spark):
    rows = ["a.pdf (page 3)", "a (page 1).pdf (page 12)", "a.pdf", None, "a.pdf (page x)", "(page 2)"]
    got = values(spark, rows, refs.parse_ref)
    assert [tuple(g) if g else None for g in got] == [("a.pdf", 3), ("a (page 1).pdf", 12), None, None, None, None]
    assert values(spark, ['["a (page 1)", "b"]', "[", "", None], lambda c: F.size(refs.parse_refs(c))) == [1, 0, 0, 0]
    assert values(spark, [1, 2, 5], lambda c: refs.page_window(c), "int") == [[1, 2, 3], [1, 2, 3, 4], [3, 4, 5, 6, 7]]


def test_contexts(spark):
    got = values(spark, ['["a", "b"]', "plain", "  ", None, "[broken"], refs.reference_contexts)
    assert got == [["a", "b"], ["plain"], [], [], ["[broken"]]


def test_blank_two_ways(spark):
    rows = [None, "", "  ", "\n", " ", "a"]
    assert values(spark, rows, text.is_empty) == [True, True, True, False, False, False]
    assert values(spark, rows, text.is_blank) == [True, True, True, True, True, False]


def test_summary_like_python(spark):
    rows = ["", "  short  text\n", "word " * 200, "x" * 500, "a\x00b", None]

    def plain(t):
        t = " ".join((t or "").replace("\x00", " ").split())
        if len(t) <= 450:
            return t
        cut = t[:450].rstrip()
        return cut.rsplit(" ", 1)[0].rstrip() if " " in cut else cut

    assert values(spark, rows, text.extractive_summary) == [plain(r) for r in rows]


def test_truncate(spark):
    got = values(spark, ["a" * 8000, "a" * 5200 + "b" * 2801], text.truncate_for_judge)
    assert got[0] == "a" * 8000
    assert got[1] == "a" * 5200 + "\n...\n" + "b" * 2800


def test_hop_and_space(spark):
    assert values(spark, [" <1-hop> \n x", "<2-HOP>y", "z <1-hop>"], text.strip_hop) == ["x", "y", "z <1-hop>"]
    assert values(spark, [" A   b\n"], text.normalize_ws) == ["a b"]
    assert values(spark, ["see Herein now", "hereinto"], text.is_referential) == [True, False]


def test_names_and_paths(spark):
    assert values(spark, ["text-Embed/3.large-"], text.sanitize_model) == ["text_embed_3_large"]
    assert values(spark, ["/a/b.PDF", "c.tar.gz", "x.docx"], text.file_type) == ["pdf", None, "docx"]
    assert values(spark, ["/a/b/c.d.pdf"], text.stem) == ["c.d"]
    assert values(spark, ["a/b/c.pdf", "c.pdf"], text.folder_hints) == [["a", "b"], []]
    assert values(spark, ["/r/a.pdf", "/s/a.pdf"], lambda c: text.relative_path(c, "/r/")) == ["a.pdf", "/s/a.pdf"]
    assert values(spark, ["/w/a", "/wx/a", "/w"], lambda c: text.under(c, "/w")) == [True, False, True]


def test_json_answers(spark):
    rows = ['```json\n{"a": 1}\n```', 'so {"a": {"b": 2}} it is', "none", '{"a": ', None]
    assert values(spark, rows, text.json_object) == ['{"a": 1}', '{"a": {"b": 2}}', None, None, None]
    assert values(spark, ["Yes", "0", "maybe", None], text.yes_no) == ["yes", "no", "uncertain", "uncertain"]


def test_judge_tier(spark):
    rows = [
        '{"relevant":"yes","answerable":"no","topical_similarity":"high"}',
        '{"relevant":"uncertain","answerable":"no","topical_similarity":"med"}',
        '{"relevant":"yes","answerable":"yes","topical_similarity":"high","evidence":"the quote"}',
        '{"relevant":"no","answerable":"no","topical_similarity":"high"}',
        '{"relevant":"yes","answerable":"no","topical_similarity":"low"}',
        "broken",
    ]
    assert values(spark, rows, lambda c: text.judge_tier(c, F.lit("here is the quote"))) == [1, 2, None, None, None, None]


def test_chunks():
    assert text.chunks("  ") == []
    assert text.chunks("a" * 3000) == ["a" * 3000]
    got = text.chunks("a" * 3001)
    assert [len(c) for c in got] == [3000, 201]
    words = "word " * 2000
    parts = text.chunks(words)
    assert all(len(p) <= 3000 for p in parts) and parts[0].endswith("word") and parts[-1].endswith("word")


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = df.select(vectors.norm("a").alias("n"), vectors.cosine("a", "b").alias("c"), vectors.normalized("a").alias("u")).collect()
    assert got[0]["n"] == 5 and math.isclose(got[0]["c"], 24 / 25) and got[0]["u"] == [0.6, 0.8]
    assert got[1]["c"] == 0 and got[1]["u"] == [0, 0]
    bad = spark.createDataFrame([(None,), ([],), ([float("nan")],), ([float("inf")],), ([0.0],), ([1.0],)], "v array<double>")
    assert [r[0] for r in bad.select(vectors.is_valid("v")).collect()] == [False] * 5 + [True]
    assert df.select(vectors.affine("a", [[1.0, 0.0], [0.0, 2.0]], [1.0, 0.0]).alias("y")).first()["y"] == [4.0, 8.0]
