import random

import pytest

WORDS = "the of and river stone light winter morning paper window garden music letter summer bridge silver forest number travel market kitchen".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing"]) for _ in range(n))


#: Clashing columns beside those that a table has.
EXTRA = ("size", "shard", "n", "fp", "digest", "key", "h", "m", "root", "slot", "taken", "target", "words", "__row")


@pytest.fixture(scope="session")
def rows():
    """doc_id, text, lang, source, n_chars: nulls in every column, empty and long texts, copies, near copies, shared lines."""
    line = "This very line of more than forty characters stands in several documents."
    out = []
    add = lambda text, lang="en", source="a", i=None: out.append((len(out) if i is None else i, text, lang, source, None if text is None else len(text)))
    for k in range(40):
        add(prose(k, 60 + k), "en" if k % 3 else "de", "abc"[k % 3])
    for k in range(6):
        add(prose(0, 60), source="b")
    for k in range(5):
        words = prose(900, 400).split()
        words[10 * k] = "changed"
        add(" ".join(words), source="c")
    for k in range(7):
        add(f"{prose(100 + k, 30)}\n \t{line.upper() if k % 2 else line} \x0b\n{prose(200 + k, 30)}\n{line}")
    add(None)
    add("")
    add("   \n\t ")
    add("\n\n")
    add("short one")
    add("# $ % & * | < >" * 30)
    add("say it again " * 200)
    add(prose(5, 30000), "fr", "c")
    add("Ünïcode ｆｕｌｌ width ﬁ ligature nbsp  em \U0001f600 🎉 é ​zero ﻿" + prose(7, 55))
    add(prose(8, 70), None, None)
    add(prose(9, 70), None, "a")
    add(prose(10, 70), "de", None)
    add(prose(11, 70), i=None)
    return out


def frame(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in EXTRA})


def folder(spark, tmp, rows, labels=None, pages=None):
    frame(spark, rows).repartition(3).write.parquet(f"{tmp}/documents.parquet")
    spark.createDataFrame(labels or [], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp}/labels.parquet")
    spark.createDataFrame(pages or [], "page_id long, url string, html string").repartition(2).write.parquet(f"{tmp}/pages.parquet")
    return str(tmp)


PAGES = [
    (1, "http://a.b/1", "<html><body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>First   line of\n the story, long enough to be taken as text.</p><p>Second one.</p></article><footer>Copyright</footer></body></html>"),
    (2, "http://a.b/2", None),
    (3, None, ""),
    (4, "http://a b/4", "<html><body><nav><a href=x>Home</a></nav><article><h1>A &amp; B</h1><p>First   line of\n the story, long enough to be taken as text.</p><p>Second one.</p></article><footer>Copyright</footer></body></html>"),
    (5, "u", "<p>unclosed <b>bold<div class='comments'>nice!</div><script>var x='<p>no</p>'"),
    (6, "u", "no markup at all, but a sentence that is long enough to be something that someone wrote"),
    (7, "ü", "<article>é \U0001f600 </article>"),
    (None, "u", "<p>page without an identifier</p>"),
]


@pytest.fixture(scope="session")
def sf(spark, tmp_path_factory, rows):
    labels = [(i, 1, int(i % 4 == 0)) for i, *_ in rows if i is not None and i % 2 == 0]
    return folder(spark, tmp_path_factory.mktemp("sf") / "in", rows, labels, PAGES)


@pytest.fixture(scope="session")
def nulls(spark, tmp_path_factory, rows):
    """The same rows and some without an id, and rows that repeat an id."""
    more = [*rows, (None, "no id " * 30, "en", "a", 180), (None, None, None, None, None), (3, prose(3, 63), "en", "a", 1), (3, "another text of the same id " * 4, "en", "a", 1)]
    return folder(spark, tmp_path_factory.mktemp("sf") / "nulls", more, [(None, 1, 1), (0, None, None), (2, 1, 1)], [*PAGES, PAGES[0], (1, "x", "other")])


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("sf") / "empty", [])


@pytest.fixture(scope="session")
def con(sf):
    import duckdb

    own = duckdb.connect()
    for t in ("documents", "labels", "pages"):
        own.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet/*.parquet')")
    return own
