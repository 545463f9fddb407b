"""Quality rules whose cut-offs follow the corpus, in DataFrame operations only.

Each rule measures a whole number per document.  Per language and source a quantile sketch counts values in
buckets whose width grows with the value: FINE buckets for each doubling, so a quantile read from it lies above
the true one by less than 1 part in FINE, for values of any size, and a sketch has at most 64 * FINE buckets whatever
it has seen.  Sketches of any split of the rows add up to the sketch of all rows: partial ones merge
before the shuffle, in any order, with the same result.  A language's sketch is the sum of its sources' and stands
in for sources of few documents.  A document fails a rule if its
value lies beyond the group's third quartile by SPREAD times the distance of the quartiles (at least
the rule's smallest distance, so groups without spread reject nothing at random).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WS, documents, materialize, text_or_empty, unused, words

#: Buckets of a sketch for each doubling of the value, a power of two.
FINE_BITS = 6
FINE = 1 << FINE_BITS
SPREAD = 6
#: Documents that a group needs for quartiles of its own.
LEAST_GROUP = 50
#: Rule: measure over the base columns as a whole number (millionths; the mean word's length in thousandths), and the smallest
#: distance above the third quartile.
RULES = {
    "symbols": ("n_symbols * 1000000 div greatest(1, word_chars + n_symbols)", 40_000),
    "lines": ("n_dup_lines * 1000000 div (n_lines + 4)", 300_000),
    "repeats": ("n_repeat_words * 1000000 div greatest(1, n_words)", 500_000),
    "length": ("word_chars * 1000 div greatest(1, n_words)", 6_000),
}
#: Groups whose limits every task gets (some 100 bytes each); beyond, they are joined to, with hot groups spread over SALTS tasks.
FEW_GROUPS, SALTS = 100_000, 32
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(ws: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array ws."""
    hashes = F.transform(F.arrays_zip(ws, F.slice(ws, 2, F.size(ws)), F.slice(ws, 3, F.size(ws))), lambda z: F.xxhash64(z))
    return F.element_at(F.transform(F.array(F.slice(hashes, 1, F.greatest(F.size(ws) - 2, F.lit(0)))), _covered), 1)


def _covered(h: Column) -> Column:
    same = lambda a, b: a["h"] == b["h"]
    ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    again = lambda s: F.array_sort(
        F.transform(
            F.filter(
                F.zip_with(F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.struct(a.alias("a"), b.alias("b"))), F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), s), lambda ab, p: F.struct(ab["a"].alias("a"), ab["b"].alias("b"), p.alias("p"))),
                lambda t: F.coalesce(same(t["a"], t["b"]), F.lit(False)) | F.coalesce(same(t["a"], t["p"]), F.lit(False)),
            ),
            lambda t: t["a"]["i"],
        )
    )
    cover = lambda at: F.aggregate(
        at,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).cast("long").alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    once = lambda x, f: F.element_at(F.transform(F.array(x), f), 1)  # noqa: E731  evaluates x a single time
    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(once(ordered, lambda s: cover(again(s))))


def measures(text: Column) -> Column:
    """A struct of the base columns of text and n_lines (lines with a word); each is 0 for an empty text."""
    chars = lambda keep: F.length(F.regexp_replace(text, keep, ""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{WS}]"))
    of_lines = F.element_at(F.transform(F.array(lines), lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup"))), 1)
    of_words = F.element_at(F.transform(F.array(words(text)), lambda x: F.struct(F.size(x).alias("n"), _repeat_words(x).alias("rep"))), 1)
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        chars(f"[{WS}]+").alias("c"),
        (F.length(text) - chars(r"[#*$%&|<>]+")).alias("s"),
    )


_PLACES = {"n_words": "w.n", "word_chars": "c", "n_symbols": "s", "n_dup_lines": "l.dup", "n_repeat_words": "w.rep", "n_lines": "l.n"}


def _with_rules(one: DataFrame, *keep: Column) -> DataFrame:
    """The columns in keep, the base columns and n_lines of the struct __m of one, and a column per rule."""
    base = one.select(*keep, *[F.col(f"__m.{v}").cast("long").alias(k) for k, v in _PLACES.items()])
    return base.withColumns({f"r_{k}": F.expr(v).cast("long") for k, (v, _) in RULES.items()})


def measured(docs: DataFrame, id_col: str, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """One row per row of docs: id, language, source, base columns, n_lines and a column per rule."""
    one = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), measures(text_or_empty(text_col)).alias("__m"))
    return _with_rules(one, F.col("doc_id"), F.col("lang"), F.col("source"))


def bucket(value: Column) -> Column:
    """The bucket of a whole number from 0: its leading FINE_BITS + 1 bits, and how many follow."""
    shift = F.greatest(F.lit(0), F.length(F.bin(value)) - (FINE_BITS + 1))
    return (shift * FINE + F.floor(value / F.pow(F.lit(2.0), shift))).cast("int")


def highest(bin_col: Column) -> Column:
    """The largest value of a bucket."""
    shift = F.greatest(F.lit(0), F.floor(bin_col / FINE) - 1)
    return ((bin_col - shift * FINE + 1) * F.pow(F.lit(2.0), shift) - 1).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, rule, bin, n: the sketches of rows (lang, source and a column per rule)."""
    rules = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), bucket(F.col(f"r_{k}")).alias("bin")) for k in RULES]))
    return rows.select("lang", "source", rules.alias("x")).groupBy("lang", "source", "x.rule", "x.bin").agg(F.count(F.lit(1)).alias("n"))


def merged(*parts: DataFrame) -> DataFrame:
    """The sketch of all rows that the sketches in parts have seen."""
    return reduce(DataFrame.unionByName, parts).groupBy("lang", "source", "rule", "bin").agg(F.sum("n").alias("n"))


def _quartiles(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Of each sketch: its rows, and the largest values of the buckets up to which a quarter and three quarters lie."""
    w = Window.partitionBy(*by, "rule")
    upto = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    c = sketch.groupBy(*by, "rule", "bin").agg(F.sum("n").alias("n")).withColumn("upto", upto).withColumn("rows", F.sum("n").over(w))
    return c.groupBy(*by, "rule").agg(
        F.max("rows").alias("rows"), *[highest(F.min(F.when(F.col("upto") * 4 >= F.col("rows") * q, F.col("bin")))).alias(f"q{q}") for q in (1, 3)]
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """lang, source, and per rule the largest value that passes."""
    own, wide = _quartiles(sketch, ["lang", "source"]), _quartiles(sketch, ["lang"]).withColumnsRenamed({"lang": "__l", "rule": "__rule", "rows": "__rows", "q1": "w1", "q3": "w3"})
    both = own.join(wide, F.col("lang").eqNullSafe(F.col("__l")) & (F.col("rule") == F.col("__rule")))
    pick = lambda q: F.when(F.col("rows") >= LEAST_GROUP, F.col(f"q{q}")).otherwise(F.col(f"w{q}"))
    least = F.create_map(*[F.lit(x) for k, (_, d) in RULES.items() for x in (k, d)])
    limit = pick(3) + F.greatest(F.lit(SPREAD) * (pick(3) - pick(1)), least[F.col("rule")])
    return both.groupBy("lang", "source").agg(*[F.max(F.when(F.col("rule") == k, limit)).cast("long").alias(f"t_{k}") for k in RULES])


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _with_limits(rows: DataFrame, lang: Column, source: Column, limits: DataFrame, how: str) -> DataFrame:
    """rows joined to the limits (with __lang and __source) of their group."""
    on = lang.eqNullSafe(F.col("__lang")) & source.eqNullSafe(F.col("__source"))
    if limits.count() <= FEW_GROUPS:
        return rows.join(F.broadcast(limits), on, how)
    (salt,) = unused([*rows.columns, *limits.columns], "salt")
    spread = limits.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn(f"{salt}_own", F.floor(F.rand(7) * SALTS).cast("int")).join(spread, on & (F.col(f"{salt}_own") == F.col(salt)), how).drop(salt, f"{salt}_own")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The measures of every row of docs with base_failed, kept and each rule's limit.

    A null text has no words; a text of any length is measured whole; null languages and sources are groups of their own; a
    group whose documents all fail the base rules has no sketch and its rows are not kept.  A document at its limit
    passes, so rows of equal measures in a group are kept or not together, and rows that repeat are rows of their own.  An empty
    table gives no rows; further columns are not read.
    """
    rows = materialize(measured(docs, id_col, text_col, lang_col, source_col).withColumn("base_failed", base_failed()), "quality")
    limits = materialize(thresholds(sketches(rows.filter("not base_failed"))), "quality-limits").withColumnsRenamed({"lang": "__lang", "source": "__source"})
    passed = ~F.col("base_failed")
    for k in RULES:
        passed = passed & (F.col(f"r_{k}") <= F.col(f"t_{k}"))
    return _with_limits(rows, F.col("lang"), F.col("source"), limits, "left").withColumn("kept", F.coalesce(passed, F.lit(False))).drop("__lang", "__source")


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of docs that pass (see judged()), with their columns, which may have any names.

    Documents are written once with their measures, for limits and verdicts both.
    """
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("__doc")
    own = materialize(docs.select(whole, measures(text_or_empty(text_col)).alias("__m")), "measured-documents")
    rows = _with_rules(own, F.col(f"__doc.`{lang_col}`").alias("lang"), F.col(f"__doc.`{source_col}`").alias("source")).filter(~base_failed())
    limits = materialize(thresholds(sketches(rows)), "quality-limits").withColumnsRenamed({"lang": "__lang", "source": "__source"})
    each = _with_rules(own, F.col("__doc")).filter(~base_failed())
    passed = _with_limits(each, F.col(f"__doc.`{lang_col}`"), F.col(f"__doc.`{source_col}`"), limits, "inner")
    for k in RULES:
        passed = passed.filter(F.col(f"r_{k}") <= F.col(f"t_{k}"))
    return passed.select("__doc.*")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdicts of all documents; nulls, ties and empty tables: see judged()."""
    return judged(documents(spark, sf_dir)).select("doc_id", *BASE, "base_failed", "kept")


_RULES_SQL = {k: v[0].replace(" div ", " // ") for k, v in RULES.items()}
OP6_SQL = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
g2 AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS c FROM g),
rep AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) FROM g2 WHERE c > 1) GROUP BY doc_id),
b AS (SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id),
m AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, {', '.join(f'{v} AS r_{k}' for k, v in _RULES_SQL.items())} FROM b),
x AS ({' UNION ALL '.join(f"SELECT lang, source, '{k}' AS rule, r_{k} AS v, {d} AS least FROM m WHERE NOT base_failed" for k, (_, d) in RULES.items())}),
y AS (SELECT lang, source, rule, least, v >> s AS m, s FROM (SELECT *, greatest(0, length(bin(v)) - {FINE_BITS + 1}) AS s FROM x)),
h AS (SELECT lang, source, rule, least, ((m + 1) << s) - 1 AS v FROM y),
q AS (SELECT lang, source, rule, count(*) AS n, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.75) AS q3, max(least) AS least FROM h GROUP BY ALL),
z AS (SELECT lang, rule, quantile_disc(v, 0.25) AS w1, quantile_disc(v, 0.75) AS w3 FROM h GROUP BY ALL),
t AS (SELECT q.lang, q.source, q.rule, CASE WHEN n >= {LEAST_GROUP} THEN q3 ELSE w3 END + greatest({SPREAD} * CASE WHEN n >= {LEAST_GROUP} THEN q3 - q1 ELSE w3 - w1 END, least) AS lim
      FROM q JOIN z ON q.lang IS NOT DISTINCT FROM z.lang AND q.rule = z.rule),
p AS (SELECT lang, source, {', '.join(f"max(lim) FILTER (WHERE rule = '{k}') AS t_{k}" for k in RULES)} FROM t GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {' AND '.join(f'r_{k} <= t_{k}' for k in RULES)}, FALSE) AS kept
FROM m LEFT JOIN p ON m.lang IS NOT DISTINCT FROM p.lang AND m.source IS NOT DISTINCT FROM p.source
"""
