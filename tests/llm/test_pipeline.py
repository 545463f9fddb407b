"""Each stage of the pipeline against a brute-force version, on its own input."""

import collections
import hashlib

import corpus_pipeline
from rankloom.llm import quality
from rankloom.llm.common import materialize

from .conftest import frame, prose
from .test_queries import closure, kept_lines


def near(rows):
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    return closure(sorted(sets), lambda i, j: 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]))


def test_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "sentencepiece_tokens"]


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    step = lambda name, df: materialize(stage[name](spark, df, sf), name)
    of = lambda df: [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]

    one = step("quality_rules", docs)
    kept = {r["doc_id"] for r in quality.judged(docs).filter("kept").collect()}
    assert one.columns == columns and {r[0] for r in of(one)} == kept and 0 < len(kept) < docs.count()

    two = step("line_dedup", one)
    want = kept_lines(of(one))
    assert two.columns == columns and {r[0]: r[1] or "" for r in of(two)} == {i: t for i, (t, _, _) in want.items()}
    assert all(r[4] == len(r[1]) for r in of(two) if r[1] is not None)

    three = step("simhash_near_dedup", two)
    roots = near(of(two))
    assert three.columns == columns and sorted(r[0] for r in of(three)) == sorted(i for i, r in roots.items() if i == r)
    assert len(set(roots.values())) < len(roots)

    four = step("mix_sources", three)
    times, sizes, words = collections.Counter(r[0] for r in of(four)), collections.Counter(), {r[0]: len((r[1] or "").split()) for r in of(three)}
    assert four.columns == columns and set(times) <= set(words) and max(times.values()) <= 2
    for r in of(three):
        sizes[r[3]] += words[r[0]]
    assert sum(words[i] * n for i, n in times.items()) <= 1.6 * sum(sizes.values())

    five = step("sentencepiece_tokens", four)
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda t: hashlib.sha256(",".join(map(str, sp.encode(t or ""))).encode()).hexdigest()
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in five.collect()) == sorted((r[0], digest(r[1])) for r in of(four))


def test_odd_rows(spark, nulls, empty):
    for d in (nulls, empty):
        docs = spark.read.parquet(f"{d}/documents.parquet")
        for _, f in corpus_pipeline.STAGES:
            assert f(spark, docs, d).count() >= 0
    assert corpus_pipeline.run(spark, empty).collect() == []


def test_near_dedup_of_odd_rows(spark):
    """Rows without an id stay; rows that share one leave one; a large group of near copies leaves one."""
    from rankloom.llm.simhash import classes, one_of_each

    base = prose(1, 300).split()
    group = [(i, " ".join(base[:i] + ["x"] + base[i + 1 :]), "en", "a", 1) for i in range(90)]
    odd = [(None, "a", "en", "a", 1), (None, "a", "en", "a", 1), (500, "same id", "en", "a", 1), (500, "same id", "en", "a", 1), (600, None, None, None, None), (601, "", "en", "a", 0)]
    docs = frame(spark, group + odd)
    assert sorted(str(r["doc_id"]) for r in one_of_each(docs).select("doc_id").collect()) == ["0", "500", "600", "None", "None"]
    assert {r["class_id"] for r in classes(docs).filter("doc_id < 90").collect()} == {0}


def test_near_dedup_of_many_copies(spark, monkeypatch):
    """Keys that many texts share are parted and groups dealt out in blocks, and no link between classes is lost."""
    from rankloom.llm import simhash

    monkeypatch.setattr(simhash, "KEY_SHINGLES", 500)
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 20_000)
    rows = []
    for g, gap in ((1, 1), (2, 11)):
        base = prose(g, 200).split()
        for i in range(60):
            w = list(base)
            for k in range(0, 200, 40):
                w[(k + i * gap) % 200] = f"w{g}x{i if gap > 1 else 0}"
            rows.append((100 * g + i, " ".join(w), "en", "a", 1))
    rows += [(1000 + i, prose(50 + i, 120), "en", "b", 1) for i in range(20)]
    got = {r["doc_id"]: r["class_id"] for r in simhash.classes(frame(spark, rows)).collect()}
    assert got == near(rows)


def test_texts_of_one_id_are_kept(spark):
    """Rows that share an id but not a text are documents of their own; columns may have the names that stages use."""
    from rankloom.llm import mixing, simhash

    docs = spark.createDataFrame([(1, prose(1, 80)), (1, prose(2, 80)), (2, prose(1, 80)), (1, prose(3, 80))], "doc_id long, text string").selectExpr(
        "*", "'a' as source", *[f"5 as {c}" for c in ("__id", "__words", "__epoch", "own_id", "own_digest", "words", "times", "epoch", "nth", "place")]
    )
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns and sorted(r["text"] for r in one.collect()) == sorted([prose(1, 80), prose(2, 80), prose(3, 80)])
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and 5 <= mixed.count() <= 7  # 1.5 times four texts of one size


def test_near_dedup_loses_no_link_under_hot_keys(spark, monkeypatch):
    """Pairs of similar texts that share some keys only are found where all their keys are those of very many texts."""
    from rankloom.llm import simhash

    for limit in ("KEY_SHINGLES", "KEY_ROWS"):
        monkeypatch.setattr(simhash, limit, 1, raising=False)
    rows = []
    for g in range(40):
        base = [f"w{g}x{k}" for k in range(200)]
        other = [f"y{k}" if k % 50 == 25 else w for k, w in enumerate(base)]  # 176 of 216 shingles are shared
        rows += [(10 * g + i, " ".join(w), "en", "a", 1) for i, w in enumerate((base, other))]
    want = near(rows)
    assert len(set(want.values())) == 40
    keys = {i: simhash.band_keys(simhash.shingle_set(t)) for i, t, *_ in rows}
    assert all((keys[10 * g] == keys[10 * g + 1]).any() for g in range(40))
    got = {r["doc_id"]: r["class_id"] for r in simhash.classes(frame(spark, rows).coalesce(1)).collect()}
    assert got == want


def test_near_dedup_of_many_classes_in_a_group(spark, monkeypatch):
    """A group of many blocks and classes: what the first block doesn't link meets in parts of keys."""
    from rankloom.llm import simhash

    monkeypatch.setattr(simhash, "BLOCK_BYTES", 3000)
    for limit, value in (("KEY_SHINGLES", 400), ("KEY_ROWS", 3)):
        monkeypatch.setattr(simhash, limit, value, raising=False)
    base, rows = prose(7, 200).split(), []
    for c in range(40):
        w = list(base)
        for k in range(0, 200, 25):
            w[(k + c) % 200] = f"c{c}x{k}"
        for m in range(3):
            v = list(w)
            for k in (0, 100):
                v[(k + c * 7 + 11 * m) % 200] = f"m{c}x{m}x{k}"
            rows.append((10 * c + m, " ".join(v), "en", "a", 1))
    want = near(rows)
    assert 10 < len(set(want.values())) < 100
    got = {r["doc_id"]: r["class_id"] for r in simhash.classes(frame(spark, rows), reach=64).collect()}
    assert got == want


def test_near_dedup_units_have_all_pairs(spark, monkeypatch):
    """Any two texts that share a key but no label share a unit in which one of them asks, whatever the parts."""
    import random

    from rankloom.llm import simhash

    monkeypatch.setattr(simhash, "KEY_SHINGLES", 20)
    rng = random.Random(3)
    texts = [(i, [rng.randrange(6) for _ in range(2)], rng.choice([1, 1, 1, 2, 3]), rng.randrange(1, 9)) for i in range(120)]
    reps = spark.createDataFrame([(i, k) for i, k, *_ in texts], "nid long, keys array<long>")
    rest = spark.createDataFrame([(i, x, n) for i, _, x, n in texts], "nid long, label long, n long")
    units, met = collections.defaultdict(list), set()
    for r in simhash._meeting(reps, rest).collect():
        units[r["key"], r["i"], r["j"]].append((r["nid"], r["asks"]))
    for held in units.values():
        met |= {(a, b) for a, x in held for b, y in held if a < b and (x or y)}
    assert {(a, b) for a, k, x, _ in texts for b, m, y, _ in texts if a < b and x != y and set(k) & set(m)} <= met
    shingles = {i: n for i, _, _, n in texts}
    assert len(units) > 30 and max(sum(shingles[i] for i, _ in held) for held in units.values()) < 200
