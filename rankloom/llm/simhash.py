"""SimHash near-duplicates with pivot distance tables.

A document's fingerprint is the bitwise majority of the XXH64 values of its word shingles.
Distinct fingerprints are compared, never documents: copies share one row from the start.

Two fingerprints within RADIUS bits agree in full on some choice of 16-bit blocks (with radius 2, on two
of four blocks at least), so each fingerprint is entered once per choice under those blocks' value.
A table of Hamming distances to PIVOTS reference fingerprints is computed once per fingerprint.
Distances to a pivot differ by at most the distance of the two, so within an entry rows are sorted
by their distance to the first pivot, only rows inside that window are looked at, pairs whose largest
coordinate difference exceeds the radius are discarded, and the survivors are verified by XOR.
An entry is also split by the first pivot's distance into cells that overlap by the radius, so one
block value that many fingerprints share is spread over several groups, and a long group is
worked off in blocks of rows: memory stays bounded and no pair is dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankloom.operators.graph import components

from .common import documents, materialize, ship, text_or_empty, unused

SHINGLE = 3
RADIUS = 2
SEED = 42
#: Reference fingerprints: fixed pseudo-random 64-bit numbers, so their bits are independent of the data.
PIVOTS = np.random.default_rng(20240501).integers(0, 1 << 64, 16, dtype=np.uint64)
#: Width of the first pivot's cells, in bits of distance.
CELL = 6
#: Rows of a group that are compared at a time with those in their window.
BLOCK = 1024


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """The SimHash of a text: ASCII lower case, words between ASCII white space, shingles with repeats.

    Fewer words than the width make one shingle; a text without words has fingerprint 0.
    """
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    n = len(found) - width + 1
    shingles = map(b" ".join, zip(*[found[i:] for i in range(width)])) if n > 1 else [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    return _majority(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, max(n, 1)))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = SHINGLE) -> DataFrame:
    """doc_id and fp (the fingerprint's 64 bits as a signed long) of every row."""
    ship(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, fp long")


def _choices(radius: int) -> tuple[int, list[tuple[int, ...]]]:
    """Number of equal blocks, and the choices of blocks of which any pair in the radius shares one."""
    blocks = radius + 2
    return blocks, list(combinations(range(blocks), 2))


def entries(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """key, cell, fp, home: every fingerprint under each choice of blocks and its cells of the first pivot."""
    blocks, choices = _choices(radius)
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = lambda i: F.shiftrightunsigned(F.shiftleft("fp", 64 - edges[i + 1]), 64 - edges[i + 1] + edges[i])
    key = lambda n, c: F.xxhash64(F.lit(n), *[block(i) for i in c])
    d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(PIVOTS[:1].view(np.int64)[0]))))
    cell = (d / CELL).cast("int")
    # A pair in the radius lies in one cell, or its smaller distance in the cell below: the larger one is entered there too.
    cells = F.when((d % CELL < radius) & (cell > 0), F.array(cell, cell - 1)).otherwise(F.array(cell))
    return (
        fps.select("fp", cell.alias("__own"), F.explode(cells).alias("cell"))
        .select("fp", "cell", (F.col("cell") == F.col("__own")).alias("home"), F.explode(F.array(*[key(n, c) for n, c in enumerate(choices)])).alias("key"))
        .select("key", "cell", "fp", "home")
    )


def _links(fp: np.ndarray, home: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within the radius among the rows of one group (at least one at home), sorted by the first pivot."""
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int16)
    order = np.argsort(table[:, 0], kind="stable")
    fp, home, table = fp[order], home[order], table[order]
    first, out_a, out_b = table[:, 0], [], []
    upto = np.searchsorted(first, first + radius, side="right")
    for at in range(0, len(fp), BLOCK):
        rows = slice(at, min(at + BLOCK, len(fp)))
        for to in range(at, int(upto[rows.stop - 1]), BLOCK):
            cols = slice(to, min(to + BLOCK, int(upto[rows.stop - 1])))
            i, j = np.nonzero(np.abs(first[rows, None] - first[None, cols]) <= radius)
            i, j = i + at, j + to
            near = (i < j) & (home[i] | home[j])
            i, j = i[near], j[near]
            for p in range(1, len(PIVOTS)):
                near = np.abs(table[i, p] - table[j, p]) <= radius
                i, j = i[near], j[near]
            near = np.bitwise_count(fp[i] ^ fp[j]) <= radius
            out_a.append(fp[i[near]])
            out_b.append(fp[j[near]])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct pairs a, b of fingerprints of fps (column fp, distinct) that differ in 1 to radius bits."""
    ship(fps.sparkSession)
    rows = entries(fps, radius)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "key", "cell").sortWithinPartitions("key", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def pairs(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
            key, cell, fp, home = (np.concatenate(x) for x in zip(*parts, strict=True))
            starts = np.nonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]))[0]
            ends = np.append(starts[1:], len(key))
            two = ends - starts == 2
            s = starts[two]
            near = (np.bitwise_count(fp[s] ^ fp[s + 1]) <= radius) & (home[s] | home[s + 1])
            out = [(fp[s[near]], fp[s[near] + 1])]
            for a, b in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
                out.append(_links(fp[a:b], home[a:b], radius))
            a, b = (np.concatenate(x) for x in zip(*out, strict=True))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            x = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "cell", "fp", "home")]
            x[2] = x[2].astype(np.int64).view(np.uint64)
            x[3] = x[3].astype(bool)
            if not len(x[0]):
                continue
            # All but the last group of the batch are whole.
            last = _last_start(x[0], x[1])
            if held and (held[-1][0][-1], held[-1][1][-1]) != (x[0][0], x[1][0]):
                yield from pairs(held)
                held = []
            if last:
                yield from pairs([*held, tuple(c[:last] for c in x)])
                held = []
            held.append(tuple(c[last:] for c in x))
        if held:
            yield from pairs(held)

    found = rows.mapInArrow(run, "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _last_start(key: np.ndarray, cell: np.ndarray) -> int:
    """Where the last group of sorted rows starts."""
    differs = np.nonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1]))[0]
    return int(differs[-1]) + 1 if len(differs) else 0


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id of every row; component_id is the smallest doc_id that links reach.

    Texts without words (null, empty, white space) have fingerprint 0 and link like any others; equal
    fingerprints link; repeated rows and null doc_ids have rows of their own (a null is never the
    smallest unless all are); an empty table gives no rows; further columns are not read.
    """
    rows = materialize(fingerprints(docs, id_col, text_col, width), "fingerprints")
    nodes = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    found = components(links(nodes.select("fp"), radius))
    reached = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = reached.groupBy("root").agg(F.min("least").alias("component_id"))
    label = materialize(reached.join(smallest, "root").select("fp", "component_id"), "components")
    return rows.join(label, "fp").select("doc_id", "fp", "component_id")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


#: Words of a shingle, similarity (in twentieths) and largest distance of five-word fingerprints in one_of_each().
#: At Jaccard similarity 0.8 fingerprints of 64 bits differ by 9.7 bits, with a standard deviation of 2.9.
WIDTH, TWENTIETHS, REACH = 5, 16, 22
#: MinHash bands under which one_of_each() looks for pairs, and values in each.
BANDS, ROWS = 32, 6
#: Texts under one key above which they are dealt to parts that meet in pairs.
KEY_ROWS = 1 << 16
#: Shingles of the texts of one part where those of a key are compared in full.
KEY_SHINGLES = 250_000
#: Rows that are looked around from at a time.
SMALL = 32
#: Bytes of shingle sets that one block of a group holds on average.
BLOCK_BYTES = 512 << 10
_MIX = np.random.default_rng(20240502).integers(1, 1 << 63, (2, BANDS * ROWS), dtype=np.uint64) | np.uint64(1)


def shingle_set(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct XXH64 values of a text's word shingles; fewer words make one, a text without words the empty one."""
    import xxhash

    found = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(found) - width + 1
    shingles = map(b" ".join, zip(*[found[i:] for i in range(width)])) if n > 1 else [b" ".join(found)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), np.uint64, max(n, 1)))


def _majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A number for each band: the mix of its smallest values under ROWS hash functions."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048, None] * _MIX[0] + _MIX[1]
        np.minimum(least, (part ^ (part >> np.uint64(29))).min(axis=0), out=least)
    keys = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys


def _sketches(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """doc_id, digest, fp, band keys and number of shingles of every row with an id."""
    ship(docs.sparkSession)
    given = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column("text")]
            sets = [shingle_set(t, width) for t in texts]
            keys = np.concatenate([np.zeros(0, np.uint64), *[band_keys(s) for s in sets]]).view(np.int64)
            digests = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts]
            fps = np.array([_majority(s) for s in sets], np.uint64).view(np.int64)
            ends = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(fps), pa.ListArray.from_arrays(ends, pa.array(keys)), pa.array([len(x) for x in sets], pa.int64())], ["doc_id", "digest", "fp", "keys", "n"])

    return given.mapInArrow(run, "doc_id long, digest binary, fp long, keys array<long>, n long")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The column keys of a batch, a row for each of its rows."""
    return batch.column("keys").flatten().to_numpy().view(np.uint64).reshape(-1, BANDS)


def _hot_keys(reps: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The sorted keys that more than KEY_ROWS texts have, and the number of parts of each.

    A batch tells of the keys that it has twice or more; what it has once adds at most one row per batch to a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, times = np.unique(_matrix(batch), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(k[times > 1].view(np.int64)), pa.array(times[times > 1].astype(np.int64))], ["key", "n"])

    ship(reps.sparkSession)
    sums = reps.select("keys").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") > KEY_ROWS)
    found = sums.collect()  # one in KEY_ROWS of the keys at most
    keys, n = np.array([r["key"] for r in found], np.int64).view(np.uint64), np.array([r["n"] for r in found], np.int64)
    order = np.argsort(keys)
    return keys[order], -(-n[order] // KEY_ROWS)


def _entries(reps: DataFrame, hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """key, unit, nid, fp: each text under its keys.

    Texts under a hot key are dealt to its parts, and there is a unit for each two parts, which has the texts of both:
    any two texts under a key share a unit, and no unit has more than two parts.
    """
    ship(reps.sparkSession)
    sent = reps.sparkSession.sparkContext.broadcast(hot)  # one in KEY_ROWS of the keys at most, 16 bytes each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_keys, hot_parts = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            key = _matrix(batch).ravel()
            nid, fp = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("nid", "fp"))
            parts = np.ones(len(key), np.int64)
            if len(hot_keys):
                at = np.minimum(np.searchsorted(hot_keys, key), len(hot_keys) - 1)
                parts = np.where(hot_keys[at] == key, hot_parts[at], 1)
            mixed = nid.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            part = ((mixed ^ (mixed >> np.uint64(32))) % parts.view(np.uint64)).astype(np.int64)
            yield _entry_batch(key, np.zeros(len(key), np.int64), nid, fp, parts == 1)
            for other in range(int(parts.max())):
                unit = (np.minimum(part, other) << 32) | np.maximum(part, other)
                yield _entry_batch(key, unit, nid, fp, (other < parts) & (other != part) & (parts > 1))

    return reps.select("nid", "fp", "keys").mapInArrow(run, "key long, unit long, nid long, fp long")


def _entry_batch(key: np.ndarray, unit: np.ndarray, nid: np.ndarray, fp: np.ndarray, take: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c[take]) for c in (key.view(np.int64), unit, nid, fp)], ["key", "unit", "nid", "fp"])


def _gathered(fp: np.ndarray, reach: int) -> np.ndarray:
    """For each row the smallest row that steps of at most reach bits lead to.

    Rows leave the pool when they are met, so a dense group costs about one comparison a row.  Pairs whose distances to
    a pivot differ by more than reach are discarded before their bits are compared.
    """
    table = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :4]).astype(np.int16)
    lead, pool = np.full(len(fp), -1), np.arange(len(fp))
    while len(pool):
        seed, pool = int(pool[0]), pool[1:]
        lead[seed], front = seed, [seed]
        while front and len(pool):
            rows, front = np.array(front[:SMALL]), front[SMALL:]
            met = np.zeros(len(pool), bool)
            wide = BLOCK * SMALL // len(rows)
            for at in range(0, len(pool), wide):
                part = pool[at : at + wide]
                i, j = np.nonzero(np.abs(table[rows, None, 0] - table[None, part, 0]) <= reach)
                for k in range(1, table.shape[1]):
                    near = np.abs(table[rows[i], k] - table[part[j], k]) <= reach
                    i, j = i[near], j[near]
                met[at + j[np.bitwise_count(fp[rows[i]] ^ fp[part[j]]) <= reach]] = True
            lead[pool[met]] = seed
            front += pool[met].tolist()
            pool = pool[~met]
    return lead


def _groups(names: list[str], n_keys: int, work):
    """A function of record batches sorted by their first n_keys columns: work(columns) once per whole group of two rows or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def done() -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(x) for x in zip(*held, strict=True)]
            if len(columns[0]) > 1:
                yield from work(columns)

        for batch in batches:
            x = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            if not len(x[0]):
                continue
            differs = np.zeros(len(x[0]) - 1, bool)
            for k in range(n_keys):
                differs |= x[k][1:] != x[k][:-1]
            starts = np.concatenate([[0], np.nonzero(differs)[0] + 1, [len(x[0])]])
            if held and any(held[-1][k][-1] != x[k][0] for k in range(n_keys)):
                yield from done()
                held = []
            several = np.diff(starts) > 1
            several[[0, -1]] = True  # these may go on in other batches
            for a, b in zip(starts[:-1][several].tolist(), starts[1:][several].tolist(), strict=True):
                if a and held:
                    yield from done()
                    held = []
                held.append([c[a:b] for c in x])
        if held:
            yield from done()

    return run


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64))], ["a", "b"])


def _candidates(entries: DataFrame, reach: int) -> DataFrame:
    """nid and cc: texts that share keys and lie within reach of each other, directly or by others, have one cc."""
    ship(entries.sparkSession)
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = entries.repartition(n, "key", "unit").sortWithinPartitions("key", "unit", "nid")

    def stars(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        *_, nid, fp = columns
        lead = _gathered(fp.astype(np.int64).view(np.uint64), reach)
        other = lead != np.arange(len(lead))
        if other.any():
            yield _edges(nid[lead[other]], nid[other])

    pairs = rows.mapInArrow(_groups(["key", "unit", "nid", "fp"], 2, stars), "a long, b long").distinct()
    return components(pairs).select(F.col("node").alias("nid"), F.col("root").alias("cc"))


def linked(ids: np.ndarray, sets: list[np.ndarray], twentieths: int, asks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (two arrays of ids) of the pairs of sets whose Jaccard similarity is at least twentieths / 20.

    With asks, of the pairs that have at least one row for which it is true.
    """
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    owner, flat = owner[order], flat[order]
    starts = np.concatenate([[0], np.nonzero(flat[1:] != flat[:-1])[0] + 1])
    value, ends = flat[starts], np.append(starts[1:], len(flat))
    label, out = np.arange(len(sets)), []
    for r, own in enumerate(sets):
        if asks is not None and not asks[r]:
            continue
        at = np.searchsorted(value, own)
        first, n = starts[at], ends[at] - starts[at]
        first, n = first[n > 1], n[n > 1]
        if not len(n):
            continue
        skip = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        both = np.bincount(owner[skip + np.arange(n.sum())], minlength=len(sets))
        hits = np.nonzero(both * (20 + twentieths) >= (sizes + sizes[r]) * twentieths)[0]
        met = np.unique(label[hits])
        if len(met) > 1:
            out += [(met[0], x) for x in met[1:].tolist()]
            label[np.isin(label, met)] = met[0]
    return ids[[int(x) for x, _ in out]], ids[[int(x) for _, x in out]]


def _verified(sets: DataFrame, by: list[str], twentieths: int) -> DataFrame:
    """a, b: a spanning forest of the links among the rows (*by, nid, s, and asks for linked()) of each group; by are longs."""
    n = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [*by, "nid", "s", *(["asks"] if "asks" in sets.columns else [])]
    rows = sets.select(*names).repartition(n, *by).sortWithinPartitions(*by, "nid")

    def compare(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        nid, packed, *asks = columns[len(by) :]
        a, b = linked(nid, [np.frombuffer(x, np.uint64) for x in packed], twentieths, *asks)
        if len(a):
            yield _edges(a, b)

    return rows.mapInArrow(_groups(names, len(by), compare), "a long, b long").distinct()


def _meeting(reps: DataFrame, rest: DataFrame) -> DataFrame:
    """key, i, j, nid, asks: units in which any two texts of rest (nid, label, n) that share a key but no label meet.

    Under each key the texts of its largest label are dealt to parts, and those of its other labels (which ask) to
    parts before these.  A unit has two parts, the first of them of texts that ask.  The largest label's
    texts, which are linked already, don't meet each other, so the units grow with the texts of other labels.
    """
    under = reps.join(rest, "nid").select("nid", "label", "n", F.explode("keys").alias("key"))
    sizes = under.groupBy("key", "label").agg(F.sum("n").alias("n"))
    plan = sizes.groupBy("key").agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    parts = lambda n: F.ceil(n / KEY_SHINGLES).cast("long")
    plan = plan.select("key", F.col("top.label").alias("top"), parts(F.col("n") - F.col("top.n")).alias("own"), parts(F.col("top.n")).alias("far"))
    dealt = under.join(plan, "key").withColumn("asks", F.col("label") != F.col("top"))
    dealt = dealt.withColumn("part", F.when(F.col("asks"), F.pmod(F.xxhash64("nid"), F.col("own"))).otherwise(F.col("own") + F.pmod(F.xxhash64("nid"), F.col("far"))))
    zero, last, none = F.lit(0).cast("long"), F.col("own") + F.col("far") - 1, F.array().cast("array<struct<i:bigint,j:bigint,asks:boolean>>")
    unit = lambda i, j, asks: F.struct(i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"))
    first = F.when(F.col("asks"), F.transform(F.sequence(F.col("part") + 1, last), lambda j: unit(F.col("part"), j, True))).otherwise(none)
    upto = F.least("part", "own") - 1
    second = F.when(upto >= 0, F.transform(F.sequence(zero, upto), lambda i: unit(i, F.col("part"), False))).otherwise(none)
    return dealt.select("key", "nid", F.explode(F.concat(first, second)).alias("u")).select("key", "u.i", "u.j", "nid", "u.asks")


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(text_or_empty(text_col).cast("binary"), 256))


def _shingled(docs: DataFrame, own: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """The rows of own (doc_id, digest, ...) but for these two, with s, the shingle set of their text as bytes.

    Texts are shuffled once, at any size of own: each task hashes its part of own, which has a few numbers a text.
    """
    names = [c for c in own.columns if c not in ("doc_id", "digest")]
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), _digest(text_col).alias("digest"), text_or_empty(text_col).alias("text"))
    side = own.withColumnsRenamed({"doc_id": "own_id", "digest": "own_digest"}).hint("shuffle_hash")
    rows = given.join(side, (F.col("doc_id") == F.col("own_id")) & (F.col("digest") == F.col("own_digest"))).select(*names, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [shingle_set(t.as_py(), width).tobytes() for t in batch.column(len(names))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], [*names, "s"])

    return rows.mapInArrow(run, ", ".join(f"{c} {own.schema[c].dataType.simpleString()}" for c in names) + ", s binary")


def _classed(docs: DataFrame, id_col: str, text_col: str, width: int, twentieths: int, reach: int) -> tuple[DataFrame, DataFrame]:
    """doc_id and digest of every row with an id; and digest, class_id and class_digest of every distinct text (see classes())."""
    sketch = materialize(_sketches(docs, id_col, text_col, width), "sketches")
    folded = sketch.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("fp", "keys", "n")])
    reps = materialize(folded.withColumn("nid", F.monotonically_increasing_id()), "distinct-texts")
    entries = _entries(reps, _hot_keys(reps))
    grouped = materialize(_candidates(entries, reach), "candidates").join(reps.select("nid", "doc_id", "digest", "n"), "nid")
    grouped = materialize(grouped, "candidate-texts")
    sizes = grouped.groupBy("cc").agg(F.greatest(F.lit(1), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).cast("long").alias("blocks"))
    placed = grouped.join(sizes, "cc").select("nid", "doc_id", "digest", "n", "cc", "blocks", F.pmod(F.xxhash64("nid"), F.col("blocks")).alias("blk"))
    sets = materialize(_shingled(docs, placed, id_col, text_col, width), "shingle-sets")
    # Block 0 goes to every other block, so each comes back about twice in all.
    first = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).when(F.col("blk") == 0, F.sequence(F.lit(1).cast("long"), F.greatest(F.col("blocks") - 1, F.lit(1)))).otherwise(F.array("blk"))
    edges = materialize(_verified(sets.select("cc", F.explode(first).alias("j"), "nid", "s"), ["cc", "j"], twentieths), "links")
    found = components(edges)
    # Groups of several blocks that still have several classes: texts of different classes meet under their keys.
    label = sets.filter("blocks > 2").select("nid", "cc", "n").distinct().join(found.withColumnRenamed("node", "nid"), "nid", "left").select("nid", "cc", "n", F.coalesce("root", "nid").alias("label"))
    several = label.groupBy("cc").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("cc")
    rest = materialize(label.join(several, "cc", "left_semi").select("nid", "label", "n"), "open-texts")
    if not rest.isEmpty():
        meets = _meeting(reps.select("nid", "keys"), rest).join(sets.select("nid", "s"), "nid")
        found = components(edges.unionByName(_verified(meets, ["key", "i", "j"], twentieths)))
    named = reps.select("nid", "digest", "doc_id").join(found.withColumnRenamed("node", "nid"), "nid", "left").withColumn("root", F.coalesce("root", "nid"))
    tops = named.groupBy("root").agg(F.min(F.struct("doc_id", "digest")).alias("top"))
    label = named.select("digest", "root").join(tops, "root").select("digest", F.col("top.doc_id").alias("class_id"), F.col("top.digest").alias("class_digest"))
    return sketch.select("doc_id", "digest"), materialize(label, "text-classes")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, twentieths: int = TWENTIETHS, reach: int = REACH) -> DataFrame:
    """doc_id and class_id (smallest doc_id of the class) of every row with an id, by similarity of word shingles.

    Texts link if they are equal or their sets of `width`-word shingles have a Jaccard similarity of at least
    twentieths / 20.  Blocks of equal fingerprint bits can't find pairs 10 bits apart, so texts meet under MinHash
    bands (at similarity 0.8 a pair shares one of them but for 1 in 10,000); pairs beyond `reach` bits are
    discarded by pivot distances and fingerprints.  What hangs together after that is compared in full, on the
    shingle sets of whole texts, and gives a spanning forest of its links, never the pairs.

    Texts under a key that very many share are dealt to parts, which all meet in pairs: no group grows with the corpus
    and no two texts under a key miss each other.  A group above BLOCK_BYTES of sets is dealt out in blocks, each of
    which meets itself and the first one; where that leaves several classes, texts of different classes meet under
    the keys they share, in pairs of parts too.

    Exact copies are folded first.  Rows that share an id but not a text are texts of their own; rows without an id are
    left out.  A null text is empty, and texts without words are alike.  An empty table gives no rows; further columns
    are not read.
    """
    rows, label = _classed(docs, id_col, text_col, width, twentieths, reach)
    return rows.join(label, "digest").select("doc_id", "class_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, twentieths: int = TWENTIETHS, reach: int = REACH) -> DataFrame:
    """One row of docs for each class (see classes()): that of the smallest id, then of the smallest digest.

    Rows without an id all stay.  Of rows that repeat both the staying id and its text, the first in the order of all columns' hash stays.  Columns may
    have any names.  An empty table gives no rows.
    """
    rows, label = _classed(docs, id_col, text_col, width, twentieths, reach)
    i, d, win_i, win_d, place = unused(docs.columns, "own_id", "own_digest", "win_id", "win_digest", "place")
    winners = label.select(F.col("class_id").alias(win_i), F.col("class_digest").alias(win_d)).distinct()
    same = (F.col(i) == F.col(win_i)) & (F.col(d) == F.col(win_d))
    # Texts are shuffled at any size of the winners, of which each task hashes its part.
    out = docs.withColumns({i: F.col(id_col).cast("long"), d: _digest(text_col)}).join(winners.hint("shuffle_hash"), same, "left_semi")
    again = materialize(rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias(win_i), F.col("digest").alias(win_d)), "repeated-rows")
    if not again.isEmpty():
        order = Window.partitionBy(i, d).orderBy(F.xxhash64(*[F.to_json(F.struct(F.col(c).alias("x"))) for c in docs.columns]))
        one = out.join(again, same, "left_semi").withColumn(place, F.row_number().over(order)).filter(F.col(place) == 1).drop(place)
        out = out.join(again, same, "left_anti").unionByName(one)
    return out.select(*docs.columns).unionByName(docs.filter(F.col(id_col).isNull()))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; nulls, ties and empty tables: see near_duplicates()."""
    found = near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
