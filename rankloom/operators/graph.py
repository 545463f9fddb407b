"""Connected components, similarity links, and entity overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.plans.shared import materialize, ship

from . import strips
from .retrieval import matrix

#: Rows of a packed block.
BLOCK = 1024
#: Fixed directions that vectors are gathered by, so that far blocks can be told by angle.
PIVOTS = 64
#: Blocks of a cell that meet others together, and holders of an entity that meet in one group.
PART, HOLDERS = 256, 2048
#: Meetings of a block up to which blocks of vectors meet by keys, and rows of a task's own strip, about.
FEW_MEETINGS, STRIP = 4, 16384
#: Sets of a block that are multiplied at a time, words of a product, and sets of a block at least (in small tables).
ROWS, WORDS, LEAST = 256, 4096, 512
#: Meetings by entities for each pair of sets from which blocks of sets meet instead.
CROWD = 0.05


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root for every node of edges (a, b: long, not null); root is the smallest node reachable.

    Alternates large-star and small-star steps.  Each round writes the edges to the shared folder, so lineage
    stays short and a lost executor costs one round.  Rounds grow with the logarithm of the longest path.
    """
    now = materialize(_directed(edges.select("a", "b")), "edges")
    before = None
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _directed(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        now = materialize(_directed(small), "edges")
        seen = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if seen == before:
            break
        before = seen
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    tops = roots.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    return roots.unionByName(tops)


def _directed(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger node to its smaller one."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _packed(vectors: DataFrame) -> DataFrame:
    """block, ids, m (unit vectors as bytes), center, radius: rows of like direction, BLOCK in each or about that."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col("id").cast("long").alias("id"), F.col("vec").cast("array<double>").alias("vec")).filter("vec is not null")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = matrix(batch.column(1))
                pivots = np.random.default_rng(11).normal(size=(PIVOTS, m.shape[1]))
                pivots /= np.linalg.norm(pivots, axis=1, keepdims=True)
                at = (m @ pivots.T).argmax(axis=1).astype(np.int32)
                packed = [row.tobytes() for row in m]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at), pa.array(packed, pa.binary())], ["id", "pivot", "v"])

    own = materialize(rows.mapInArrow(near, "id long, pivot int, v binary"), "unit-vectors")
    sizes = own.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("salts"))
    salted = own.join(F.broadcast(sizes), "pivot").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))  # PIVOTS rows
    packed = salted.groupBy("pivot", "salt").agg(F.sort_array(F.collect_list(F.struct("id", "v"))).alias("x"))

    def shape(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pivot, salt, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                ids = [r["id"].as_py() for r in x]
                m = np.stack([np.frombuffer(r["v"].as_py(), np.float64) for r in x])
                center = m.mean(axis=0)
                center /= max(np.linalg.norm(center), 1e-300)
                radius = float(np.arccos(np.clip(m @ center, -1, 1)).max())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(pivot << 32) + salt], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([m.tobytes()], pa.binary()), pa.array([center.tolist()], pa.list_(pa.float64())), pa.array([radius])],
                    ["block", "ids", "m", "center", "radius"],
                )

    return materialize(packed.mapInArrow(shape, "block long, ids array<long>, m binary, center array<double>, radius double"), "vector-blocks")


def _local(ids_a: np.ndarray, ids_b: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Component label (smallest id) of the rows and columns of a table of links."""
    far = np.iinfo(np.int64).max
    la, lb = ids_a.copy(), ids_b.copy()
    while True:
        na = np.minimum(la, np.where(near, lb[None, :], far).min(axis=1, initial=far))
        nb = np.minimum(lb, np.where(near, na[:, None], far).min(axis=0, initial=far))
        if (na == la).all() and (nb == lb).all():
            return np.concatenate([la, lb])
        la, lb = na, nb


def _meetings(blocks: DataFrame, angle: float) -> DataFrame:
    """a, b (a <= b): blocks whose directions lie near enough for vectors within angle of each other.

    Blocks of one pivot form a cell.  Each cell's reach round one of its centers (PIVOTS rows at most, the only thing that comes to
    the driver) rules out pairs of cells; what remains meets by equal keys, PART blocks a side, and is tested block by block.
    """
    from rankloom.functions.vectors import dot

    apart = lambda x, y: F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(x, y))))
    placed = blocks.select("block", "center", "radius", F.shiftright("block", 32).alias("cell"), F.floor(F.col("block").bitwiseAND(0xFFFFFFFF) / PART).alias("part"))
    refs = placed.groupBy("cell").agg(F.min_by("center", "block").alias("ref"), F.max("part").alias("parts"))
    reach = placed.join(F.broadcast(refs), "cell").groupBy("cell").agg(F.max(apart("center", "ref") + F.col("radius")).alias("reach"))
    cells = sorted(refs.join(reach, "cell").collect())
    met = [(x["cell"], x["parts"], y["cell"], y["parts"]) for i, x in enumerate(cells) for y in cells[i:] if np.arccos(np.clip(np.dot(x["ref"], y["ref"]), -1, 1)) <= x["reach"] + y["reach"] + angle + 1e-6]
    pairs = blocks.sparkSession.createDataFrame(met, "cell_a long, parts_a long, cell_b long, parts_b long")
    first = pairs.withColumn("part_a", F.explode(F.sequence(F.lit(0).cast("long"), "parts_a")))
    least = F.when(F.col("cell_a") == F.col("cell_b"), F.col("part_a")).otherwise(F.lit(0).cast("long"))
    units = first.withColumn("part_b", F.explode(F.sequence(least, "parts_b"))).select("cell_a", "part_a", "cell_b", "part_b")
    side = lambda n: placed.select(F.col("block").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("cell", "part", "center", "radius")])
    both = units.join(side("a"), ["cell_a", "part_a"]).join(side("b"), ["cell_b", "part_b"])
    near = apart("center_a", "center_b") <= F.col("radius_a") + F.col("radius_b") + F.lit(angle + 1e-6)
    return both.filter((F.col("a") <= F.col("b")) & near).select("a", "b")


def similarity_links(vectors: DataFrame, threshold: float) -> DataFrame:
    """id, n_links, class_id for every row of vectors (id, vec): links are cosines of at least threshold.

    Exact.  Blocks of vectors meet in pairs unless their directions lie too far apart for any link; each meeting
    gives counts and a spanning forest of its links, never the pairs themselves.  Where the angles leave few meetings
    (FEW_MEETINGS a block), they meet by equal keys; else each task takes a strip of the blocks and reads all further ones,
    so that only rows with links leave a task.  The work is that of all pairs of blocks that the angles can't rule out.
    """
    blocks = _packed(vectors)
    angle = float(np.arccos(np.clip(threshold - 1e-6, -1, 1)))
    meets = materialize(_meetings(blocks, angle), "block-pairs")
    by_keys = meets.count() <= FEW_MEETINGS * blocks.count()
    found = materialize(_met_by_keys(blocks, meets, threshold) if by_keys else _met_in_strips(blocks, threshold, angle), "links")
    counts = found.groupBy("a").agg(F.sum("n").alias("n_links")).withColumnRenamed("a", "id")
    roots = components(found.filter("a <> b")).withColumnRenamed("node", "id")
    return counts.join(roots, "id", "left").select("id", "n_links", F.coalesce("root", "id").alias("class_id"))


def _met_by_keys(blocks: DataFrame, meets: DataFrame, threshold: float) -> DataFrame:
    """a, b, n: rows with another one that they hang together with (or themselves) and a part of their links."""
    side = lambda p: blocks.select(F.col("block").alias(p), F.col("ids").alias(f"i{p}"), F.col("m").alias(f"m{p}"))
    work = meets.repartition("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "ia", "ma", "ib", "mb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, ia, ma, ib, mb in zip(*batch.columns, strict=True):
                ids_a, ids_b = ia.values.to_numpy(), ib.values.to_numpy()
                va, vb = (np.frombuffer(m.as_py(), np.float64).reshape(len(i), -1) for m, i in ((ma, ids_a), (mb, ids_b)))
                near = np.round(va @ vb.T, 6) >= threshold
                same = a.as_py() == b.as_py()
                if same:
                    np.fill_diagonal(near, False)
                label = _local(ids_a, ids_b, near)
                node = np.concatenate([ids_a, ids_b])
                n = np.concatenate([near.sum(axis=1), np.zeros(len(ids_b), np.int64) if same else near.sum(axis=0)])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(label), pa.array(n.astype(np.int64))], ["a", "b", "n"])

    return work.mapInArrow(run, "a long, b long, n long")


def _met_in_strips(blocks: DataFrame, threshold: float, angle: float) -> DataFrame:
    """_met_by_keys() of all pairs of blocks: a row of a strip leaves its task once, a further one once where it has links to the strip."""
    spark = blocks.sparkSession
    sizes = sorted((r["block"], r["n"]) for r in blocks.select("block", F.size("ids").alias("n")).collect())  # one for BLOCK rows or so
    even = sum(n for _, n in sizes) / (4 * spark.sparkContext.defaultParallelism)
    most = max(min(max(even, BLOCK), STRIP), sum(n for _, n in sizes) / strips.BRANCHES)

    def tasks() -> Iterator[tuple[DataFrame, strips.Run]]:
        own: list[int] = []
        rows = 0
        for block, n in sizes:
            own.append(block)
            rows += n
            if rows >= most:
                yield task(own[0], own[-1], len(own))
                own, rows = [], 0
        if own:
            yield task(own[0], own[-1], len(own))

    def task(lo: int, hi: int, count: int) -> tuple[DataFrame, strips.Run]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = lambda b, i: (b.column("block")[i].as_py(), b.column("ids")[i].values.to_numpy(), np.frombuffer(b.column("m")[i].as_buffer(), np.float64), b.column("center")[i].values.to_numpy(), b.column("radius")[i].as_py())
            held: list[tuple] = []
            every, links, root = (np.zeros(0, np.int64) for _ in range(3))  # the strip's ids, their links, and which of them hang together
            for _, ids, m, center, radius in strips.own_first((read(b, i) for b in batches for i in range(b.num_rows)), lambda r: lo <= r[0] <= hi, count):
                own, start, m = len(held) < count, len(root), m.reshape(len(ids), -1)
                n, lead = np.zeros(len(ids), np.int64), np.full(len(ids), -1)
                if own:
                    every, links, root = np.concatenate([every, ids]), np.concatenate([links, n]), np.concatenate([root, np.arange(start, start + len(ids))])
                for at, x, middle, reach in held:
                    if np.arccos(np.clip(middle @ center, -1, 1)) > reach + radius + angle + 1e-6:
                        continue
                    i, j = _near(x, m, threshold)
                    if len(i):
                        links[at : at + len(x)] += np.bincount(i, minlength=len(x))
                        n += np.bincount(j, minlength=len(ids))
                        i = i + at
                        if own:
                            root = _merged(root, i, j + start)
                        else:  # all rows of the strip that a further row is linked to hang together
                            _, one, of = np.unique(j, return_index=True, return_inverse=True)
                            first = np.where(lead[j] < 0, i[one][of], lead[j])
                            root = _merged(root, i, first)
                            lead[j] = first
                if own:
                    i, j = _near(m, m, threshold)
                    links[start:] += n + np.bincount(i[i != j], minlength=len(ids))
                    root = _merged(root, i + start, j + start)
                    held.append((start, m, center, radius))
                elif len(has := np.flatnonzero(n)):
                    yield _rows(ids[has], every[lead[has]], n[has])
            yield _rows(every, every[root], links)

        return blocks.filter(F.col("block").between(lo, hi)).unionByName(blocks.filter(F.col("block") > hi)), run

    found = strips.passes(tasks(), "a long, b long, n long", "strip-links")
    return spark.createDataFrame([], "a long, b long, n long") if found is None else found


def _rows(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n.astype(np.int64))], ["a", "b", "n"])


def _merged(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """root (the smallest place of each class, at all places) after the classes of a and b are joined pair by pair."""
    root = root.copy()
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root != (up := root[root])).any():
            root = up
    return root


def _near(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places i, j of the rows of two blocks of unit vectors whose rounded cosine reaches threshold.

    Single precision rules out what lies below it by more than its error; the others are taken in double.
    """
    short = (x.shape[1] + 8) * 1.2e-7 + 2e-6
    i, j = np.nonzero(x.astype(np.float32) @ y.astype(np.float32).T >= threshold - short)
    if len(i) * 8 > len(x) * len(y):
        return np.nonzero(np.round(x @ y.T, 6) >= threshold)
    sure = np.concatenate([np.round(np.einsum("ij,ij->i", x[i[k : k + 65536]], y[j[k : k + 65536]]), 6) >= threshold for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0, bool)
    return i[sure], j[sure]


def near_duplicate_flags(candidates: DataFrame, positives: DataFrame, vectors: DataFrame, threshold: float = 0.90) -> DataFrame:
    """candidates (q, id) with max_sim to the positives (q, pos) of their query and whether it reaches threshold.

    Rows without a vector on either side have no max_sim and pass.
    """
    from rankloom.functions.vectors import cosine

    v = vectors.select("id", F.col("vec").cast("array<double>").alias("vec"))
    pos = positives.select("q", F.col("pos").alias("id")).distinct().join(v, "id").select("q", F.col("vec").alias("pv"))
    sims = candidates.join(v, "id").join(pos, "q").groupBy("q", "id").agg(F.round(F.max(cosine("vec", "pv")), 6).alias("max_sim"))
    return candidates.join(sims, ["q", "id"], "left").withColumn("near_dup", F.coalesce(F.col("max_sim") >= threshold, F.lit(False)))


def _shared(reps: DataFrame, holders: int) -> DataFrame:
    """a, b, na, nb, shared of the pairs a < b of reps (node, n, entity) that share entities.

    The holders of an entity that more than `holders` nodes have are dealt to parts of about that many, and parts
    meet in pairs, so no group of a join grows with the entity.
    """
    parts = reps.groupBy("entity").agg(F.ceil(F.count(F.lit(1)) / holders).cast("int").alias("parts"))
    dealt = reps.join(parts, "entity").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    left = dealt.select("entity", F.col("part").alias("lo"), F.explode(F.sequence("part", F.col("parts") - 1)).alias("hi"), F.col("node").alias("x"), F.col("n").alias("nx"))
    right = dealt.select("entity", F.explode(F.sequence(F.lit(0), "part")).alias("lo"), F.col("part").alias("hi"), F.col("node").alias("y"), F.col("n").alias("ny"))
    met = left.join(right, ["entity", "lo", "hi"]).filter((F.col("x") < F.col("y")) | ((F.col("lo") < F.col("hi")) & (F.col("x") > F.col("y"))))
    ahead = F.col("x") < F.col("y")
    own = met.select(*[F.when(ahead, F.col(p)).otherwise(F.col(q)).alias(n) for p, q, n in (("x", "y", "a"), ("y", "x", "b"), ("nx", "ny", "na"), ("ny", "nx", "nb"))])
    return own.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("shared"))


def _set_blocks(reps: DataFrame, rows: int) -> DataFrame:
    """block, nodes, sizes, codes of reps (node, codes: entities by number): about `rows` sets in each, packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        own = [b for b in batches if b.num_rows]
        if not own:
            return
        nodes, codes = (pa.concat_arrays([b.column(c) for b in own]) for c in ("node", "codes"))
        sizes = codes.value_lengths().to_numpy().astype(np.int32)
        flat = codes.flatten().to_numpy().astype(np.int64)
        lists = pa.ListArray.from_arrays(pa.array([0, len(nodes)], pa.int32()), nodes)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), lists, pa.array([sizes.tobytes()], pa.binary()), pa.array([flat.tobytes()], pa.binary())], ["block", "nodes", "sizes", "codes"])

    kind = reps.schema["node"].dataType.simpleString()
    parts = max(1, -(-reps.count() // rows))
    return materialize(reps.select("node", "codes").repartition(parts, "node").mapInArrow(pack, f"block long, nodes array<{kind}>, sizes binary, codes binary"), "set-blocks")


def _incidence(sizes: np.ndarray, codes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """One row a set, one column a word (sorted): 1 where the set holds it.  Sums of such products are exact below 2^24."""
    out = np.zeros((len(sizes), len(words)), np.float32)
    at = np.minimum(np.searchsorted(words, codes), len(words) - 1)
    held = words[at] == codes
    out[np.repeat(np.arange(len(sizes)), sizes)[held], at[held]] = 1
    return out


def _shared_in_blocks(reps: DataFrame, rows: int) -> DataFrame:
    """_shared() by incidence tables: blocks of sets meet in pairs as products, and a pair of sets leaves its task once."""
    from .datasets import numbered_names

    ship(reps.sparkSession)
    each = reps.select("node", "entity")
    codes = each.join(materialize(numbered_names(each, "entity"), "entities"), each["entity"] == F.col("name"))
    blocks = _set_blocks(codes.groupBy("node").agg(F.sort_array(F.collect_list("at")).alias("codes")), rows)
    kind = reps.schema["node"].dataType.simpleString()
    numbers = sorted(r["block"] for r in blocks.select("block").collect())  # one for about `rows` sets
    width = max(1, -(-len(numbers) // strips.BRANCHES))
    read = lambda r: (r["block"].as_py(), r["nodes"].values, *(np.frombuffer(r[c].as_py(), t) for c, t in (("sizes", np.int32), ("codes", np.int64))))

    def task(own: list[int]) -> tuple[DataFrame, strips.Run]:
        lo, hi = own[0], own[-1]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows_of = (read({c: b.column(c)[i] for c in ("block", "nodes", "sizes", "codes")}) for b in batches for i in range(b.num_rows))
            held: list[tuple] = []
            for y in strips.own_first(rows_of, lambda r: lo <= r[0] <= hi, len(own)):
                if y[0] <= hi:
                    held.append(y)
                for x in held:
                    yield from _met(x, y)

        return blocks.filter(F.col("block").between(lo, hi)).unionByName(blocks.filter(F.col("block") > hi)), run

    def tasks() -> Iterator[tuple[DataFrame, strips.Run]]:
        yield from (task(numbers[i : i + width]) for i in range(0, len(numbers), width))

    met = strips.passes(tasks(), f"x {kind}, y {kind}, nx long, ny long, shared long", "entity-links")
    if met is None:
        return reps.select(F.col("node").alias("a"), F.col("node").alias("b"), F.col("n").cast("long").alias("na"), F.col("n").cast("long").alias("nb"), F.lit(0).cast("long").alias("shared")).limit(0)
    return met.select(*[F.when(F.col("x") < F.col("y"), F.col(p)).otherwise(F.col(q)).alias(n) for p, q, n in (("x", "y", "a"), ("y", "x", "b"), ("nx", "ny", "na"), ("ny", "nx", "nb"))], "shared")


def _met(x: tuple, y: tuple) -> Iterator[pa.RecordBatch]:
    """The pairs of sets of two blocks (or of one) that share words, with both sizes and what they share."""
    words = np.intersect1d(x[3], y[3])
    for at in range(0, len(x[2]), ROWS):
        sizes = x[2][at : at + ROWS]
        start = int(x[2][:at].sum())
        codes = x[3][start : start + int(sizes.sum())]
        shared = np.zeros((len(sizes), len(y[2])), np.float32)
        for w in range(0, len(words), WORDS):
            part = words[w : w + WORDS]
            shared += _incidence(sizes, codes, part) @ _incidence(y[2], y[3], part).T
        if x[0] == y[0]:
            shared = np.triu(shared, at + 1)
        i, j = np.nonzero(shared)
        if len(i):
            yield pa.RecordBatch.from_arrays(
                [x[1].take(pa.array(at + i)), y[1].take(pa.array(j)), pa.array(sizes[i].astype(np.int64)), pa.array(y[2][j].astype(np.int64)), pa.array(shared[i, j].astype(np.int64))], ["x", "y", "nx", "ny", "shared"]
            )


def entity_overlap(pairs: DataFrame, holders: int = HOLDERS) -> tuple[DataFrame, DataFrame]:
    """Of pairs (node, entity): links (a, b, shared, jaccard) between representatives, and membership (node, rep).

    Nodes of equal entity sets are folded into the smallest of them first.  Representatives meet by the entities that they
    share, or, where the meetings would be many for each pair of them (CROWD), as blocks of sets: a pair is then made once, with its count.
    """
    sets = pairs.distinct().groupBy("node").agg(F.sort_array(F.collect_set("entity")).alias("set"))
    w = Window.partitionBy("key")
    members = materialize(sets.withColumn("key", F.sha2(F.to_json("set").cast("binary"), 256)).withColumn("rep", F.min("node").over(w)).select("node", "rep", "set"), "members")
    reps = members.filter("node = rep").select(F.col("node"), F.size("set").alias("n"), F.explode("set").alias("entity"))
    held = reps.groupBy("entity").agg(F.count(F.lit(1)).cast("double").alias("h")).agg(F.coalesce(F.sum(F.col("h") * F.col("h")), F.lit(0.0)).alias("met")).first()["met"]
    nodes = members.filter("node = rep").count()
    even = -(-nodes // (2 * members.sparkSession.sparkContext.defaultParallelism))
    links = _shared_in_blocks(reps, min(holders, max(even, LEAST))) if held > nodes * nodes * CROWD else _shared(reps, holders)
    links = links.select("a", "b", "shared", (F.col("shared") / (F.col("na") + F.col("nb") - F.col("shared"))).alias("jaccard"))
    return links, members.select("node", "rep")
