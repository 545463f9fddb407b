"""Line dedup with two Bloom filters.

A first pass hashes every long line key; each hash is sent (8 bytes, once per batch of rows) to the
segment of the filter that owns it, where a key that is new enters the once-seen filter and a key met
before enters the twice-seen filter.  Segments are built side by side and only the twice-seen bits
are gathered: at most FILTER_BYTES, whatever the input.  A second pass sends only suspected repeats
(keys in the twice-seen filter) to an exact count of the documents that hold them.  Beyond the
filter's capacity more keys become suspects; none is ever missed, so results stay exact.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, materialize, ship, text_or_empty, unused

LEAST_CHARS = 40
LEAST_DOCS = 5
#: Largest twice-seen filter that goes to every task: 2**29 bits.
FILTER_BYTES = 1 << 26
#: Parts of the filter, at least, and the largest one; each is built by one task.
SEGMENTS, SEGMENT_BYTES = 64, 1 << 21
#: Bytes of confirmed keys up to which every task gets all of them; beyond, lines are joined to them.
KEYS_BYTES = 48 << 20
_STRIP = b" \t\n\x0b\x0c\r"
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


def key_of(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """The key of a line, or None if it is shorter than least_chars code points."""
    key = line.strip(_STRIP)
    n = len(key)
    if n < least_chars or (n < 4 * least_chars and not key.isascii() and len(key.decode("utf-8", "replace")) < least_chars):
        return None
    return key.lower()


def long_keys(text: str, least_chars: int) -> list[bytes]:
    """The distinct keys of a text, in the order of first lines."""
    return list(dict.fromkeys(k for line in text.encode("utf-8", "surrogatepass").split(b"\n") if (k := key_of(line, least_chars)) is not None))


def _hashes(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


class Segment:
    """A slice of the once-seen and twice-seen filters, which owns the hashes of one residue."""

    def __init__(self, n_bytes: int):
        self.once, self.twice = np.zeros(n_bytes, np.uint8), np.zeros(n_bytes, np.uint8)

    @staticmethod
    def bits(h: np.ndarray, n_bytes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Byte and mask of each hash in the filter, one pair of arrays per hash function."""
        for m in _MULT:
            at = ((h * m) >> np.uint64(20)) % np.uint64(8 * n_bytes)
            yield (at >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8)

    @classmethod
    def holds(cls, filt: np.ndarray, h: np.ndarray) -> np.ndarray:
        out = np.ones(len(h), bool)
        for byte, mask in cls.bits(h, len(filt)):
            out &= (filt[byte] & mask) != 0
        return out

    @classmethod
    def put(cls, filt: np.ndarray, h: np.ndarray) -> None:
        for byte, mask in cls.bits(h, len(filt)):
            np.bitwise_or.at(filt, byte, mask)

    def add(self, h: np.ndarray) -> None:
        """Each hash of h was met; hashes that repeat, within h or from before, become twice-seen."""
        new, counts = np.unique(h, return_counts=True)
        self.put(self.twice, new[(counts > 1) | self.holds(self.once, new)])
        self.put(self.once, new)


def _segments(docs: DataFrame, text_col: str, least_chars: int, segments: int) -> tuple[int, int]:
    """Number of segments and bytes of each, for 12 bits per key that the text could hold at most."""
    chars = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long")).alias("n")).first()["n"] or 0
    whole = (12 * (chars // max(1, least_chars + 1)) + 1024) // 8
    segments = max(segments, -(-whole // SEGMENT_BYTES))
    return segments, max(64, 1 << (whole // segments).bit_length())


def twice_seen(docs: DataFrame, text_col: str, least_chars: int, segments: int, n_bytes: int) -> DataFrame:
    """seg and twice (compressed): the segments of the twice-seen filter that aren't empty."""
    ship(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [k for t in batch.column(0) for k in long_keys(t.as_py(), least_chars)]
            h, counts = np.unique(_hashes(found), return_counts=True)
            h = np.concatenate([h, h[counts > 1]])  # twice is enough for a key that this batch repeats
            yield pa.RecordBatch.from_arrays([pa.array((h % np.uint64(segments)).astype(np.int32)), pa.array(h.view(np.int64))], ["seg", "h"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, filt = None, None
        packed = lambda: pa.RecordBatch.from_arrays([pa.array([seg], pa.int32()), pa.array([zlib.compress(filt.twice.tobytes(), 1)], pa.binary())], ["seg", "twice"])
        for batch in batches:
            own, h = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for s in np.unique(own).tolist():  # rows come in the order of segments
                if s != seg:
                    if filt:
                        yield packed()
                    seg, filt = s, Segment(n_bytes)
                filt.add(h[own == s])
        if filt:
            yield packed()

    rows = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(hashed, "seg int, h long")
    return rows.repartition(segments, "seg").sortWithinPartitions("seg").mapInArrow(build, "seg int, twice binary")


def _few_ids(found: list[list], ids: list, least_docs: int, keep: str) -> tuple[list, list[int]]:
    """Of each key that rows hold, the rows of at most least_docs ids, the one that would keep it among them; and the keys."""
    rows_of: dict = {}
    for r, keys in enumerate(found):
        for k in keys:
            rows_of.setdefault(k, []).append(r)
    out, at = [], []
    for k, rows in rows_of.items():
        if len(rows) > least_docs:
            own = {ids[r]: r for r in rows if ids[r] is not None}
            rows = [own[i] for i in sorted(own, reverse=keep == "largest")[:least_docs]]
        out += [k] * len(rows)
        at += rows
    return out, at


def _repeated(docs: DataFrame, id_col: str, text_col: str, least_chars: int, least_docs: int, keep: str, segments: int, n_bytes: int, filters: DataFrame) -> DataFrame:
    """h of every suspect that least_docs documents hold, by segments that stay where they are.

    Hashes travel, not lines, and a batch sends at most least_docs rows of each.
    """
    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_hashes(long_keys(t.as_py(), least_chars)).tolist() for t in batch.column("text")]
            flat, at = _few_ids(found, batch.column("doc_id").to_pylist(), least_docs, keep)
            h = np.array(flat, np.uint64)
            seg = (h % np.uint64(segments)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(seg), pa.array(h.view(np.int64)), batch.column("doc_id").take(pa.array(at, pa.int64())), pa.nulls(len(h), pa.binary())], ["seg", "h", "doc_id", "twice"])

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, filt = None, None
        for batch in batches:
            own, h = batch.column("seg").to_numpy(), batch.column("h").to_numpy(zero_copy_only=False)
            hit = np.zeros(len(own), bool)
            for s in np.unique(own).tolist():
                rows = np.nonzero(own == s)[0]
                if s != seg:  # a segment's filter is its first row
                    seg, filt = s, np.frombuffer(zlib.decompress(batch.column("twice")[int(rows[0])].as_py()), np.uint8)
                    rows = rows[1:]
                hit[rows] = Segment.holds(filt, h[rows].astype(np.int64).view(np.uint64))
            yield batch.filter(pa.array(hit)).select(["h", "doc_id"])

    rows = given.mapInArrow(hashed, f"seg int, h long, doc_id {kind}, twice binary")
    both = filters.select("seg", F.lit(0).cast("long").alias("h"), F.lit(None).cast(kind).alias("doc_id"), "twice").unionByName(rows)
    suspects = both.repartition(segments, "seg").sortWithinPartitions("seg", F.col("twice").isNull()).mapInArrow(test, f"h long, doc_id {kind}")
    return suspects.groupBy("h").agg(F.count_distinct("doc_id").alias("n")).filter(F.col("n") >= least_docs).select("h")


def confirmed(docs: DataFrame, id_col: str, text_col: str, least_chars: int, least_docs: int, keep: str, filter_bytes: int = FILTER_BYTES, keys_bytes: int = KEYS_BYTES) -> DataFrame:
    """key (binary) and keeper of every key that least_docs documents hold, written to the shared folder."""
    spark = docs.sparkSession
    segments, n_bytes = _segments(docs, text_col, least_chars, SEGMENTS)
    filters = twice_seen(docs, text_col, least_chars, segments, n_bytes)
    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    kind = given.schema["doc_id"].dataType.simpleString()
    known = None
    if segments * n_bytes <= filter_bytes:
        whole = np.zeros((segments, n_bytes), np.uint8)
        for r in filters.collect():  # filter_bytes at most
            whole[r["seg"]] = np.frombuffer(zlib.decompress(r["twice"]), np.uint8)
        sent = spark.sparkContext.broadcast(zlib.compress(whole.tobytes(), 1))
        del whole
    else:
        known = materialize(_repeated(docs, id_col, text_col, least_chars, least_docs, keep, segments, n_bytes, materialize(filters, "twice-seen")), "repeated-hashes")
        small = known.count() * 8 <= keys_bytes
        # keys_bytes at most; beyond, lines are joined to the hashes.
        sent = spark.sparkContext.broadcast(np.sort(np.array([r["h"] for r in known.collect()], np.int64)).view(np.uint64).copy()) if small else None
        known = None if small else known

    def holding(h: np.ndarray, table: object) -> np.ndarray:
        if table is None:
            return np.ones(len(h), bool)
        if table.ndim == 1:
            own = np.sort(table)
            return own[np.minimum(np.searchsorted(own, h), len(own) - 1)] == h if len(own) else np.zeros(len(h), bool)
        seg = (h % np.uint64(segments)).astype(np.int64)
        order = np.argsort(seg, kind="stable")
        ends = np.searchsorted(seg[order], np.arange(segments + 1))
        hit = np.zeros(len(h), bool)
        for s in np.nonzero(np.diff(ends))[0].tolist():
            own = order[ends[s] : ends[s + 1]]
            hit[own] = Segment.holds(table[s], h[own])
        return hit

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value if sent else None
        if isinstance(table, bytes):
            table = np.frombuffer(zlib.decompress(table), np.uint8).reshape(segments, n_bytes)
        for batch in batches:
            found = [long_keys(t.as_py(), least_chars) for t in batch.column("text")]
            h = _hashes([k for f in found for k in f])
            hit, upto = holding(h, table), np.cumsum([0, *[len(f) for f in found]])
            stay = [[k for k, own in zip(f, hit[a:b].tolist(), strict=True) if own] for f, a, b in zip(found, upto[:-1], upto[1:], strict=True)]
            flat, at = _few_ids(stay, batch.column("doc_id").to_pylist(), least_docs, keep)
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(flat).view(np.int64)), pa.array(flat, pa.binary()), batch.column("doc_id").take(pa.array(at, pa.int64()))], ["h", "key", "doc_id"])

    pick = F.max if keep == "largest" else F.min
    lines = given.mapInArrow(suspects, f"h long, key binary, doc_id {kind}")
    lines = lines.join(known, "h", "left_semi") if known is not None else lines
    held = lines.groupBy("key").agg(F.count_distinct("doc_id").alias("n"), pick("doc_id").alias("keeper"))
    return materialize(held.filter(F.col("n") >= least_docs).select("key", "keeper"), "repeated-lines")


def drop_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    keep: str = "largest",
    keys_bytes: int = KEYS_BYTES,
    filter_bytes: int = FILTER_BYTES,
    counters: tuple[str, str] = ("__n_lines", "__n_dropped"),
) -> DataFrame:
    """docs with text_col cut to the lines that stay, and the columns in counters: lines and dropped lines.

    A line goes if its key has at least least_chars code points, rows of at least least_docs different ids hold it, and
    the row's id isn't the largest (or smallest) that holds it.  A null text stays null and counts as one
    empty line; a text of any length is cut whole.  Rows that share the keeper's id all keep the line; rows without an id
    hold lines for no document and keep none that others hold.  An empty table gives no rows.  docs may have columns of any
    names but those in counters.
    """
    if clash := {c.lower() for c in counters} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns {sorted(clash)} are there already; name others as counters")
    keys = confirmed(docs, id_col, text_col, least_chars, least_docs, keep, filter_bytes, keys_bytes)
    size = keys.agg(F.sum(F.octet_length("key").cast("long") + 100).alias("n")).first()["n"] or 0
    if size <= keys_bytes:
        return _drop_by_table(docs, id_col, text_col, least_chars, [(bytes(r["key"]), r["keeper"]) for r in keys.collect()], counters)
    return _drop_by_join(docs, id_col, text_col, least_chars, keys, counters)


def cut(text: str | None, own_id: object, keeper: dict, least_chars: int) -> tuple[str | None, int, int]:
    """The text without the lines that keeper (key to id) gives to another id, its lines and those dropped."""
    if not text:
        return text, 1, 0
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    stay = []
    for line in lines:
        key = key_of(line, least_chars)
        if key is None or key not in keeper or keeper[key] == own_id:
            stay.append(line)
    if len(stay) == len(lines):
        return text, len(lines), 0
    return b"\n".join(stay).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(stay)


def _drop_by_table(docs: DataFrame, id_col: str, text_col: str, least_chars: int, table: list[tuple[bytes, object]], counters: tuple[str, str]) -> DataFrame:
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(table)  # KEYS_BYTES at most
    schema = T.StructType([*docs.schema.fields, *[T.StructField(c, T.LongType()) for c in counters]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeper = dict(sent.value)
        for batch in batches:
            names = batch.schema.names
            ids, texts = batch.column(names.index(id_col)), batch.column(names.index(text_col))
            done = [cut(t.as_py(), i.as_py(), keeper, least_chars) for i, t in zip(ids, texts, strict=True)]
            columns = list(batch.columns)
            columns[names.index(text_col)] = pa.array([d[0] for d in done], texts.type)
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array([d[k] for d in done], pa.int64()) for k in (1, 2)]], [*names, *counters])

    return docs.mapInArrow(run, schema)


def _drop_by_join(docs: DataFrame, id_col: str, text_col: str, least_chars: int, keys: DataFrame, counters: tuple[str, str]) -> DataFrame:
    """The same for any number of keys: lines with a long key are joined to them, and only those travel."""
    row, gone_at = unused([*docs.columns, *counters], "row", "gone")
    base = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    given = base.select(F.col(row).alias("row"), F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, found = [], [], []
            for r, t in enumerate(batch.column("text")):
                for i, line in enumerate(t.as_py().encode("utf-8", "surrogatepass").split(b"\n")):
                    if (k := key_of(line, least_chars)) is not None:
                        rows.append(r)
                        at.append(i)
                        found.append(k)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row").take(take), batch.column("doc_id").take(take), pa.array(at, pa.int32()), pa.array(found, pa.binary())], ["row", "doc_id", "at", "key"])

    kind = given.schema["doc_id"].dataType.simpleString()
    lines = given.mapInArrow(each, f"row long, doc_id {kind}, at int, key binary")
    gone = lines.join(keys, "key").filter(~F.col("doc_id").eqNullSafe(F.col("keeper"))).groupBy(F.col("row").alias(row)).agg(F.collect_list("at").alias(gone_at))
    # Without keys of its own a row drops no line; the lines of one text fit where the text fits.
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), "\n", -1)
    stay = F.filter(parts, lambda x, i: ~F.array_contains(F.col(gone_at), i))
    joined = base.join(gone, row, "left")
    text = F.when(F.col(gone_at).isNull(), F.col(text_col)).otherwise(F.array_join(stay, "\n"))
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.size(parts).cast("long").alias(counters[0]),
        F.when(F.col(gone_at).isNull(), 0).otherwise(F.size(gone_at)).cast("long").alias(counters[1]),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and dropped lines of every document and a digest of what stays; nulls and ties: see drop_lines()."""
    left = drop_lines(documents(spark, sf_dir).select("doc_id", "text"), counters=("n_lines", "n_dropped"))
    return left.select(
        "doc_id",
        "n_lines",
        "n_dropped",
        F.sha2(text_or_empty().cast("binary"), 256).alias("kept_sha256"),
    )


OP9_SQL = r"""
WITH l AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
k AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS bare FROM l),
k2 AS (SELECT *, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k),
c AS (SELECT key, max(doc_id) AS keeper FROM k2 WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k2.doc_id, k2.i, k2.line, c.key IS NOT NULL AND k2.doc_id IS DISTINCT FROM c.keeper AS gone FROM k2 LEFT JOIN c ON k2.key = c.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
