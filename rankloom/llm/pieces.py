"""SentencePiece encoding and decoding with byte offsets into the original text.

The model file's normaliser is read here: its compiled character map (a double-array trie over UTF-8
with a pool of replacements) rewrites the longest prefix that it knows at each place, and every
normalised byte records the original byte it came from.  Whole texts are segmented by the sentencepiece
library, and each piece's normalised bytes are projected through that record to the original byte
span.  Without a map the record follows from where the spaces are, and isn't written out.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, ship, text_or_empty

MODEL = "piece_bpe_32k.model"
#: Bytes of text that are handed over, and go back to Spark, at a time; a longer text goes alone.
GROUP_BYTES = 1 << 20
SPACE = "▁"
_SPACE = SPACE.encode()
#: Kinds of pieces in the model file.
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
#: Words of one part that is handed to the library.
PART_WORDS = 64


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            c = b[at]
            at += 1
            value |= (c & 127) << shift
            shift += 7
            if c < 128:
                return value

    while at < len(b):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, b[at : at + n]
        at += n


class CharMap:
    """The compiled character map: longest-prefix lookups in its double array."""

    def __init__(self, blob: bytes):
        self.units: list[int] = []
        self.pool = b""
        if blob:
            (n,) = struct.unpack_from("<I", blob)
            self.units = list(struct.unpack_from(f"<{n // 4}I", blob, 4))
            self.pool = blob[4 + n :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest key that text has at this place, and its replacement."""
        if not self.units:
            return None
        found, pos = None, 0
        unit = self.units[0]
        pos ^= self._offset(unit)
        for i in range(at, len(text)):
            c = text[i]
            pos ^= c
            if pos >= len(self.units) or (unit := self.units[pos]) & 0x800000FF != c:
                break
            pos ^= self._offset(unit)
            if unit >> 8 & 1:
                value = self.units[pos] & 0x7FFFFFFF
                found = (i + 1 - at, self.pool[value : self.pool.index(b"\0", value)])
        return found

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)


class Normalizer:
    """The normaliser of a model: options and character map."""

    def __init__(self, model: bytes):
        spec = next((v for k, v in _fields(model) if k == 3), b"")
        opts = dict(_fields(spec))
        self.map = CharMap(opts.get(2, b""))
        self.dummy_prefix, self.remove_extra, self.escape = (bool(opts.get(k, 1)) for k in (3, 4, 5))
        train = dict(_fields(next((v for k, v in _fields(model) if k == 2), b"")))
        self.suffix = bool(train.get(24, 0))
        if self.suffix:
            raise ValueError("models that treat white space as a suffix aren't read")

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised text and, for each of its bytes and its end, the original byte it stands for."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if not self.map.units and not self.remove_extra:
            return self._plain(text)
        space = _SPACE if self.escape else b" "
        out, align = bytearray(), []
        at, n = 0, len(text)
        if self.remove_extra:
            while at < n:
                step, rep = self._step(text, at)
                if rep != b" ":
                    break
                at += step
            if at == n:
                return b"", np.zeros(1, np.int64)
        if self.dummy_prefix:
            out += space
            align += [at] * len(space)
        was_space = self.remove_extra
        while at < n:
            step, rep = self._step(text, at)
            while was_space and rep.startswith(b" "):
                rep = rep[1:]
            if rep:
                for c in (rep[i : i + 1] for i in range(len(rep))):
                    put = space if c == b" " else c
                    out += put
                    align += [at] * len(put)
                was_space = rep.endswith(b" ")
            at += step
            if not self.remove_extra:
                was_space = False
        if self.remove_extra:
            while out.endswith(space):
                at = align[-len(space)]
                del out[-len(space) :], align[-len(space) :]
        return bytes(out), np.array([*align, at], np.int64)

    def _step(self, text: bytes, at: int) -> tuple[int, bytes]:
        if hit := self.map.longest(text, at):
            return hit
        c = text[at]
        n = 1 if c < 0x80 else 2 if c < 0xE0 else 3 if c < 0xF0 else 4
        return n, text[at : at + n]

    def _plain(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The same without a map: only spaces change."""
        raw = np.frombuffer(text, np.uint8)
        times = np.where(raw == 32, 3 if self.escape else 1, 1)
        align = np.repeat(np.arange(len(raw)), times)
        out = text.replace(b" ", _SPACE) if self.escape else text
        if self.dummy_prefix:
            head = _SPACE if self.escape else b" "
            out, align = head + out, np.concatenate([np.zeros(len(head), np.int64), align])
        return out, np.append(align, len(raw))


class Encoder:
    """Encodes and decodes whole texts as the library does, with spans.  It keeps nothing from text to text."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.norm = Normalizer(model)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        kinds = [dict(_fields(v)).get(3, 1) for k, v in _fields(model) if k == 1]
        self.plain = not self.norm.map.units and not self.norm.remove_extra
        self.lengths = np.array([1 if k == BYTE else len(p.encode()) for p, k in zip(pieces, kinds, strict=True)], np.int64)
        self.unknown = np.array([k == UNKNOWN for k in kinds])
        self.names = [str(i) for i in range(len(pieces))]
        #: What a normal or byte piece stands for; the library decodes texts with any other.
        self.bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else p.replace(SPACE, " ").encode() for p, k in zip(pieces, kinds, strict=True)]
        self.spaced = np.array([p.startswith(SPACE) for p in pieces])
        self.other = np.array([k not in (NORMAL, BYTE) for k in kinds])
        bpe = dict(_fields(next((v for k, v in _fields(model) if k == 2), b""))).get(3, 1) == 2
        inner = any(k == USER or SPACE in p.lstrip(SPACE) for p, k in zip(pieces, kinds, strict=True))
        self.in_parts = bpe and not inner and self.plain and self.norm.escape and self.norm.dummy_prefix
        self.parts = re.compile(f"[^ ]*(?: +[^ ]+){{0,{PART_WORDS - 1}}}(?: +\\Z)?").findall

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The library's ids of whole texts.

        Merges look for the best pair of all that is handed over, so long texts cost more than their length.  Where no piece crosses
        a word's start, merges in one word never touch another, and texts are handed over in parts that start at words.
        """
        parts, ends = [], []
        for text in texts:
            if self.in_parts and SPACE not in text:
                first, *more = self.parts(text)
                parts.append(first)
                parts += [p[1:] for p in more if p]  # the library puts a space before each part; all but the first bring their own
            else:
                parts.append(text)
            ends.append(len(parts))
        found = self.sp.encode_as_numpy(parts, num_threads=1)
        return [found[a] if b - a == 1 else np.concatenate(found[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def encode(self, text: str, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
        """Ids, first and last (exclusive) original byte of each piece, and the decoded text."""
        ids = self.ids([text])[0] if ids is None else ids
        return ids, *self._spans(ids, text), self._decoded(ids).decode()

    def digest(self, text: str, ids: np.ndarray | None = None) -> tuple[int, str, str, int, str]:
        """Number of ids, SHA-256 of the ids joined by commas and of the decoded text, the last span's end, SHA-256 of all ends."""
        ids = self.ids([text])[0] if ids is None else ids
        ends = self._spans(ids, text)[1]
        joined = ",".join(map(self.names.__getitem__, ids.tolist())).encode()
        last = int(ends[-1]) if len(ends) else 0
        return len(ids), *[hashlib.sha256(x).hexdigest() for x in (joined, self._decoded(ids))], last, hashlib.sha256(ends.astype("<i8").tobytes()).hexdigest()

    def decode(self, ids: list[int]) -> str:
        """The text of any ids, as the library decodes them."""
        return self._decoded(np.array(ids, np.int32)).decode()

    def _decoded(self, ids: np.ndarray) -> bytes:
        if self.norm.escape and self.norm.dummy_prefix and not self.norm.remove_extra and not self.other[ids].any():
            out = b"".join(map(self.bytes.__getitem__, ids.tolist()))
            out = out[1:] if len(ids) and self.spaced[ids[0]] else out
            try:
                out.decode()
                return out
            except UnicodeDecodeError:  # byte pieces that make no character: not from a text
                pass
        return self.sp.decode(ids.tolist()).encode()

    def _spans(self, ids: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and last (exclusive) original byte of each piece."""
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = text.encode()
        lengths = self.lengths[ids]
        if (gone := self.unknown[ids]).any():  # an unknown piece has the normalised bytes of the surface the library reports
            lengths = np.where(gone, [len(p.encode()) for p in self.sp.encode(text, out_type=str)], lengths)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        if not self.plain:
            align = self.norm(raw)[1]
            return align[starts], align[ends]
        # Without a map only spaces grow: a place lies behind the prefix and two more bytes for each space before it.
        wide = len(_SPACE) - 1 if self.norm.escape else 0
        prefix = wide + 1 if self.norm.dummy_prefix else 0
        spaces = np.nonzero(np.frombuffer(raw, np.uint8) == 32)[0]
        grown = spaces + prefix + wide * np.arange(len(spaces))
        there = np.maximum(ends - prefix - wide * np.searchsorted(grown, ends, "left"), 0)
        return np.concatenate([[0], there[:-1]]), there


@lru_cache(maxsize=1)
def encoder(model: bytes) -> Encoder:
    """The encoder of a worker."""
    return Encoder(model)


def _mapped(docs: DataFrame, model: bytes, id_col: str, text_col: str, keep: tuple[str, ...], fields: list[tuple[str, T.DataType]], each, arrays) -> DataFrame:
    """doc_id, fields and the columns in keep; each(encoder, text, ids) gives a row, arrays(rows) the columns of fields."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # the model file: half a megabyte, whatever the input
    kept = {f"k_{c}": c for c in keep}
    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"), *[F.col(c).alias(k) for k, c in kept.items()])
    schema = given.drop("text").schema
    for name, kind in fields:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(sent.value)
        for batch in batches:
            names = [n for n in batch.schema.names if n != "text"]
            column = batch.column("text")
            upto = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
            at = 0
            while at < batch.num_rows:
                # As many texts as have GROUP_BYTES bytes, one at least.
                end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + GROUP_BYTES, "right")))
                texts = column.slice(at, end - at).to_pylist()
                rows = [each(enc, t, i) for t, i in zip(texts, enc.ids(texts), strict=True)]
                yield pa.RecordBatch.from_arrays([*[batch.column(n).slice(at, end - at) for n in names], *arrays(rows)], [*names, *[n for n, _ in fields]])
                at = end

    return given.mapInArrow(run, schema).withColumnsRenamed(kept)


def encoded(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ids, span_starts, span_ends (bytes of the original text), decoded, and the columns in keep.

    A null or empty text has no ids and an empty decoded text.  Texts of any length are encoded whole;
    repeated rows are encoded each; an empty table gives no rows; columns that aren't kept may have any name.
    """

    fields = [*[(n, T.ArrayType(T.IntegerType())) for n in ("ids", "span_starts", "span_ends")], ("decoded", T.StringType())]
    return _mapped(docs, model, id_col, text_col, keep, fields, Encoder.encode, lambda rows: [*[_lists([r[k] for r in rows]) for k in range(3)], pa.array([r[3] for r in rows], pa.string())])


def digested(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, span_bytes, spans_sha256: what encoded() gives, hashed where it is made.

    span_bytes is where the last piece ends in the original text (0 without pieces), spans_sha256 the digest of all pieces' ends
    as little-endian longs.  Nulls, long texts, repeated rows and empty tables: see encoded().
    """
    kinds = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()), ("span_bytes", T.LongType()), ("spans_sha256", T.StringType())]
    own = [pa.int64() if isinstance(k, T.LongType) else pa.string() for _, k in kinds]
    return _mapped(docs, model, id_col, text_col, (), kinds, Encoder.digest, lambda rows: [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), own, strict=True)])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *[len(a) for a in arrays]]).astype(np.int32)
    flat = np.concatenate(arrays).astype(np.int32) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def model_bytes(path: str | None = None) -> bytes:
    """The model file; path defaults to the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    with open(path, "rb") as f:
        return f.read()


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """Every document's ids, decoded text and spans as digests.

    Nulls, long texts, empty tables and repeated rows: see digested().
    """
    return digested(documents(spark, sf_dir), model_bytes(model_path))
