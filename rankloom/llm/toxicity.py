"""Toxicity: a convolutional text classifier trained in numpy.

A word hashes to rows of an embedding table, one for itself and one for each run of five characters
in it, and is their mean; filters of several widths slide over the embedded words, each keeps its
largest response in the text (max pooling), and a logistic layer scores those.  The largest response
has one place, so only that window's words get a gradient.  Rows that too few training texts touch
are zero, so words never seen add nothing; the others start small, their first number at how far
the row's share of toxic texts lies from that of all texts, in standard deviations.  A part of the
labelled rows is kept from the fit; on it the score is shifted so that 0.5 separates best, and each
language gets a threshold.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, materialize, ship, text_or_empty

ROWS = 1 << 17
DIM = 12
WIDTHS = (1, 2, 3)
FILTERS = 8
GRAM = 5
EPOCHS = 5
BATCH = 64
#: The fit takes at most so many labelled rows, those of the smallest hash, and so many words in all.
FIT_ROWS = 6_000
FIT_WORDS = 6_000_000
#: Labelled texts that must hold a word for its row to be more than zero.
LEAST_TEXTS = 3
#: Toxic rows of the calibration part that a language needs for a threshold of its own.
LEAST_TOXIC = 15
#: Words that are scored at a time.
CHUNK = 1 << 16
#: Words whose responses a task keeps; it forgets all when full, which changes no score.
_CACHE = 200_000
_MARKS = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’…–—¡¿"


def rows_of(word: str) -> list[int]:
    """The embedding rows of a word (lower case): itself and its character runs, its ends marked."""
    bare = word.strip(_MARKS) or word
    marked = f"<{bare}>"
    grams = {marked[i : i + GRAM] for i in range(len(marked) - GRAM + 1)}
    return [zlib.crc32(x.encode("utf-8", "surrogatepass")) % ROWS for x in (f"w {bare}", *sorted(grams))]


class Vocabulary(dict):
    """Raw word (lower case) to its number; bags has each word's rows, responses what the filters say."""

    def __init__(self):
        self.bags: list[list[int]] = []

    def __missing__(self, word: str) -> int:
        got = self[word] = len(self.bags)
        self.bags.append(rows_of(word))
        return got

    def numbers(self, text: str) -> np.ndarray:
        found = text.lower().split()
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def embed(table: np.ndarray, bags: list[list[int]]) -> np.ndarray:
    """The mean of each bag's rows."""
    if not bags:
        return np.zeros((0, table.shape[1]), table.dtype)
    sizes = np.array([len(b) for b in bags])
    flat = np.fromiter((r for b in bags for r in b), np.int64, int(sizes.sum()))
    return np.add.reduceat(table[flat], np.concatenate([[0], np.cumsum(sizes)[:-1]]), axis=0) / sizes[:, None].astype(table.dtype)


@dataclass
class Model:
    """table: (ROWS, DIM); taps[k]: (width, DIM, FILTERS) of width number k."""

    table: np.ndarray
    taps: list[np.ndarray]
    bias: np.ndarray
    out: np.ndarray
    shift: float
    thresholds: dict[str | None, float]

    def __post_init__(self):
        self._clear()

    def _clear(self) -> None:
        self.words, self.known = Vocabulary(), 0
        self.responses = np.zeros((1024, len(self.bias) and sum(w * FILTERS for w in WIDTHS)), np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "known", "responses")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._clear()

    def _respond(self) -> None:
        """What every place of every filter adds for each word that is new."""
        new = embed(self.table, self.words.bags[self.known :])
        if len(self.words.bags) > len(self.responses):
            self.responses = np.concatenate([self.responses, np.zeros((max(len(new), len(self.responses)), self.responses.shape[1]), np.float32)])
        self.responses[self.known : len(self.words.bags)] = np.concatenate([new @ t[j] for t in self.taps for j in range(len(t))], axis=1)
        self.words.bags[self.known :] = [None] * len(new)  # only their responses are needed from now on
        self.known = len(self.words.bags)

    def logit(self, text: str) -> float:
        """The score before the logistic function; a text without words is one empty window."""
        if len(self.words) > _CACHE:
            self._clear()
        ids = self.words.numbers(text)
        if self.known < len(self.words.bags):
            self._respond()
        best = np.full(len(self.bias), -np.inf, np.float32)
        pad = max(WIDTHS) - 1
        for at in range(0, max(1, len(ids)), CHUNK):
            part = self.responses[ids[at : at + CHUNK + pad]]
            n = max(1, min(CHUNK, len(ids) - at))
            part = np.concatenate([part, np.zeros((max(0, n + pad - len(part)), part.shape[1]), np.float32)])
            col = 0
            for k, w in enumerate(WIDTHS):
                total = part[:n, col : col + FILTERS].copy()
                for j in range(1, w):
                    total += part[j : n + j, col + j * FILTERS : col + (j + 1) * FILTERS]
                col += w * FILTERS
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                best[cols] = np.maximum(best[cols], total.max(axis=0))
        return float(np.maximum(best + self.bias, 0) @ self.out[:-1] + self.out[-1]) + self.shift

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -30, 30))))


def _f1_cut(logits: np.ndarray, labels: np.ndarray) -> float:
    """The logit at and above which calling rows toxic gives the best F1, midway to the next one below."""
    order = np.argsort(-logits, kind="stable")
    x, y = logits[order], labels[order]
    hits = np.cumsum(y)
    f1 = 2 * hits / (np.arange(1, len(x) + 1) + max(1, y.sum()))
    f1[np.append(x[1:] == x[:-1], False)] = -1  # rows of one logit go together
    k = int(np.argmax(f1))
    return float((x[k] + x[k + 1]) / 2) if k + 1 < len(x) else float(x[k] - 1)


def fit(texts: list[str], labels: np.ndarray, langs: list[str | None], seed: int = 7) -> Model:
    """Train on texts.  Every fourth one calibrates; the others fit the weights."""
    rng = np.random.default_rng(seed)
    held = np.arange(len(texts)) % 4 == 3 if len(texts) >= 40 else np.zeros(len(texts), bool)
    own = np.nonzero(~held)[0]
    words = Vocabulary()
    ids = {i: words.numbers(texts[i]) for i in own}
    pad = max(WIDTHS) - 1
    bags = words.bags
    seen, bad = np.zeros(ROWS, np.float32), np.zeros(ROWS, np.float32)
    for i in own:
        if len(ids[i]):
            rows = np.unique(np.concatenate([bags[w] for w in np.unique(ids[i])]))
            seen[rows] += 1
            bad[rows] += labels[i]
    share = float(labels[own].mean()) if len(own) else 0.5
    live = seen >= min(LEAST_TEXTS, max(1, len(own) // 20))
    table = rng.normal(0, 0.02, (ROWS, DIM)).astype(np.float32)
    table[:, 0] = np.clip((bad - seen * share) / np.sqrt(seen * share * (1 - share) + 1) / 3, -2, 4)
    table *= live[:, None]
    taps = [rng.normal(0, 0.2, (w, DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for t in taps:
        t[:, 0, :] = np.abs(t[:, 0, :]) + 0.2
    bias = np.zeros(FILTERS * len(WIDTHS), np.float32)
    out = np.append(np.abs(rng.normal(0, 0.2, len(bias))), -1.0).astype(np.float32)
    weight = {1: 0.5 / max(share, 0.02), 0: 0.5 / max(1 - share, 0.02)}
    params = [*taps, bias, out]
    sums, table_sums = [np.full_like(p, 1e-2) for p in params], np.full_like(table, 1e-2)
    for epoch in range(EPOCHS):
        rng.shuffle(own)
        rate = 0.05 / (1 + 0.3 * epoch)
        for start in range(0, len(own), BATCH):
            batch = own[start : start + BATCH]
            met = np.unique(np.concatenate([ids[i] for i in batch]))
            vectors = np.concatenate([embed(table, [bags[w] for w in met]), np.zeros((1, DIM), np.float32)])
            grads = [np.zeros_like(p) for p in params]
            d_vec = np.zeros_like(vectors)
            for i in batch:
                at_met = np.concatenate([np.searchsorted(met, ids[i]), np.full(pad + (not len(ids[i])), len(met))])
                n = len(at_met) - pad
                e = vectors[at_met]
                where, best = [], []
                for k, w in enumerate(WIDTHS):
                    total = e[:n] @ taps[k][0]
                    for j in range(1, w):
                        total += e[j : n + j] @ taps[k][j]
                    at = total.argmax(axis=0)
                    where.append(at)
                    best.append(total[at, np.arange(FILTERS)])
                pooled = np.concatenate(best) + bias
                act = np.maximum(pooled, 0)
                p = 1 / (1 + np.exp(-np.clip(act @ out[:-1] + out[-1], -30, 30)))
                d = float((p - labels[i]) * weight[int(labels[i])]) / len(batch)
                grads[-1] += d * np.append(act, 1)
                da = d * out[:-1] * (pooled > 0)
                grads[-2] += da
                for k, w in enumerate(WIDTHS):
                    dk = da[k * FILTERS : (k + 1) * FILTERS]
                    for j in range(w):
                        at = where[k] + j
                        grads[k][j] += e[at].T * dk
                        np.add.at(d_vec, at_met[at], taps[k][j].T * dk[:, None])
            moved = np.nonzero(d_vec[:-1].any(axis=1))[0]
            rows = np.concatenate([bags[met[m]] for m in moved]) if len(moved) else np.zeros(0, np.int64)
            if len(rows):
                parts = np.concatenate([np.repeat(d_vec[m : m + 1] / len(bags[met[m]]), len(bags[met[m]]), axis=0) for m in moved])
                r, inv = np.unique(rows, return_inverse=True)
                g = np.zeros((len(r), DIM), np.float32)
                np.add.at(g, inv, parts)
                g *= live[r][:, None]
                table_sums[r] += g * g
                table[r] -= rate * g / np.sqrt(table_sums[r])
            for q, s, g in zip(params, sums, grads, strict=True):
                g = g + 1e-4 * q
                s += g * g
                q -= rate * g / np.sqrt(s)
    model = Model(table, taps, bias, out, 0.0, {})
    check = np.nonzero(held)[0] if labels[held].sum() >= 5 else np.arange(len(texts))
    logits = np.array([model.logit(texts[i]) for i in check])
    if len(check) and 0 < labels[check].sum() < len(check):
        model.shift = -_f1_cut(logits, labels[check])
    for lang in {langs[i] for i in check}:
        mine = np.array([langs[i] == lang for i in check])
        if labels[check][mine].sum() >= LEAST_TOXIC:
            cut = _f1_cut(logits[mine], labels[check][mine]) + model.shift
            model.thresholds[lang] = float(1 / (1 + np.exp(-np.clip(cut, -30, 30))))
    return model


def held_out(id_col: str):
    """Rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_rows(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS) -> DataFrame:
    """text, toxic and lang of at most `most` labelled rows that aren't held out, those of the smallest hash."""
    order = F.xxhash64(F.lit("fit"), "doc_id")
    known = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    few = known.withColumn("__o", order).orderBy("__o", "doc_id").limit(most)
    joined = docs.select("doc_id", text_or_empty().alias("text"), "lang").join(F.broadcast(few), "doc_id")  # `most` rows
    return materialize(joined, "labelled-texts")


def trained(docs: DataFrame, labels: DataFrame, most: int = FIT_ROWS, most_words: int = FIT_WORDS) -> Model:
    """Fit on the rows of fit_rows(), in the order of their hash, as far as most_words words go.

    Without any label all scores are those of the untrained start shifted by nothing.
    """
    texts, toxic, langs, words = [], [], [], 0
    for r in fit_rows(docs, labels, most).orderBy("__o", "doc_id", F.md5(F.col("text").cast("binary"))).toLocalIterator():
        n = len(r["text"].split())
        if words + n > most_words:
            continue  # a text too long for what is left; shorter ones may fit
        words += n
        texts.append(r["text"])
        toxic.append(r["toxic"])
        langs.append(r["lang"])
    return fit(texts, np.array(toxic, np.int64), langs)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row of docs.

    A null or empty text is scored as a text without words; any length is scored whole; equal texts
    score the same; rows that repeat stay; an empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)  # ROWS x DIM floats, 6 MB
    given = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = np.array([own.score(t.as_py()) for t in batch.column("text")], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "score"])

    return given.mapInArrow(run, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; threshold is its language's, toxic_by_language the verdict under it.

    Nulls, ties and empty tables: see scored(); a language without a threshold has 0.5.
    """
    docs = documents(spark, sf_dir)
    model = trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    given = docs.select("doc_id", text_or_empty().alias("text"), F.col("lang").cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = np.array([own.score(t.as_py()) for t in batch.column("text")], np.float64)
            limit = np.array([own.thresholds.get(x, 0.5) for x in batch.column("lang").to_pylist()], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found), pa.array(limit)], ["doc_id", "score", "threshold"])

    rows = given.mapInArrow(run, "doc_id long, score double, threshold double")
    return rows.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "threshold",
        (F.col("score") >= F.col("threshold")).alias("toxic_by_language"),
    )
