"""Calls to outside models as operators: embedders and judges behind a small interface, with deterministic stubs.

A provider is built once per task.  Batches that fail are tried again with growing waits, then item by item;
what still fails comes back null, so the next run's anti-join takes it up again.
"""

from __future__ import annotations

import hashlib
import random
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankloom.plans.shared import ship

from .store import missing


class Embedder(Protocol):
    model: str

    def embed(self, texts: list[str]) -> list[list[float]]: ...


class Generator(Protocol):
    model: str

    def complete(self, prompts: list[str]) -> list[str]: ...


class HashEmbedder:
    """A stub: the sum of a pseudo-random unit vector per word, so texts that share words lie close."""

    def __init__(self, dims: int = 32, model: str = "hash"):
        self.dims, self.model = dims, model

    def embed(self, texts: list[str]) -> list[list[float]]:
        out = []
        for text in texts:
            total = np.zeros(self.dims)
            for word in text.lower().split():
                seed = int.from_bytes(hashlib.md5(word.encode("utf-8", "surrogatepass")).digest()[:8], "little")
                total += np.random.default_rng(seed).normal(size=self.dims)
            out.append((total / max(np.linalg.norm(total), 1e-12)).tolist())
        return out


class RuleGenerator:
    """A stub that answers each prompt by a function."""

    def __init__(self, rule: Callable[[str], str], model: str = "rule"):
        self.rule, self.model = rule, model

    def complete(self, prompts: list[str]) -> list[str]:
        return [self.rule(p) for p in prompts]


def with_retry(call: Callable[[list], list], items: list, tries: int = 8, first_wait: float = 3.0, longest: float = 120.0, sleep: Callable[[float], None] = time.sleep) -> list:
    """call(items), tried again with doubled waits (spread by 30%), then one by one; null for each that fails."""
    rng = random.Random(len(items))
    for n in range(tries):
        try:
            got = call(items)
            if len(got) != len(items):
                raise ValueError(f"{len(got)} results for {len(items)} items")
            return got
        except Exception:
            if n + 1 < tries:
                sleep(min(longest, first_wait * 2**n) * rng.uniform(0.7, 1.3))
    if len(items) == 1:
        return [None]
    return [with_retry(call, [x], 2, first_wait, longest, sleep)[0] for x in items]


def embed_missing(pages: DataFrame, done: DataFrame, make: Callable[[], Embedder], keys: list[str], text_col: str = "doc_content", batch: int = 64, workers: int | None = None, **retry) -> DataFrame:
    """Vectors (keys, model, dims, vec) of pages that aren't blank and have none of the model yet in done (keys, model, ...).

    Texts that fail have no row.
    """
    from rankloom.functions.text import is_blank

    ship(pages.sparkSession)
    model = make().model
    todo = missing(pages.filter(~is_blank(text_col)), done.filter(F.col("model") == model), keys).select(*keys, F.col(text_col).alias("__text"))
    todo = todo.repartition(workers) if workers else todo
    fields = ", ".join(f"`{k}` {todo.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                vecs = with_retry(own.embed, part.column(len(keys)).to_pylist(), **retry)
                good = [i for i, v in enumerate(vecs) if v is not None]
                take = pa.array(good, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i).take(take) for i in range(len(keys))], pa.array([model] * len(good)), pa.array([len(vecs[i]) for i in good], pa.int32()), pa.array([vecs[i] for i in good], pa.list_(pa.float32()))],
                    [*keys, "model", "dims", "vec"],
                )

    return todo.mapInArrow(run, f"{fields}, model string, dims int, vec array<float>")


def complete(rows: DataFrame, make: Callable[[], Generator], prompt: Column | str, out: str = "response", batch: int = 16, **retry) -> DataFrame:
    """rows with a generator's answer to each prompt in out; null where it fails."""
    ship(rows.sparkSession)
    given = rows.withColumn("__prompt", F.col(prompt) if isinstance(prompt, str) else prompt)
    schema = rows.withColumn(out, F.lit(None).cast("string")).schema
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = make()
        for b in batches:
            for at in range(0, b.num_rows, batch):
                part = b.slice(at, batch)
                got = with_retry(own.complete, part.column(len(names)).to_pylist(), **retry)
                columns = {n: part.column(i) for i, n in enumerate(names)} | {out: pa.array(got, pa.string())}
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return given.mapInArrow(run, schema)
