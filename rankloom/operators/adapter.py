"""A linear adapter of query vectors: full matrix or low-rank residual, trained on triplets.

Training holds the query and page vectors of one batch of triplets at a time; weights are dims x dims at
most.  Applying it multiplies whole Arrow batches with the weights, which travel to each task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.plans.shared import ship

KINDS = ("full_rank", "low_rank")


@dataclass
class Adapter:
    """v W' + b (full_rank), or v + (v D') U' + b (low_rank)."""

    kind: str
    weights: dict[str, np.ndarray] = field(repr=False)

    @classmethod
    def new(cls, kind: str, dims: int, rank: int = 128, seed: int = 42) -> Adapter:
        """An adapter that changes nothing yet."""
        if kind == "full_rank":
            return cls(kind, {"w": np.eye(dims), "b": np.zeros(dims)})
        if kind == "low_rank":
            limit = np.sqrt(6 / dims)
            return cls(kind, {"down": np.random.default_rng(seed).uniform(-limit, limit, (rank, dims)), "up": np.zeros((dims, rank)), "b": np.zeros(dims)})
        raise ValueError(f"an adapter is one of {', '.join(KINDS)}, not {kind!r}")

    def __call__(self, v: np.ndarray) -> np.ndarray:
        w = self.weights
        return v @ w["w"].T + w["b"] if self.kind == "full_rank" else v + (v @ w["down"].T) @ w["up"].T + w["b"]

    def gradients(self, v: np.ndarray, d: np.ndarray) -> dict[str, np.ndarray]:
        """Of the loss by each weight, for inputs v and the loss's gradient d by their outputs."""
        w = self.weights
        if self.kind == "full_rank":
            return {"w": d.T @ v, "b": d.sum(axis=0)}
        return {"down": (d @ w["up"]).T @ v, "up": d.T @ (v @ w["down"].T), "b": d.sum(axis=0)}

    def to_json(self) -> str:
        return json.dumps({"kind": self.kind, "weights": {k: v.tolist() for k, v in self.weights.items()}})

    @classmethod
    def from_json(cls, text: str) -> Adapter:
        own = json.loads(text)
        return cls(own["kind"], {k: np.array(v) for k, v in own["weights"].items()})


def save(adapter: Adapter, spark, path: str) -> None:
    spark.createDataFrame([(adapter.to_json(),)], "adapter string").write.mode("overwrite").parquet(path)


def load(spark, path: str) -> Adapter:
    return Adapter.from_json(spark.read.parquet(path).first()["adapter"])


def apply(queries: DataFrame, adapter: Adapter, col: str = "vec") -> DataFrame:
    """queries with col (array of numbers) adapted; null vectors stay null."""
    spark = queries.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(adapter)  # dims x dims numbers
    given = queries.withColumn(col, F.col(col).cast("array<double>"))
    at = given.columns.index(col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(at)
            known = raw.drop_null()
            out = iter(sent.value(np.array(known.to_pylist(), float)).tolist() if len(known) else [])
            columns = list(batch.columns)
            columns[at] = pa.array([next(out) if ok else None for ok in raw.is_valid().to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return given.mapInArrow(run, given.schema)


def _unit(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    return m / n, n


def triplet_loss(adapter: Adapter, q: np.ndarray, p: np.ndarray, n: np.ndarray, margin: float) -> tuple[float, dict[str, np.ndarray]]:
    """Mean of max(0, |a - p| - |a - n| + margin) over unit vectors, a the adapted query; and its gradients."""
    a, length = _unit(adapter(q))
    p, n = _unit(p)[0], _unit(n)[0]
    dp, dn = a - p, a - n
    lp, ln = (np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) for x in (dp, dn))
    loss = np.maximum(0, lp - ln + margin)
    d = np.where(loss > 0, dp / lp - dn / ln, 0) / len(q)
    d = (d - a * (a * d).sum(axis=1, keepdims=True)) / length
    return float(loss.mean()), adapter.gradients(q, d)


def train(
    adapter: Adapter, triplets: np.ndarray, validation: np.ndarray, rate: float = 1e-4, decay: float = 0.01, margin: float = 0.2, epochs: int = 50, batch: int = 256, clip: float = 1.0, patience: int = 3, seed: int = 42
) -> tuple[Adapter, list[tuple[float, float]]]:
    """AdamW on triplets (n x 3 x dims: query, positive, negative) with early stopping; the adapter of the best validation loss, and losses per epoch."""
    rng = np.random.default_rng(seed)
    m, v = ({k: np.zeros_like(x) for k, x in adapter.weights.items()} for _ in range(2))
    best, best_loss, worse, losses, step = adapter, np.inf, 0, [], 0
    for _ in range(epochs):
        order = rng.permutation(len(triplets))
        total = []
        for at in range(0, len(order), batch):
            part = triplets[order[at : at + batch]]
            loss, grads = triplet_loss(adapter, part[:, 0], part[:, 1], part[:, 2], margin)
            total.append(loss)
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step += 1
            new = {}
            for k, g in grads.items():
                g = g * min(1.0, clip / max(size, 1e-12))
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                move = (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                new[k] = adapter.weights[k] * (1 - rate * decay) - rate * move
            adapter = Adapter(adapter.kind, new)
        val = triplet_loss(adapter, validation[:, 0], validation[:, 1], validation[:, 2], margin)[0] if len(validation) else float(np.mean(total))
        losses.append((float(np.mean(total)) if total else 0.0, val))
        if val < best_loss:
            best, best_loss, worse = adapter, val, 0
        else:
            worse += 1
            if worse >= patience:
                break
    return best, losses


def triplet_vectors(triplets: DataFrame, queries: DataFrame, corpus: DataFrame) -> DataFrame:
    """q, pos, neg and their vectors qv, pv, nv of triplets (q, pos, neg); rows without a page vector drop out."""
    v = corpus.select("id", F.col("vec").cast("array<double>").alias("v"))
    return (
        triplets.join(queries.select("q", F.col("vec").cast("array<double>").alias("qv")), "q")
        .join(v.select(F.col("id").alias("pos"), F.col("v").alias("pv")), "pos")
        .join(v.select(F.col("id").alias("neg"), F.col("v").alias("nv")), "neg")
        .select("q", "pos", "neg", "qv", "pv", "nv")
    )
