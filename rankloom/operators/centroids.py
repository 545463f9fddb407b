"""Centroids of documents, and their principal components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.vectors import dot, is_valid, normalized

#: Largest dimension of vectors whose covariance a driver holds (128 MB).
MOST_DIMS = 4096


def centroids(vectors: DataFrame, by: str) -> DataFrame:
    """by, n, center: the mean of the unit vectors (vec) of each document, made a unit vector again.

    Vectors that aren't finite or have no length don't count.  Sums per dimension combine before the shuffle.
    """
    unit = vectors.filter(is_valid("vec")).select(by, F.posexplode(normalized(F.col("vec").cast("array<double>"))).alias("pos", "x"))
    means = unit.groupBy(by, "pos").agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"))
    rows = means.groupBy(by).agg(F.max("n").alias("n"), F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("center"))
    return rows.withColumn("center", normalized("center"))


def pca(centers: DataFrame, k: int = 2) -> dict:
    """mean, components (k unit rows) and explained share of each, of column center.

    Sums and products per pair of dimensions are added up in the tasks; only these come to the driver.  Each component's
    largest entry is positive.
    """
    import pyarrow as pa

    def moments(batches):
        n, s, p = 0, None, None
        for batch in batches:
            if batch.num_rows:
                m = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, -1)
                if m.shape[1] > MOST_DIMS:
                    raise ValueError(f"vectors of more than {MOST_DIMS} dimensions")
                n += len(m)
                s = m.sum(axis=0) if s is None else s + m.sum(axis=0)
                p = m.T @ m if p is None else p + m.T @ m
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([s.tobytes()], pa.binary()), pa.array([p.tobytes()], pa.binary())], ["n", "s", "p"])

    n, s, p = 0, 0.0, 0.0
    for r in centers.select(F.col("center").cast("array<double>")).mapInArrow(moments, "n long, s binary, p binary").toLocalIterator():
        own = np.frombuffer(r["s"])
        n, s, p = n + r["n"], s + own, p + np.frombuffer(r["p"]).reshape(len(own), -1)
    if not n:
        return {"mean": [], "components": [], "explained": []}
    cov = p / n - np.outer(s / n, s / n)
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:k]
    rows = axes[:, order].T
    rows = rows * np.sign(rows[np.arange(len(rows)), np.abs(rows).argmax(axis=1)])[:, None]
    total = max(float(values.clip(0).sum()), 1e-300)
    return {"mean": (s / n).tolist(), "components": rows.tolist(), "explained": (values[order].clip(0) / total).tolist()}


def project(rows: DataFrame, model: dict, col: str = "center") -> DataFrame:
    """rows with x and y, their centred vectors on the first two components."""
    centred = F.zip_with(col, F.array(*map(F.lit, model["mean"])), lambda a, m: a - m)
    at = lambda i: dot(centred, F.array(*map(F.lit, model["components"][i]))) if len(model["components"]) > i else F.lit(0.0)
    return rows.withColumns({"x": at(0), "y": at(1)})


def page_count_percentiles(pages: DataFrame, file: str) -> DataFrame:
    counts = pages.groupBy(file).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.count(F.lit(1)).alias("n_documents"), F.percentile("n", 0.5).alias("median_pages"), F.percentile("n", 0.9).alias("p90_pages"))


def page_count_color(count: str) -> Column:
    """A page count's place from 0 to 1 between the smallest and largest, on a log scale."""
    one = Window.partitionBy(F.lit(0))
    x, lo, hi = F.log1p(count), F.min(F.log1p(count)).over(one), F.max(F.log1p(count)).over(one)
    return F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(F.lit(0.0))


def reservoir(rows: DataFrame, n: int, *keys: str, seed: int = 42) -> DataFrame:
    """n rows of the smallest key hash: a sample that any split of the rows gives alike."""
    return rows.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)
