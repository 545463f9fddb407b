"""All pairs without a shuffle: each of a number of tasks takes its own strip and reads the whole table past it.

What grows with the square of the rows is arithmetic and reading.  Nothing of it is shuffled, written or kept: a task
holds its strip and one batch of packed blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankloom.plans.shared import fresh_path

#: Tasks of one plan.
BRANCHES = 64

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def passes(tasks: Iterable[tuple[DataFrame, Run]], schema: str, tag: str) -> DataFrame | None:
    """Rows of all tasks (a table and what runs over it), each table read by one task; None without tasks.

    Beyond BRANCHES tasks, which are planned together, rows are written as they come.
    """
    tasks, path = iter(tasks), None
    spark = None
    while plans := [table.coalesce(1).mapInArrow(run, schema) for table, run in islice(tasks, BRANCHES)]:
        n = len(plans)
        plans.append(_apart(plans[0]))
        while len(plans) > 1:  # in pairs, so that no plan is analysed once for each task beside it
            plans = [reduce(DataFrame.unionByName, plans[i : i + 2]) for i in range(0, len(plans), 2)]
        own = plans[0]
        if path is None and n < BRANCHES:
            return own
        spark = own.sparkSession
        path = path or fresh_path(spark, tag)
        own.write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path) if path else None


def _apart(like: DataFrame) -> DataFrame:
    """No rows, in two partitions: a union of single partitions alone would be one partition, and all its tasks one task."""
    none = like.sparkSession.range(0, 2, 1, 2).filter("id < 0")
    return none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema])


def own_first(rows: Iterator, is_own: Callable[[object], bool], n_own: int) -> Iterator:
    """rows with the n_own of the own strip before all others; what comes earlier waits."""
    early, missing = [], n_own
    for row in rows:
        if missing and not is_own(row):
            early.append(row)
            continue
        missing -= is_own(row) and missing > 0
        yield row
        if not missing and early:
            yield from early
            early = []
    yield from early
