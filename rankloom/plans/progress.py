"""Rate and remaining time of running Spark jobs, from the tasks they have finished."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def run_stats(done: int, total: int, seconds: float) -> dict[str, float | None]:
    """done, total, share, rate per second, and the seconds that the rest takes at that rate (None before anything is done)."""
    rate = done / seconds if seconds > 0 else 0.0
    return {"done": done, "total": total, "share": done / total if total else 1.0, "rate": rate, "eta": max(0, total - done) / rate if rate > 0 else (0.0 if done >= total else None)}


def duration(seconds: float) -> str:
    """Such as 45s, 3m 05s or 2h 01m."""
    s = int(round(seconds))
    if s < 60:
        return f"{s}s"
    return f"{s // 60}m {s % 60:02d}s" if s < 3600 else f"{s // 3600}h {s % 3600 // 60:02d}m"


def _tasks(spark: SparkSession) -> tuple[int, int]:
    """Finished and all tasks of the stages that run now."""
    tracker = spark.sparkContext.statusTracker()
    known = [s for s in map(tracker.getStageInfo, tracker.getActiveStageIds()) if s]
    return sum(s.numCompletedTasks for s in known), sum(s.numTasks for s in known)


@contextmanager
def watched(spark: SparkSession, what: str, every: float = 15.0, tell: Callable[[str], None] = log.info) -> Iterator[None]:
    """Tell every so many seconds how far the session's running stages are, their rate and what is left."""
    ended, began = threading.Event(), time.monotonic()

    def run() -> None:
        while not ended.wait(every):
            s = run_stats(*_tasks(spark), time.monotonic() - began)
            left = "unknown" if s["eta"] is None else duration(s["eta"])
            tell(f"{what}: {s['done']} of {s['total']} tasks ({100 * s['share']:.1f}%), {s['rate']:.2f} a second, elapsed {duration(time.monotonic() - began)}, left {left}")

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        ended.set()
        thread.join()
