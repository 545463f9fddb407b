"""Where intermediate tables go, and how Python workers find this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when it lies beside the driver's code."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir.

    Only where a local session names none (tests) a temporary folder is made and set.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not named and not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not named:
        own = tempfile.mkdtemp(prefix="rankloom-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        named = f"file://{own}"
        sc.setCheckpointDir(named)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def fresh_path(spark: SparkSession, tag: str) -> str:
    """A path of its own in the shared folder; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone; the folder's owner clears it then
        pass


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
