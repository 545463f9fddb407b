"""A Parquet table of whole versions: readers see the last complete one while the next is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class VersionedTable:
    """Folders v00000001, v00000002, ... below a path; a version counts once its _SUCCESS file stands."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _versions(self) -> list[str]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        system = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        names = [s.getPath().getName() for s in system.listStatus(root)]
        return sorted(n for n in names if n.startswith("v") and system.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS")))

    def exists(self) -> bool:
        return bool(self._versions())

    def read(self, schema=None) -> DataFrame:
        """The last version; without any, an empty table of schema."""
        found = self._versions()
        if not found:
            if schema is None:
                raise FileNotFoundError(self.path)
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.path}/{found[-1]}")

    def write(self, rows: DataFrame, *by: str) -> DataFrame:
        """rows as the next version, partitioned by columns; they may come from an older version."""
        found = self._versions()
        number = int(found[-1][1:]) + 1 if found else 1
        target = f"{self.path}/v{number:08d}"
        writer = rows.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(target)
        return self.spark.read.parquet(target)
