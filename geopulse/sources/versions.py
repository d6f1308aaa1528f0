"""Tables kept as versions: a reader always finds a whole table, a repeated write replaces its own attempt."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Merge = Callable[[DataFrame | None, DataFrame], DataFrame]


def filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs.Path
    return jvm(path).getFileSystem(spark._jsc.hadoopConfiguration()), jvm


class VersionedSink:
    """A parquet table that each write renews as a whole, under the number of the write.

    A version counts once its ``_SUCCESS`` file is there, so nothing is renamed and a crash leaves the former version.
    For tables bounded by a dimension, and for published marts.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 2):
        self.spark, self.root, self.keep = spark, root, keep

    def _path(self, version: int) -> str:
        return f"{self.root}/version={version:010d}"

    def versions(self) -> list[int]:
        fs, path = filesystem(self.spark, self.root)
        if not fs.exists(path(self.root)):
            return []
        names = [status.getPath() for status in fs.listStatus(path(self.root))]
        return sorted(int(p.getName().split("=")[1]) for p in names if fs.exists(path(f"{p}/_SUCCESS")))

    def latest(self, before: int | None = None) -> DataFrame | None:
        found = [v for v in self.versions() if before is None or v < before]
        return self.spark.read.parquet(self._path(found[-1])) if found else None

    def fold(self, batch: DataFrame, number: int, merge: Merge) -> None:
        merged = merge(self.latest(before=number), batch)
        merged.write.mode("overwrite").option("compression", "zstd").parquet(self._path(number))
        fs, path = filesystem(self.spark, self.root)
        for version in self.versions()[: -self.keep]:
            fs.delete(path(self._path(version)), True)


class PeriodSink:
    """A keyed table split by period; a write renews only the periods it touches, each as a new version.

    ``period`` must follow from the key, so that all copies of a key share one. A write with number ``n`` reads what
    writes before ``n`` left and never touches it; a version goes only after two newer ones of its period are whole,
    so a write that broke off at any point can be replayed.
    """

    def __init__(self, spark: SparkSession, root: str, period: Column, keep: int = 2):
        self.spark, self.root, self.keep = spark, root, keep
        self.period = F.concat(F.lit("p"), period.cast("string"))

    def _path(self, number: int) -> str:
        return f"{self.root}/batch={number:010d}"

    def _versions(self, before: int | None = None) -> dict[str, list[str]]:
        """Paths of each period, oldest first, of finished writes."""
        fs, path = filesystem(self.spark, self.root)
        found: dict[str, list[str]] = defaultdict(list)
        if not fs.exists(path(self.root)):
            return found
        for folder in sorted(status.getPath().toString() for status in fs.listStatus(path(self.root))):
            number = int(folder.rsplit("=", 1)[1])
            if (before is None or number < before) and fs.exists(path(f"{folder}/_SUCCESS")):
                for status in fs.listStatus(path(folder)):
                    name = status.getPath().getName()
                    if name.startswith("_period="):
                        found[name].append(status.getPath().toString())
        return found

    def _read(self, paths: list[str]) -> DataFrame | None:
        return self.spark.read.option("mergeSchema", "true").parquet(*paths) if paths else None

    def latest(self) -> DataFrame | None:
        return self._read([paths[-1] for _, paths in sorted(self._versions().items())])

    def fold(self, batch: DataFrame, number: int, merge: Merge) -> None:
        touched = {f"_period={r[0]}" for r in batch.select(self.period).distinct().collect()}  # as many as periods
        old = self._versions(before=number)
        current = self._read([paths[-1] for period, paths in sorted(old.items()) if period in touched])
        merged = merge(current, batch).withColumn("_period", self.period)
        merged.write.mode("overwrite").partitionBy("_period").parquet(self._path(number))
        fs, path = filesystem(self.spark, self.root)
        for period, paths in self._versions(before=number + 1).items():
            for stale in paths[: -self.keep] if period in touched else ():
                fs.delete(path(stale), True)
