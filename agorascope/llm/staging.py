"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from agorascope.sources.store import shared_dir

#: Shuffle files of a write are of no use once its table is there.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stage:
    """Writes tables below one run's own subfolder and rereads them, which cuts their lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        for held in _scratch:
            held.append(self)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path, before = f"{self.root}/{name}", self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing will read again; without names, all of this run."""
        for name in names or ("",):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}".rstrip("/"))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_scratch: list[list[Stage]] = []


@contextmanager
def scratch() -> Iterator[None]:
    """Deletes, on leaving, what runs begun inside have written: their results must have been written elsewhere by then."""
    _scratch.append([])
    try:
        yield
    finally:
        for stage in _scratch.pop():
            stage.drop()
