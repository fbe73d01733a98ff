"""Tables in parts, copy on write: a change writes the parts that it touches anew, and a new version names all parts.

A version is a small JSON file, path/versions/<n>.json, that says in which folder each part lies. It is written last and
only if nobody has written that number: readers see the old version or the new one, never a mix, and of two writers that
began with the same version one fails with Conflict (or tries again). Parts that a change does not touch stay where they are.
Rows of a part that grows large are split into files by adaptive execution (a rebalance), so no part is one task.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agorascope.sources import store

#: The column that says which part a row is of, while it is written; its values are the parts' names.
PART = "part_"
#: Name of the part of rows without one.
NO_PART = "none"


class Conflict(RuntimeError):
    """Another writer has made the next version."""


class Versioned:
    """A table at `path`, made with `schema` (or what a function gives as such) if there is none."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | Callable[[], StructType] | None = None, **meta):
        self.spark, self.path = spark, path
        held = self._state()
        if held is None:
            if schema is None:
                raise ValueError(f"no table at {path}")
            schema = schema() if callable(schema) else schema
            store.create_json(spark, f"{path}/versions/{0:010}.json", {"version": 0, "parts": {}, "batches": {}, "schema": schema.json(), "meta": meta})
            held = self._state()
        self.schema, self.meta = StructType.fromJson(json.loads(held["schema"])), held["meta"]

    def versions(self) -> list[int]:
        return [int(x[:-5]) for x in store.names(self.spark, f"{self.path}/versions") if x.endswith(".json")]

    def _state(self, version: int | None = None) -> dict | None:
        found = self.versions()
        if version is None and not found:
            return None
        return store.read_json(self.spark, f"{self.path}/versions/{max(found) if version is None else version:010}.json")

    def version(self) -> int:
        return self._state()["version"]

    def parts(self, version: int | None = None) -> dict[str, str]:
        """Where each part that has rows lies."""
        return self._state(version)["parts"]

    def read(self, parts: list[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of all parts, or of those named; no other folder is listed or read."""
        held = self.parts(version)
        return self._rows([held[p] for p in (sorted(held) if parts is None else parts) if p in held])

    def _rows(self, places: list[str]) -> DataFrame:
        if not places:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{p}" for p in places])

    def replace(self, rows: DataFrame, parts: list[str], base: int, batch: tuple[str, int] | None = None) -> int:
        """The parts named hold these rows (with their part's name in PART) from now on; a part without rows goes. base: the
        version that the rows were made from. batch: source and number of what is applied, so it is not applied twice."""
        state, folder = self._state(base), f"data/{uuid.uuid4().hex}"
        rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema], PART).hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.path}/{folder}")
        made = {x[len(PART) + 1 :]: f"{folder}/{x}" for x in store.names(self.spark, f"{self.path}/{folder}") if x.startswith(f"{PART}=")}
        if set(made) - set(parts):
            raise ValueError(f"rows of parts that were not to change: {sorted(set(made) - set(parts))[:5]}")
        held = {k: v for k, v in state["parts"].items() if k not in set(parts)} | made
        batches = state["batches"] | ({batch[0]: batch[1]} if batch else {})
        if not store.create_json(self.spark, f"{self.path}/versions/{base + 1:010}.json", state | {"version": base + 1, "parts": held, "batches": batches}):
            store.delete(self.spark, f"{self.path}/{folder}")
            raise Conflict(f"{self.path}: version {base + 1} is taken")
        return base + 1

    def applied(self, batch: tuple[str, int]) -> bool:
        return self._state()["batches"].get(batch[0], -1) >= batch[1]

    def vacuum(self, keep: int = 2) -> None:
        """Deletes all but the newest versions, and folders that none of those names."""
        found = sorted(self.versions())
        used = {v.split("/")[1] for n in found[-keep:] for v in self.parts(n).values()}
        for n in found[:-keep]:
            store.delete(self.spark, f"{self.path}/versions/{n:010}.json")
        for folder in store.names(self.spark, f"{self.path}/data"):
            if folder not in used:
                store.delete(self.spark, f"{self.path}/data/{folder}")


class Keyed(Versioned):
    """A table whose parts are buckets of a key's hash: a change of some keys writes their buckets anew, and no others."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | None = None, key: str | None = None, buckets: int = 64):
        super().__init__(spark, path, schema, key=key, buckets=buckets)
        self.key, self.buckets = self.meta["key"], self.meta["buckets"]

    def bucket(self, key: Column | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key) if key is None else key), F.lit(self.buckets)).cast("string")

    def apply(self, changes: DataFrame, work: Callable[[DataFrame, DataFrame], DataFrame], batch: tuple[str, int] | None = None, tries: int = 3) -> list[str]:
        """work(rows of the touched buckets, changes) gives the new rows of these buckets. The buckets, none if the batch has
        been applied already. After a conflict it is worked out again from the version that won."""
        changes = store.kept(changes.withColumn(PART, self.bucket()), "changes")
        touched = sorted(r[PART] for r in changes.select(PART).distinct().collect())
        for turn in range(tries):
            if not touched or batch and self.applied(batch):
                return []
            base = self.version()
            rows = work(self.read(touched, base), changes.drop(PART))
            try:
                self.replace(rows.withColumn(PART, self.bucket()), touched, base, batch)
                return touched
            except Conflict:
                if turn + 1 == tries:
                    raise
        return []
