"""Tables in the folder that driver and executors share (spark.checkpoint.dir), kept for later sessions.

A landed table is made once for an input and bucketed by a key: tables of equal buckets join and group on it without a shuffle.
Its name holds a fingerprint of the input's files (path, length, modification time) and of the code that makes it, so a file
that is written again, at whatever size, gives another table. A small JSON file, written last, says that a table is whole and
where it lies; it is all that a later session needs.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from importlib import resources

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of input for each bucket, and the least and most buckets (Spark allows 100,000).
BUCKET_BYTES, FEWEST, MOST = 64 << 20, 8, 1 << 16
#: Seconds that a table stays after a newer one has taken its place, as others may still read it.
KEEP_SECONDS = 86_400
LOCK_SECONDS = 60


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only a local master may go without one; it gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = f"file://{tempfile.gettempdir()}/agorascope-checkpoints"
    spark.conf.set("spark.checkpoint.dir", root)
    return root


# --- small files and folders by Hadoop's file systems, so any store will do


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    fs, place = _at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(place)) if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def modified(spark: SparkSession, path: str) -> float:
    """When a file or folder was written last, in seconds since the epoch."""
    fs, place = _at(spark, path)
    return fs.getFileStatus(place).getModificationTime() / 1000


def read_json(spark: SparkSession, path: str) -> dict | None:
    """What a small file holds; None if it is not there."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def create_json(spark: SparkSession, path: str, held: dict) -> bool:
    """Writes a small file whole under its name, unless the name is taken: then False.

    Some stores rename over a file that is there, so writers of a name take turns by a lock; one that its writer left
    behind is broken after LOCK_SECONDS."""
    fs, place = _at(spark, path)
    draft, lock = (_at(spark, f"{path}.{end}")[1] for end in (f"{uuid.uuid4().hex}.tmp", "lock"))
    stream = fs.create(draft, False)
    stream.write(json.dumps(held).encode())
    stream.close()
    while not fs.exists(place):
        try:
            fs.create(lock, False).close()
        except Exception:  # noqa: BLE001 of whatever kind the store raises for a taken name
            if fs.exists(lock) and time.time() - fs.getFileStatus(lock).getModificationTime() / 1000 > LOCK_SECONDS:
                fs.delete(lock, False)
            time.sleep(0.1)
            continue
        first = not fs.exists(place) and fs.rename(draft, place)
        fs.delete(lock, False)
        if first:
            return True
    fs.delete(draft, False)
    return False


# --- fingerprints


def files_of(spark: SparkSession, *paths: str) -> DataFrame:
    """path, length, modificationTime of all files below the paths, listed anew each time; contents are not read."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    return rows.select("path", "length", "modificationTime")


def fingerprint(spark: SparkSession, *paths: str, more: str = "") -> str:
    """32 hex digits that change when a file below the paths appears, goes, or is written again. The manifest is reduced
    where it is listed: sums of hashes come to the driver, not the files."""
    each = F.xxhash64("path", "length", "modificationTime")
    again = F.xxhash64(F.lit(1), "modificationTime", "length", "path")
    held = files_of(spark, *paths).agg(F.count("*"), F.sum("length"), F.sum(each.cast("decimal(38)")), F.sum(again.cast("decimal(38)"))).first()
    return hashlib.sha256(repr((*map(str, held), more)).encode()).hexdigest()[:32]


def _sources(folder) -> Iterator[str]:
    for entry in sorted(folder.iterdir(), key=lambda x: x.name):
        if entry.name.endswith(".py"):
            yield entry.read_text()


@functools.cache
def code_digest() -> str:
    """Changes with the code that tables are made by."""
    root = resources.files("agorascope")
    text = [x for part in ("functions", "operators", "plans", "sources") for x in _sources(root / part)]
    return hashlib.sha256("\n".join(text).encode()).hexdigest()[:16]


# --- landed tables


def size_of(rows: DataFrame) -> int:
    """Bytes of the files behind a scan, as the planner knows them."""
    return int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def buckets_for(size: int) -> int:
    return min(MOST, max(FEWEST, 1 << math.ceil(math.log2(max(1, size / BUCKET_BYTES)))))


def landed(spark: SparkSession, name: str, sources: list[str], version: str, size: int, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table `name` made from the files `sources` at a fingerprint `version`, each bucket one file.

    It is made if no session has made it yet. Older tables of this name and sources go a day after they were made."""
    root = f"{shared_dir(spark)}/landed"
    own = f"{name}-{version}"
    held = read_json(spark, f"{root}/{own}.json")
    if held is None:
        buckets, place = buckets_for(size), f"{root}/{own}-{uuid.uuid4().hex}"
        rows = build().repartition(buckets, key)
        made = f"{name}_{uuid.uuid4().hex}"
        rows.write.option("path", place).bucketBy(buckets, key).sortBy(key).saveAsTable(made)
        held = {"name": name, "sources": sources, "place": place, "buckets": buckets, "key": key, "schema": rows.schema.json(), "made": time.time()}
        if not create_json(spark, f"{root}/{own}.json", held):  # another session was first
            spark.sql(f"DROP TABLE IF EXISTS {made}")
            delete(spark, place)
            held = read_json(spark, f"{root}/{own}.json")
        sweep(spark)
    # The same files under a name of this session's catalog.
    table = "landed_" + hashlib.sha256(held["place"].encode()).hexdigest()[:24]
    if not spark.catalog.tableExists(table):
        columns = StructType.fromJson(json.loads(held["schema"])).toDDL()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({held['key']}) SORTED BY ({held['key']}) INTO {held['buckets']} BUCKETS LOCATION '{held['place']}'")
    return spark.table(table)


def sweep(spark: SparkSession, keep_seconds: float = KEEP_SECONDS) -> list[str]:
    """Deletes landed tables that newer ones of the same name and sources have replaced, once they are old enough. Their names."""
    root = f"{shared_dir(spark)}/landed"
    held = {x: y for x in names(spark, root) if x.endswith(".json") and (y := read_json(spark, f"{root}/{x}"))}
    newest = {}
    for x, y in held.items():
        k = (y["name"], *y["sources"])
        newest[k] = max(newest.get(k, (0, "")), (y["made"], x))
    gone = [x for x, y in held.items() if newest[(y["name"], *y["sources"])][1] != x and y["made"] <= time.time() - keep_seconds]
    for x in gone:
        for path in (f"{root}/{x}", held[x]["place"]):
            delete(spark, path)
    return gone


def kept(rows: DataFrame, name: str) -> DataFrame:
    """The rows as a table of their own in the shared folder: what follows reads it and does not compute them anew."""
    path = f"{shared_dir(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
