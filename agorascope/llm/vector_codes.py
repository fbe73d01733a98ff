"""Vector code compression: product codes of integer vectors, trained by rounds of an RDD treeAggregate.

Vectors lie as columnar blocks: a row holds the ids, the labels and the integers of some thousands of vectors, dimension by
dimension. In each round a task adds up squared distances one dimension at a time for all vectors of a block, picks the nearest
entry per part and adds the vectors into int64 tensors of sums and counts by np.add.at; tensors are merged through a
reduction tree, so the driver gets one of them, whose size is that of the codebooks. Only codebooks are broadcast.

Rows whose vector is null, empty, or holds a null, a non-finite component or one whose squared distances could leave a long
(beyond +-16,000 with 500 dimensions) are dropped, and so are vectors of another length than that of the smallest kept id. A
length that the parts do not divide is filled up with zeros, which change no distance. With equal ids the smaller vector comes
first, null ids come last; fewer kept rows than entries give so many entries. Extra columns are ignored, repeated rows count
each, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.staging import Stage

SCALE = 4096
BLOCK = 8192
#: Labels whose sums are broadcast; more are joined by a shuffle.
BROADCAST_LABELS = 100_000

Tensors = tuple[np.ndarray, np.ndarray]


def integers(flat: np.ndarray, dims: int, parts: int) -> np.ndarray:
    """floor(SCALE * x) of vectors that lie one after the other, as (dimension, vector), filled up to whole parts."""
    rows = np.floor(flat.astype(np.float64).reshape(-1, dims) * SCALE).astype(np.int32)
    return np.ascontiguousarray(np.pad(rows, ((0, 0), (0, -dims % parts))).T)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            data = integers(some.column("vector").flatten().to_numpy(zero_copy_only=False), dims, parts)
            one = lambda c: pa.ListArray.from_arrays(pa.array([0, some.num_rows], pa.int32()), some.column(c))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([one("id"), one("label"), pa.array([data.tobytes()], pa.binary())], ["ids", "labels", "data"])


def nearest(block: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (part, vector) and squared distances of a block under books (part, entry, position); ties go to the lower entry."""
    parts, entries, width = books.shape
    codes, errors = np.empty((parts, block.shape[1]), np.int64), np.empty((parts, block.shape[1]), np.int64)
    for p in range(parts):
        far = np.zeros((entries, block.shape[1]), np.int64)
        for j in range(width):
            gap = block[p * width + j].astype(np.int64) - books[p, :, j, None]
            far += gap * gap
        codes[p] = far.argmin(0)
        errors[p] = far.min(0)
    return codes, errors


def as_block(data: bytes, books: np.ndarray) -> np.ndarray:
    return np.frombuffer(data, np.int32).reshape(books.shape[0] * books.shape[2], -1)


def added(total: Tensors, data: bytes, books) -> Tensors:
    """The tensors with a block's vectors added to their nearest entries."""
    sums, counts = total
    block = as_block(data, books.value)
    codes, _ = nearest(block, books.value)
    width = sums.shape[2]
    for p in range(len(sums)):
        np.add.at(sums[p], codes[p], block[p * width : (p + 1) * width].T)
        np.add.at(counts[p], codes[p], 1)
    return sums, counts


def merged(a: Tensors, b: Tensors) -> Tensors:
    return a[0] + b[0], a[1] + b[1]


def _coded(batches: Iterator[pa.RecordBatch], books) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            codes, errors = nearest(as_block(batch.column("data")[i].as_buffer(), books.value), books.value)
            ids, labels = (batch.column(c)[i].values for c in ("ids", "labels"))
            text = [row.tobytes().hex() for row in codes.T.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(errors.sum(0), pa.int64())], ["vec_id", "label", "code", "error"])


def usable(rows: DataFrame) -> DataFrame:
    """Rows whose vector can be coded."""
    return rows.where("vector is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) * 4096 < sqrt(9.2e18D / size(vector)) / 2)")


def compress(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = 8, entries: int = 16, rounds: int = 6, depth: int = 2) -> DataFrame:
    """vec_id, code (two hex digits per part), error, label_error (errors of the label), codebooks_sha256."""
    spark, stage = rows.sparkSession, Stage(rows.sparkSession, "codes")
    if entries > 256:
        raise ValueError("a code has two hex digits, so a codebook has at most 256 entries")
    rows = usable(rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label")))
    kind = dict(rows.dtypes)["label"]
    first = [r["vector"] for r in rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(1).collect()]
    if not first:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    dims = len(first[0])
    rows = rows.where(F.size("vector") == dims)
    first = [r["vector"] for r in rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()]
    books = integers(np.array(first).ravel(), dims, parts).T.reshape(len(first), parts, -1).transpose(1, 0, 2).astype(np.int64)
    blocks = stage.table(rows.mapInArrow(partial(_blocks, dims=dims, parts=parts), f"ids array<long>, labels array<{kind}>, data binary"), "blocks")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        zero = (np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64))
        vectors = blocks.select("data").rdd.map(lambda r: bytes(r["data"]))
        sums, counts = vectors.treeAggregate(zero, partial(added, books=shared), merged, depth)
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        shared.unpersist()
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    coded = stage.table(blocks.mapInArrow(partial(_coded, books=spark.sparkContext.broadcast(books)), f"vec_id long, label {kind}, code string, error long"), "coded")
    stage.drop("blocks")
    sums = stage.table(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "sums")
    few = sums.count() <= BROADCAST_LABELS
    coded = coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("of")), "left")
    return coded.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def sql(rounds: int = 6) -> str:
    """The same in DuckDB, round by round."""
    steps = [
        """WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
)""",
        "cut AS MATERIALIZED (SELECT vec_id, p, list_slice(v, p * (len(v) // 8) + 1, (p + 1) * (len(v) // 8)) AS x FROM kept, (SELECT unnest(range(8)) AS p))",
        "book0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM cut WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16))",
    ]
    for i in range(rounds + 1):
        steps.append(f"""near{i} AS MATERIALIZED (
  SELECT vec_id, cut.p, x, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) * 16 + e) AS best
  FROM cut JOIN book{i} ON cut.p = book{i}.p GROUP BY vec_id, cut.p, x
)""")
        if i < rounds:
            steps.append(f"""mean{i} AS MATERIALIZED (
  SELECT p, e, list(m ORDER BY j) AS c FROM (
    SELECT p, best % 16 AS e, j, CAST(floor(CAST(sum(x[j]) AS DOUBLE) / count(*)) AS BIGINT) AS m
    FROM (SELECT p, best, x, unnest(range(1, len(x) + 1)) AS j FROM near{i}) GROUP BY p, best % 16, j) GROUP BY p, e
)""")
            steps.append(f"book{i + 1} AS MATERIALIZED (SELECT book{i}.p, book{i}.e, coalesce(mean{i}.c, book{i}.c) AS c FROM book{i} LEFT JOIN mean{i} ON book{i}.p = mean{i}.p AND book{i}.e = mean{i}.e)")
    return ",\n".join(steps) + f"""
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM (SELECT vec_id, string_agg(printf('%02x', CAST(best % 16 AS BIGINT)), '' ORDER BY p) AS code, CAST(sum(best // 16) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id)
  JOIN (SELECT vec_id AS of, label FROM kept) ON vec_id = of,
  (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
"""
