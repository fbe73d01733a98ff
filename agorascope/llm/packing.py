"""Bounded-space online packing of token ids into windows.

Each partition keeps OPEN windows. Whole windows of a long document become sequences at once; what remains goes to the
open window it fits best. If none holds it, its head fills the fullest window, which is emitted without padding, and the
rest is placed again. At the end the partition's windows are merged into one, and a second, small step merges those of
all partitions; the last window of each of its tasks is cut into powers of two. So sequences carry no padding at all, and
memory is bounded by OPEN windows and one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.encoders import ByteBpe, encoder
from agorascope.llm.staging import Stage
from agorascope.llm.textkit import slices, strings

OPEN = 16
PIECES = "sequence_id long, offset long, doc_id long, start long, length long, doc_tokens long, ids binary, open boolean"
_FIELDS = pa.schema([(n, {"ids": pa.binary(), "open": pa.bool_()}.get(n, pa.int64())) for n in ("sequence_id", "offset", "doc_id", "start", "length", "doc_tokens", "ids", "open")])


class Packer:
    """Pieces are (doc_id, start, doc_tokens, ids). Rows of finished sequences gather in `rows`."""

    def __init__(self, size: int, windows: int, base: int):
        self.size, self.windows, self.next, self.rows = size, [[] for _ in range(windows)], base, []
        self.used = [0] * windows

    def emit(self, pieces: list, is_open: bool = False) -> None:
        at = 0
        for doc, start, total, ids in pieces:
            self.rows.append((self.next, at, doc, start, len(ids), total, ids.astype("<u4").tobytes(), is_open))
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray, start: int = 0, total: int | None = None) -> None:
        total = len(ids) if total is None else total
        at = 0
        while len(ids) - at >= self.size:
            self.emit([(doc, start + at, total, ids[at : at + self.size])])
            at += self.size
        if at < len(ids):
            self.place((doc, start + at, total, ids[at:]))

    def place(self, piece: tuple) -> None:
        doc, start, total, ids = piece
        room = [self.size - u for u in self.used]
        fits = [i for i, r in enumerate(room) if r >= len(ids)]
        if fits:
            at = min(fits, key=lambda i: (room[i], i))
        else:
            at = min(range(len(room)), key=lambda i: (room[i], i))
            if room[at]:
                self.windows[at].append((doc, start, total, ids[: room[at]]))
                doc, start, total, ids = doc, start + room[at], total, ids[room[at] :]
            self.emit(self.windows[at])
            self.windows[at], self.used[at] = [], 0
        self.windows[at].append((doc, start, total, ids))
        self.used[at] += len(ids)
        if self.used[at] == self.size:
            self.emit(self.windows[at])
            self.windows[at], self.used[at] = [], 0

    def merged(self) -> list:
        """Joins the open windows, fullest first; emits what gets full and returns the pieces of the last."""
        pieces = [p for i in sorted(range(len(self.windows)), key=lambda i: -self.used[i]) for p in self.windows[i]]
        self.windows, self.used = [[]], [0]
        for p in pieces:
            self.place(p)
        return self.windows[0]

    def halved(self, pieces: list) -> None:
        """Emits the pieces as sequences whose lengths are powers of two, the largest first."""
        left = sum(len(p[3]) for p in pieces)
        while left:
            room = most = 1 << (left.bit_length() - 1)
            head = []
            while room:
                doc, start, total, ids = pieces[0]
                head.append((doc, start, total, ids[:room]))
                pieces = [(doc, start + room, total, ids[room:])] * (len(ids) > room) + pieces[1:]
                room -= len(head[-1][3])
            self.emit(head)
            left -= most

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 8, _FIELDS, strict=True)], schema=_FIELDS)


def pack(docs: DataFrame, path: str, size: int = 1024, end_id: int = 0, kind: type = ByteBpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: sequence_id, offset (in it), doc_id, start (in the document), length, doc_tokens, ids (binary).

    Null or empty texts are the end id alone. Repeated rows and null ids are packed like any others."""
    if size & (size - 1):
        raise ValueError("size must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = encoder(kind, path), TaskContext.get().partitionId()
        packer = Packer(size, OPEN, part << 36)
        for batch in batches:
            text, every = strings(batch.column("text")), batch.column("doc_id").to_pylist()
            for a, z in slices(text, 1 << 20):
                for doc, ids in zip(every[a:z], own.many(text.slice(a, z - a).to_pylist()), strict=True):
                    packer.add(doc, np.append(ids, np.uint32(end_id)))
                yield packer.batch()
        packer.emit(packer.merged(), True)
        yield packer.batch()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(size, 1, (1 << 62) + (TaskContext.get().partitionId() << 36))
        for batch in batches:
            for doc, start, total, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens", "ids")), strict=True):
                packer.place((doc, start, total, np.frombuffer(ids, "<u4")))
            yield packer.batch()
        packer.halved(packer.windows[0])
        yield packer.batch()

    stage = Stage(docs.sparkSession, "packing")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    first = stage.table(rows.mapInArrow(run, PIECES), "pieces")
    rest = first.where("open").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset").mapInArrow(merge, PIECES)
    return first.where("not open").unionByName(rest).drop("open")
