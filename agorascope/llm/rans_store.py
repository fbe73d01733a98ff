"""Token ids as static range-ANS shards: shared frequency tables, independent interleaved blocks, checkpoints, checksums.

A shard holds up to SHARD ids of consecutive documents and one frequency table (exact counts of the shard, scaled to
2**SCALE). Its blocks of BLOCK ids are coded apart from each other, each by LANES interleaved 64-bit states with 32-bit
words. The shard's index is a checkpoint per block: its place among the words, its final states and a CRC-32 of its ids,
so any block decodes alone; all blocks of a shard are coded side by side. Shards are rows of a Parquet table, which Spark
commits atomically, so lost executors cost only their tasks.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorascope.llm.encoders import WordBpe, encoder
from agorascope.llm.staging import Stage
from agorascope.llm.textkit import slices, strings

MAGIC = b"RANS0001"
SCALE = 18
LANES = 32
BLOCK = 1 << 14
SHARD = 1 << 21
LOW = np.uint64(1 << 31)


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols that occur, and their frequencies scaled to 2**SCALE, one at least."""
    every = np.bincount(ids)
    symbols = np.flatnonzero(every)
    counts = every[symbols]
    if len(symbols) > 1 << SCALE:
        raise ValueError("more distinct ids than the scale holds")
    scaled = np.maximum(1, (counts.astype(np.float64) * (1 << SCALE) / len(ids)).astype(np.int64))
    excess = int(scaled.sum()) - (1 << SCALE)
    order = np.argsort(-counts, kind="stable")
    while excess:  # the rest is taken from, or given to, the most frequent
        take = np.minimum(scaled[order] - 1, np.maximum(1, scaled[order] * excess // (1 << SCALE))) if excess > 0 else np.where(np.arange(len(order)) == 0, excess, 0)
        if excess > 0:
            run = np.cumsum(take)
            take = np.where(run <= excess, take, np.maximum(0, take - (run - excess)))
        scaled[order] -= take
        excess -= int(take.sum())
    return symbols.astype(np.uint32), scaled.astype(np.uint32)


def _code(blocks: np.ndarray, freq: np.ndarray, cum: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of symbol indexes (a multiple of LANES long) -> states, words of all rows in turn, words per row."""
    rows, n = blocks.shape
    grid = blocks.reshape(rows, n // LANES, LANES)
    x = np.full((rows, LANES), LOW, np.uint64)
    spill = np.zeros(grid.shape, bool)
    words = np.zeros(grid.shape, np.uint32)
    for t in range(grid.shape[1] - 1, -1, -1):
        s = grid[:, t]
        f = freq[s]
        over = x >= f << np.uint64(63 - SCALE)
        spill[:, t], words[:, t] = over, x.astype(np.uint32)
        x = np.where(over, x >> np.uint64(32), x)
        q = x // f
        x = (q << np.uint64(SCALE)) + (x - q * f) + cum[s]
    return x, words[spill], spill.reshape(rows, -1).sum(1)


def _uncode(states: np.ndarray, words: np.ndarray, at: np.ndarray, n: int, freq: np.ndarray, cum: np.ndarray, slots: np.ndarray) -> np.ndarray:
    x, at = states.copy(), at.copy()
    out = np.empty((len(x), n // LANES, LANES), np.uint32)
    words = np.append(words, np.zeros(1, np.uint32))
    for t in range(n // LANES):
        slot = x & np.uint64((1 << SCALE) - 1)
        s = slots[slot.astype(np.int64)]
        out[:, t] = s
        x = freq[s] * (x >> np.uint64(SCALE)) + slot - cum[s]
        low = x < LOW
        rank = np.cumsum(low, 1)
        word = words[np.minimum(at[:, None] + rank - 1, len(words) - 1)]
        x = np.where(low, (x << np.uint64(32)) | word, x)
        at += rank[:, -1]
    return out.reshape(len(x), n)


def encode(ids: np.ndarray) -> bytes:
    """A shard: header, frequency table, block index, words. No ids give an empty shard."""
    if not len(ids):
        return MAGIC + struct.pack("<QII", 0, 0, 0)
    symbols, scaled = frequencies(ids)
    freq, cum = scaled.astype(np.uint64), (np.cumsum(scaled) - scaled).astype(np.uint64)
    place = np.zeros(int(symbols[-1]) + 1, np.int64)
    place[symbols] = np.arange(len(symbols))
    index = place[ids]
    full = len(ids) // BLOCK
    parts = [_code(index[: full * BLOCK].reshape(full, BLOCK), freq, cum)] if full else []
    if len(ids) % BLOCK:
        rest = index[full * BLOCK :]
        pad = np.full(-len(rest) % LANES, int(np.argmax(scaled)), np.int64)
        parts.append(_code(np.append(rest, pad)[None], freq, cum))
    states, words, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    crcs = np.array([zlib.crc32(np.ascontiguousarray(ids[a : a + BLOCK], "<u4").tobytes()) for a in range(0, len(ids), BLOCK)], "<u4")
    table = zlib.compress(np.diff(symbols, prepend=np.uint32(0)).astype("<u4").tobytes() + scaled.astype("<u4").tobytes(), 6)
    head = struct.pack("<QII", len(ids), len(symbols), len(table))
    return b"".join((MAGIC, head, table, counts.astype("<u4").tobytes(), crcs.tobytes(), states.astype("<u8").tobytes(), words.astype("<u4").tobytes()))


class Shard:
    """A shard's tables and index; ValueError if it is none. Blocks decode alone or side by side."""

    def __init__(self, body: bytes):
        if body[:8] != MAGIC:
            raise ValueError("not a shard of ids")
        self.n, distinct, size = struct.unpack_from("<QII", body, 8)
        self.blocks = -(-self.n // BLOCK)
        if not self.n:
            return
        at = 24
        table = np.frombuffer(zlib.decompress(body[at : at + size]), "<u4")
        self.symbols, scaled = np.cumsum(table[:distinct], dtype=np.uint32), table[distinct:]
        at += size
        counts, self.crcs = np.frombuffer(body, "<u4", self.blocks, at).astype(np.int64), np.frombuffer(body, "<u4", self.blocks, at + 4 * self.blocks)
        at += 8 * self.blocks
        self.states = np.frombuffer(body, "<u8", self.blocks * LANES, at).reshape(self.blocks, LANES)
        self.words = np.frombuffer(body, "<u4", offset=at + 8 * self.blocks * LANES)
        self.freq, self.cum = scaled.astype(np.uint64), (np.cumsum(scaled, dtype=np.int64) - scaled).astype(np.uint64)
        self.slots = np.repeat(np.arange(distinct), scaled)
        self.begin = np.cumsum(counts) - counts

    def ids(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """The ids of blocks first to last (not included; all, if none is given), from their checkpoints alone; ValueError
        if one is damaged."""
        last = self.blocks if last is None else min(last, self.blocks)
        if first >= last:
            return np.zeros(0, np.uint32)
        end = min(last * BLOCK, self.n)
        full, out = end // BLOCK, np.empty(end - first * BLOCK, np.uint32)
        if full > first:
            out[: (full - first) * BLOCK] = self._blocks(first, full, BLOCK).reshape(-1)
        if end % BLOCK:
            rest = end % BLOCK
            out[(full - first) * BLOCK :] = self._blocks(full, full + 1, rest + -rest % LANES).reshape(-1)[:rest]
        for b in range(first, last):
            if zlib.crc32(out[(b - first) * BLOCK : (b - first + 1) * BLOCK].astype("<u4").tobytes()) != self.crcs[b]:
                raise ValueError(f"block {b}: checksum differs")
        return out

    def _blocks(self, first: int, last: int, n: int) -> np.ndarray:
        return self.symbols[_uncode(self.states[first:last], self.words, self.begin[first:last], n, self.freq, self.cum, self.slots)]


def decode(body: bytes) -> np.ndarray:
    """All ids of a shard; ValueError if it is damaged."""
    return Shard(body).ids()


SHARDS = "part int, seq int, n_ids long, doc_ids array<long>, lengths array<long>, shard binary"


def write_shards(docs: DataFrame, stage: Stage, path: str, end_id: int, kind: type = WordBpe, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes each text, appends end_id and writes shards in ascending id order (null ids first); returns their table.

    One shuffle, of the texts, by ranges of ids, and within an id by a hash of the text, so no id is one task; texts of one
    id come by that hash, then by themselves, and repeated rows beside each other. Null texts count as empty: their only id
    is end_id. A text longer than a shard fills a shard of its own. Other columns are not used; an empty table gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part, seq = encoder(kind, path), TaskContext.get().partitionId(), 0
        ids, held, names = [], 0, []

        def shard() -> pa.RecordBatch:
            every = np.concatenate(ids)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([len(every)], pa.int64()), pa.array([names], pa.list_(pa.int64())), pa.array([[len(x) for x in ids]], pa.list_(pa.int64())), pa.array([encode(every)], pa.binary())], ["part", "seq", "n_ids", "doc_ids", "lengths", "shard"])

        for batch in batches:
            text, every = strings(batch.column("text")), batch.column("doc_id").to_pylist()
            for a, z in slices(text):
                for name, got in zip(every[a:z], own.many(text.slice(a, z - a).to_pylist()), strict=True):
                    got = np.append(got, np.uint32(end_id))
                    if held and held + len(got) > SHARD:
                        yield shard()
                        ids, held, names, seq = [], 0, [], seq + 1
                    ids.append(got)
                    names.append(name)
                    held += len(got)
        if ids:
            yield shard()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("order_", F.xxhash64("text"))
    return stage.table(rows.repartitionByRange("doc_id", "order_").sortWithinPartitions("doc_id", "order_", "text").drop("order_").mapInArrow(run, SHARDS), "shards")


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of little-endian unsigned 32-bit ids) per
    document; no shards, no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = decode(batch.column("shard")[i].as_py()).astype("<u4")
                names, lengths = batch.column("doc_ids")[i].as_py(), np.array(batch.column("lengths")[i].as_py(), np.int64)
                ends = np.cumsum(lengths)
                step = 1000
                for a in range(0, len(names), step):
                    cut = slice(a, a + step)
                    n = len(names[cut])
                    values = [ids[e - m : e].tobytes() for e, m in zip(ends[cut], lengths[cut], strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array([batch.column(c)[i].as_py()] * n, pa.int32()) for c in ("part", "seq")] + [pa.array(names[cut], pa.int64()), pa.array(ends[cut] - lengths[cut]), pa.array(lengths[cut]), pa.array(values, pa.binary())], ["part", "seq", "doc_id", "place", "n_tokens", "ids"])

    # The running sum in two levels: over partitions, a row each, and over the shards of one.
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("own"))
    parts = parts.select("part", (F.sum("own").over(Window.orderBy("part")) - F.col("own")).alias("before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    begin = shards.select("part", "seq", within.alias("within")).join(F.broadcast(parts), "part").select("part", "seq", (F.col("before") + F.col("within")).alias("begin"))
    found = shards.mapInArrow(run, "part int, seq int, doc_id long, place long, n_tokens long, ids binary")
    found = found.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return found.join(begin, ["part", "seq"]).select("doc_id", (F.col("begin") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")
