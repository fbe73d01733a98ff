"""N-gram Jaccard join: links of word-shingle sets by size-banded tiles and hashed bitmaps, exactly.

Two texts link when den * |A & B| >= num * |A | B| over their distinct k-word shingles (A-Z lower-cased).
Stages, none of which drops a link between different sets:

1. A fixed-size count sketch of all shingles puts frequent ones last in one order for the whole corpus.
2. Each set gets a digest, a prefix under that order (linked sets share a prefix shingle) and a bitmap, whose
   width follows from its size band. Texts with equal sets fold into the one with the smallest id.
3. Per prefix shingle, sorted by size, each set is paired with the smallest and the one before it. Bitmaps bound the
   overlap from above, sorted arrays decide; links make components. Shingles are dealt by ranges of (shingle, size, id), so
   a frequent one is spread over tasks, whose ends are paired in a step of two rows per task.
4. Shingles that still hold several components are cut into size-banded tiles of bounded length; bitmaps are compared
   across components and compatible tiles, and give groups of sets that may link. Each group, once for all its shingles,
   is cut into such tiles again and decided by the sorted arrays.

So a group of near copies costs its length, not its square, and a frequent passage only bitmap tests.
Null ids give a class of their own id (null); null or blank texts have empty sets and link with nothing; extra columns
are ignored; repeated rows are copies of each other; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agorascope.llm.components import connected
from agorascope.llm.staging import Stage
from agorascope.llm.textkit import shingle_rows, strings

SKETCH = 1 << 20
BLOCK = 1 << 12
#: Shingles in a tile, all its sets together, but for the last set.
TILE = 1 << 16
#: Sets in a pair of tiles that is compared together with others, and how many sets and bytes of bitmaps are taken together.
SMALL, SMALL_ROWS, SMALL_BYTES = 64, 8192, 16 << 20
#: ids whose set is broadcast to pick texts; more are joined by a shuffle.
BROADCAST_IDS = 100_000


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(44)).astype(np.int64)


def width(n: int) -> int:
    """Bits of the bitmap for sets of n shingles: a power of two, at least n."""
    return max(64, 1 << max(0, int(n) - 1).bit_length())


def bitmap(hashes: np.ndarray) -> bytes:
    bits = np.zeros(width(len(hashes)), bool)
    bits[(hashes & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(words: np.ndarray, to: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) narrowed to `to` words; a bit is the hash modulo the width."""
    while words.shape[-1] > to:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


def overlap_bound(n_a, a: np.ndarray, n_b, b: np.ndarray):
    """The most elements that sets with these sizes and bitmaps can share: each bit of one that the other lacks costs one."""
    both = np.bitwise_count(a & b).sum(-1, dtype=np.int64)
    return np.minimum(n_a - np.bitwise_count(a).sum(-1, dtype=np.int64), n_b - np.bitwise_count(b).sum(-1, dtype=np.int64)) + both


def enough(inter, n_a, n_b, num: int, den: int):
    return den * inter >= num * (n_a + n_b - inter)


def _sketch(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(SKETCH, np.int64)
    for batch in batches:
        for _, values in shingle_rows(strings(batch.column("text")), k, True):
            np.add.at(counts, bucket(np.unique(values)), 1)
    blocks = [b for b in range(SKETCH // BLOCK) if counts[b * BLOCK : (b + 1) * BLOCK].any()]
    for i in range(0, len(blocks), 64):
        yield pa.RecordBatch.from_pydict({"block": pa.array(blocks[i : i + 64], pa.int32()), "counts": pa.array([counts[b * BLOCK : (b + 1) * BLOCK].astype(np.int32).tobytes() for b in blocks[i : i + 64]], pa.binary())})


def _sum_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, counts in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
            total.setdefault(block, np.zeros(BLOCK, np.int64))
            total[block] += np.frombuffer(counts.as_buffer(), np.int32)
    for block, counts in total.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "counts": pa.array([counts.tobytes()], pa.binary())})


def frequency_levels(docs: DataFrame, k: int) -> bytes:
    """A level for each of the sketch's buckets: 0 up to 4 times the mean count, then its logarithm. Fixed size."""
    rows = docs.mapInArrow(partial(_sketch, k=k), "block int, counts binary").repartition("block").mapInArrow(_sum_sketch, "block int, counts binary").collect()
    counts = np.zeros(SKETCH, np.int64)
    for r in rows:
        counts[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["counts"], np.int64)
    ratio = counts / max(1.0, counts.sum() / SKETCH, 16)
    return np.where(ratio > 4, np.log2(np.maximum(ratio, 1)).astype(np.int64), 0).astype(np.uint8).tobytes()


def _profile(batches: Iterator[pa.RecordBatch], k: int, num: int, den: int, levels) -> Iterator[pa.RecordBatch]:
    level = np.frombuffer(levels.value, np.uint8)
    for batch in batches:
        ids, rows = batch.column("doc_id").to_pylist(), []
        for r, values in shingle_rows(strings(batch.column("text")), k, True):
            own = np.unique(values)
            n = len(own)
            digest = xxhash.xxh3_128_intdigest(own.tobytes())
            keep = n - -(-num * n // den) + 1 if n else 0
            high = level[bucket(own)]
            first = (own[np.lexsort((own, high))] if high.any() else own)[:keep]
            rows.append((ids[r], n, np.uint64(digest >> 64).view(np.int64), np.uint64(digest & (2**64 - 1)).view(np.int64), first.view(np.int64), bitmap(own)))
            if len(rows) >= 2000:
                yield _profile_batch(rows)
                rows = []
        yield _profile_batch(rows)


def _profile_batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    lengths = np.cumsum([0, *map(len, cols[4])], dtype=np.int32)
    prefix = pa.ListArray.from_arrays(lengths, np.concatenate(cols[4]) if rows else np.zeros(0, np.int64))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), prefix, pa.array(cols[5], pa.binary())], ["doc_id", "n", "d1", "d2", "prefix", "sig"])


RUNS = "key long, doc_id long, n long, pivot long, prev long, edge int, part int"


def _runs(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Over postings sorted by key, size and id: those that may link within their key, with the pair of each to the
    first of its run that is large enough for it, and to the one before. Keeps one row of the run between batches.
    The first and last row (edge 1 and 2) meet those of the neighbouring partitions."""
    last, pivot, alone, part = None, None, True, TaskContext.get().partitionId()
    for batch in batches:
        key, doc, n = (batch.column(c).to_numpy() for c in ("key", "doc_id", "n"))
        if not len(key):
            continue
        if last is None:
            yield _run_rows([key[:1], doc[:1], n[:1], doc[:1], doc[:1]], 1, part)
        head = np.append(True, key[1:] != key[:-1])
        carried = last is not None and key[0] == last[0]
        head[0] = not carried
        prev, prev_n = np.append(last[1] if carried else doc[0], doc[:-1]), np.append(last[2] if carried else n[0], n[:-1])
        # The pivot moves on where sizes leave its band: a run is cut into size bands.
        piv, piv_n = np.empty_like(doc), np.empty_like(n)
        edges = np.append(np.flatnonzero(head), len(key))
        if carried:
            edges = np.append(0, edges)
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            p = pivot if a == 0 and carried else (doc[a], n[a])
            while a < z:
                end = a + int(np.searchsorted(n[a:z], den * p[1] // num, "right"))
                piv[a:end], piv_n[a:end] = p
                a = end
                if a < z:
                    p = (doc[a], n[a])
            pivot = p
        # Only rows whose size allows a link to a neighbour of their run matter: sizes are sorted, so no other can.
        near = ~head & (num * n <= den * prev_n)
        shared = near | np.append(near[1:], False)
        out = [key, doc, n, piv, np.where(near, prev, doc)]
        if near[0] and carried and alone:  # the row before this batch has company now
            out = [np.append(v, x) for v, x in zip(last[:3] + (last[1], last[1]), out, strict=True)]
            shared = np.append(True, shared)
        alone = not shared[-1]
        last = (key[-1], doc[-1], n[-1])
        yield _run_rows([x[shared] for x in out], 0, part)
    if last is not None:
        yield _run_rows([np.array([v]) for v in (*last, last[1], last[1])], 2, part)


def _run_rows(cols: list[np.ndarray], edge: int, part: int) -> pa.RecordBatch:
    more = [np.full(len(cols[0]), v, np.int32) for v in (edge, part)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in [*cols, *more]], [c.split()[0] for c in RUNS.split(", ")])


def _met(runs: DataFrame, num: int, den: int) -> DataFrame:
    """The rows on either side of a border between partitions that may link to each other; two rows per partition come in."""
    order = Window.partitionBy("key").orderBy("part", "edge")
    before = lambda c: F.lag(c).over(order).alias(f"{c}_")
    rows = runs.where("edge > 0").select("key", "doc_id", "n", "part", *[before(c) for c in ("doc_id", "n", "part")])
    rows = rows.where(f"part_ < part and {num} * n <= {den} * n_")
    row = lambda d, n: F.struct("key", F.col(d).alias("doc_id"), F.col(n).alias("n"), F.col("doc_id_").alias("pivot"), F.col("doc_id_").alias("prev"))
    return rows.select(F.explode(F.array(row("doc_id", "n"), row("doc_id_", "n_"))).alias("r")).select("r.*")


def _bitmap_pairs(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
        keep = np.zeros(len(n_a), bool)
        for i, (a, b) in enumerate(zip(batch.column("sig_a"), batch.column("sig_b"), strict=True)):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            to = min(len(a), len(b))
            keep[i] = enough(overlap_bound(n_a[i], folded(a, to), n_b[i], folded(b, to)), n_a[i], n_b[i], num, den)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _arrays(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, out = batch.column("doc_id").to_pylist(), []
        for r, values in shingle_rows(strings(batch.column("text")), k, True):
            out.append((ids[r], np.unique(values).tobytes()))
            if len(out) >= 500:
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array([x[0] for x in out], pa.int64()), "items": pa.array([x[1] for x in out], pa.binary())})
                out = []
        yield pa.RecordBatch.from_pydict({"doc_id": pa.array([x[0] for x in out], pa.int64()), "items": pa.array([x[1] for x in out], pa.binary())})


def _decide(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (a, b) in enumerate(zip(batch.column("items_a"), batch.column("items_b"), strict=True)):
            a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
            both = np.concatenate((a, b))
            both.sort(kind="stable")
            keep[i] = enough(int((both[1:] == both[:-1]).sum()), len(a), len(b), num, den)
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _views(column: pa.Array) -> list[np.ndarray]:
    """Binary values as 64-bit words, without copies."""
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return [data[a:z].view(np.uint64) for a, z in zip(at[:-1], at[1:], strict=True)]


def _tiles(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by a tile's columns: the rows of each tile together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(c).to_numpy() for c in by]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], 0)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            tile = tuple(c[a] for c in cols)
            if held and tile != last:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]
                held = []
            held.append(batch.slice(a, z - a))
            last = tile
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0] if len(held) > 1 else held[0]


class _Forest:
    """Disjoint sets of rows."""

    def __init__(self, labels: np.ndarray):
        """Rows of equal labels start in one set."""
        _, first, back = np.unique(labels, return_index=True, return_inverse=True)
        self.root = first[back]

    def others(self, row: int, rows: np.ndarray) -> np.ndarray:
        """Those of the rows that are in another set."""
        return rows[self.root[rows] != self.root[row]]

    def join(self, row: int, rows: np.ndarray) -> None:
        old = np.unique(self.root[np.append(rows, row)])
        self.root[np.isin(self.root, old)] = old[0]


def _sides(tile: pa.RecordBatch, num: int, den: int) -> Iterator[tuple[int, Callable[[_Forest], np.ndarray]]]:
    """Each row of the left side, and what gives the rows right of it, in other sets, whose size allows a link."""
    side, n = tile.column("side").to_numpy(), tile.column("n").to_numpy()
    same = tile.column("ti")[0].as_py() == tile.column("tj")[0].as_py()
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    for i in left.tolist():
        rows = right[right > i] if same else right
        rows = rows[num * np.maximum(n[rows], n[i]) <= den * np.minimum(n[rows], n[i])]
        yield i, lambda forest, i=i, rows=rows: forest.others(i, rows)


def _small_groups(held: list[pa.RecordBatch], num: int, den: int) -> list[tuple]:
    """What _tile_groups gives for pairs of tiles of SMALL sets at most, all of them at once and all their pairs compared."""
    doc, n, comp, side = (np.concatenate([t.column(c).to_numpy() for t in held]) for c in ("doc_id", "n", "comp", "side"))
    lengths = np.array([t.num_rows for t in held])
    starts, own = np.cumsum(lengths) - lengths, np.repeat(np.arange(len(held)), lengths)
    crossed = np.array([t.column("ti")[0].as_py() != t.column("tj")[0].as_py() for t in held])
    pairs = []
    for length in np.unique(lengths).tolist():
        i, j = np.triu_indices(length, 1)
        at = starts[lengths == length][:, None]
        pairs.append(((at + i).ravel(), (at + j).ravel()))
    i, j = (np.concatenate(x) for x in zip(*pairs, strict=True))
    some = (comp[i] != comp[j]) & (num * np.maximum(n[i], n[j]) <= den * np.minimum(n[i], n[j])) & (~crossed[own[i]] | (side[i] != side[j]))
    i, j = i[some], j[some]
    if not len(i):
        return []
    sigs = [x for t in held for x in _views(t.column("sig"))]
    size = np.array([len(x) for x in sigs])
    widths, passed = np.minimum(size[i], size[j]), np.zeros(len(i), bool)
    for to in np.unique(widths).tolist():
        of = np.flatnonzero(widths == to)
        rows, back = np.unique(np.concatenate([i[of], j[of]]), return_inverse=True)
        words = np.empty((len(rows), to), np.uint64)
        for k in np.unique(size[rows]).tolist():
            alike = np.flatnonzero(size[rows] == k)
            words[alike] = folded(np.vstack([sigs[r] for r in rows[alike].tolist()]), to)
        lost = n[rows] - np.bitwise_count(words).sum(-1, dtype=np.int64)
        left, right = back[: len(of)], back[len(of) :]
        step = max(1, (1 << 16) // to)
        both = np.concatenate([np.bitwise_count(words[left[a : a + step]] & words[right[a : a + step]]).sum(-1, dtype=np.int64) for a in range(0, len(of), step)])
        passed[of] = enough(np.minimum(lost[left], lost[right]) + both, n[i[of]], n[j[of]], num, den)
    i, j = i[passed], j[passed]
    # The first row of a tile with a component stands for it.
    _, first, back = np.unique(np.stack([own, comp]), axis=1, return_index=True, return_inverse=True)
    before = first[back.ravel()]
    root = np.arange(len(doc))
    while True:
        low = np.minimum(root[before[i]], root[before[j]])
        moved = root.copy()
        np.minimum.at(moved, before[i], low)
        np.minimum.at(moved, before[j], low)
        moved = moved[moved]
        if (moved == root).all():
            break
        root = moved
    root = root[before]
    joined = np.flatnonzero(np.isin(root, root[root != before]) & (root != np.arange(len(doc))))
    return list(zip(doc[root[joined]].tolist(), doc[joined].tolist(), strict=True))


def _tile_groups(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """For each pair of tiles: what sizes and bitmaps allow to link across components, as a tree per group of sets.

    Pairs that the tree joins already are not compared again, and no more rows come out than sets go in. Pairs of tiles of few
    sets are taken together, SMALL_ROWS sets and SMALL_BYTES of bitmaps at a time."""
    out: list[tuple] = []
    held: list[pa.RecordBatch] = []
    rows_held = bytes_held = 0
    for tile in _tiles(batches, ["key", "ti", "tj"]):
        doc, n, comp = (tile.column(c).to_numpy() for c in ("doc_id", "n", "comp"))
        if comp.min() == comp.max():
            continue
        if len(doc) <= SMALL:
            held.append(tile)
            rows_held, bytes_held = rows_held + len(doc), bytes_held + int(n.sum()) // 4
            if rows_held >= SMALL_ROWS or bytes_held >= SMALL_BYTES:
                out += _small_groups(held, num, den)
                held, rows_held, bytes_held = [], 0, 0
            if len(out) >= 20_000:
                yield _pair_rows(out)
                out = []
            continue
        forest, sigs = _Forest(comp), None
        before = forest.root.copy()
        for i, others in _sides(tile, num, den):
            rows = others(forest)
            if not len(rows):
                continue
            if sigs is None:
                sigs = _views(tile.column("sig"))
                size = np.array([len(x) for x in sigs])
                wide: dict[int, np.ndarray] = {}
                place: dict[int, np.ndarray] = {}
            for to in np.unique(np.minimum(size[rows], size[i])).tolist():
                if to not in wide:
                    own = np.flatnonzero((size == to) | (size == 2 * to))
                    wide[to], place[to] = np.vstack([folded(sigs[j], to) for j in own.tolist()]), np.full(len(size), -1)
                    place[to][own] = np.arange(len(own))
                some = rows[np.minimum(size[rows], size[i]) == to]
                some = some[enough(overlap_bound(n[i], folded(sigs[i], to), n[some], wide[to][place[to][some]]), n[i], n[some], num, den)]
                if len(some):
                    forest.join(i, some)
        for root in np.unique(forest.root[forest.root != before]).tolist():
            own = np.flatnonzero(forest.root == root)
            out += [(int(doc[own[0]]), int(doc[j])) for j in own[1:].tolist()]
        if len(out) >= 20_000:
            yield _pair_rows(out)
            out = []
    if held:
        out += _small_groups(held, num, den)
    yield _pair_rows(out)


def _pair_rows(rows: list) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [[]] * 2
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["a", "b"])


def _tile_links(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Decides the pairs of two tiles against the sets' arrays. Links between sets that are joined already are left out:
    they join nothing more."""
    for tile in _tiles(batches, ["key", "ti", "tj"]):
        doc, n, comp = (tile.column(c).to_numpy() for c in ("doc_id", "n", "comp"))
        if comp.min() == comp.max():
            continue
        forest, found = _Forest(comp), []
        every, dense = np.unique(np.concatenate(_views(tile.column("items"))), return_inverse=True)
        ends = np.cumsum(n)
        mark = np.zeros(len(every), np.int64)
        for i, others in _sides(tile, num, den):
            rows = others(forest)
            if not len(rows):
                continue
            own = dense[ends[i] - n[i] : ends[i]]
            mark[own] = 1
            for at in range(0, len(rows), 64):
                some = rows[at : at + 64]
                some = forest.others(i, some)
                if not len(some):
                    continue
                inter = np.add.reduceat(mark[np.concatenate([dense[ends[v] - n[v] : ends[v]] for v in some.tolist()])], np.append(0, np.cumsum(n[some][:-1])))
                some = some[enough(inter, n[i], n[some], num, den)]
                if len(some):
                    _, first = np.unique(forest.root[some], return_index=True)
                    found += [(int(min(doc[i], doc[v])), int(max(doc[i], doc[v]))) for v in some[first].tolist()]
                    forest.join(i, some)
            mark[own] = 0
        yield _pair_rows(found)


def _sets(pairs: DataFrame, docs: DataFrame, stage: Stage, name: str, k: int) -> DataFrame:
    """doc_id and sorted array of every set that the pairs name."""
    ids = stage.table(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), f"{name}-ids")
    few = ids.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(ids) if few else ids.hint("shuffle_hash"), "doc_id", "left_semi")
    return stage.table(texts.mapInArrow(partial(_arrays, k=k), "doc_id long, items binary"), f"{name}-items")


def _decided(pairs: DataFrame, docs: DataFrame, stage: Stage, name: str, k: int, num: int, den: int) -> DataFrame:
    """Those of the pairs whose sorted arrays meet the threshold."""
    items = _sets(pairs, docs, stage, name, k)
    met = pairs.join(items.select(F.col("doc_id").alias("b"), F.col("items").alias("items_b")), "b").join(items.select(F.col("doc_id").alias("a"), F.col("items").alias("items_a")), "a")
    return met.mapInArrow(partial(_decide, num=num, den=den), "a long, b long")


def _in_tiles(rows: DataFrame, stage: Stage, name: str, num: int, den: int) -> DataFrame:
    """rows(key, doc_id, n, comp) -> (key, ti, tj, side, doc_id, n, comp): each key's sets, sorted by size, are cut into
    tiles of TILE shingles, and every two tiles whose sizes allow a link are set side by side.

    The running sum has two levels, ranges of a key and rows of a range, so no key is one task."""
    ranges = stage.table(rows.repartitionByRange("key", "n", "doc_id").withColumn("part", F.spark_partition_id()), f"{name}-ranges")
    sums = ranges.groupBy("key", "part").agg(F.sum("n").alias("own")).withColumn("before", F.sum("own").over(Window.partitionBy("key").orderBy("part")) - F.col("own")).drop("own")
    within = F.sum("n").over(Window.partitionBy("key", "part").orderBy("n", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    tile = F.expr(f"cast((before + within) div {TILE} as int)")
    rows = stage.table(ranges.join(sums, ["key", "part"]).withColumn("within", within).withColumn("tile", tile).drop("part", "before", "within"), name)
    stage.drop(f"{name}-ranges")
    tiles = rows.groupBy("key", "tile").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    i, j = tiles.toDF("key", "ti", "lo_i", "hi_i"), tiles.toDF("key", "tj", "lo_j", "hi_j")
    both = i.join(j, "key").where(f"ti <= tj and {num} * lo_j <= {den} * hi_i").select("key", "ti", "tj")
    sided = both.select("key", "ti", "tj", F.lit(0).alias("side"), F.col("ti").alias("tile")).unionByName(both.where("ti < tj").select("key", "ti", "tj", F.lit(1).alias("side"), F.col("tj").alias("tile")))
    return sided.join(rows, ["key", "tile"]).drop("tile")


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition("key", "ti", "tj").sortWithinPartitions("key", "ti", "tj", "side", "n", "doc_id")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, class_id (smallest id with an equal set), component_id (smallest id reachable by links)."""
    spark: SparkSession = docs.sparkSession
    stage = Stage(spark, "jaccard")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    levels = spark.sparkContext.broadcast(frequency_levels(docs, k))
    profile = stage.table(docs.mapInArrow(partial(_profile, k=k, num=num, den=den, levels=levels), "doc_id long, n long, d1 long, d2 long, prefix array<long>, sig binary"), "profile")
    classes = profile.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    classes = stage.table(classes, "classes")
    members = lambda rows: rows.select("doc_id", "n", "d1", "d2").join(classes.where("copies > 1").drop("copies"), ["d1", "d2"], "left").select("doc_id", "n", F.coalesce("class_id", "doc_id").alias("class_id"))
    copies = stage.table(members(profile).where("class_id <> doc_id").select("doc_id"), "copies")
    reps = profile.where("n > 0 and doc_id is not null").join(copies, "doc_id", "left_anti")
    postings = reps.select(F.explode("prefix").alias("key"), "doc_id", "n")
    postings = postings.repartitionByRange("key", "n", "doc_id").sortWithinPartitions("key", "n", "doc_id")
    runs = stage.table(postings.mapInArrow(partial(_runs, num=num, den=den), RUNS), "runs")
    met = stage.table(_met(runs, num, den), "met")
    shared = runs.where("edge = 0").drop("edge", "part").unionByName(met)
    slim = stage.table(profile.drop("prefix"), "slim")
    stage.drop("profile")

    sigs = slim.select("doc_id", "n", "sig")
    near = shared.select(F.explode(F.array("pivot", "prev")).alias("x"), "doc_id").where("x <> doc_id").select(F.least("x", "doc_id").alias("a"), F.greatest("x", "doc_id").alias("b")).distinct()
    near = near.join(sigs.toDF("a", "n_a", "sig_a"), "a").join(sigs.toDF("b", "n_b", "sig_b"), "b").where(num * F.greatest("n_a", "n_b") <= den * F.least("n_a", "n_b"))
    near = stage.table(near.mapInArrow(partial(_bitmap_pairs, num=num, den=den), "a long, b long"), "near")
    links = stage.table(_decided(near, docs, stage, "near", k, num, den), "near-links")
    comps = connected(links, stage, "round1")

    # Keys that still hold several components, cut into size-banded tiles.
    left = shared.select("key", "doc_id", "n").join(comps.toDF("doc_id", "comp"), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))
    mixed = left.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    rows = left.join(mixed.select("key"), "key", "left_semi")
    work = _in_tiles(rows, stage, "mixed", num, den).join(sigs.select("doc_id", "sig"), "doc_id").select("key", "ti", "tj", "side", "doc_id", "n", "comp", "sig")
    trees = stage.table(_by_tile(work).mapInArrow(partial(_tile_groups, num=num, den=den), "a long, b long").distinct(), "trees")
    if not trees.isEmpty():
        # Groups that bitmaps leave undecided are decided once each, whatever number of keys they share.
        groups = connected(trees, stage, "groups").toDF("doc_id", "key")
        own = groups.join(sigs.select("doc_id", "n"), "doc_id").join(comps.toDF("doc_id", "comp"), "doc_id", "left").select("key", "doc_id", "n", F.coalesce("comp", "doc_id").alias("comp"))
        items = _sets(trees, docs, stage, "tile", k)
        work = _in_tiles(own, stage, "grouped", num, den).join(items, "doc_id").select("key", "ti", "tj", "side", "doc_id", "n", "comp", "items")
        links = stage.table(links.unionByName(_by_tile(work).mapInArrow(partial(_tile_links, num=num, den=den), "a long, b long")), "links")
        comps = connected(links, stage, "round2")
    stage.drop("copies", "runs", "met", "near", "near-ids", "near-items", "near-links", "mixed", "trees", "tile-ids", "tile-items", "grouped", "links")
    labels = comps.toDF("class_id", "component")
    return members(slim).join(labels, "class_id", "left").select("doc_id", F.col("n").alias("n_shingles"), "class_id", F.coalesce("component", "class_id").alias("component_id"))
