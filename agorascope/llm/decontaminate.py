"""Benchmark decontamination: item-sized windows by SimHash, multi-index Hamming blocks, exact weighted-shingle check.

Words are runs of letters and digits (and non-ASCII bytes), A-Z lower-cased; features are five-word shingles, weighted by
one over the number of items that hold them, in the whole benchmark; items of equal shingles count once.

A window that is similar enough shares so much of an item's weight that it holds one at least of the item's heaviest
shingles, those that make up more than 1 - threshold of its weight: its seeds. So a text meets only the items of seeds it
holds, and openings that many items share, of little weight each, are no seeds. Every window of an item's length around
such a seed gets a SimHash of BITS bits of its distinct shingles, each a vector of normal numbers times the root of its
weight: a bit differs with probability angle / pi, whatever the weights. At similarity 0.8 the cosine is 8/9 at least, so
29.1 of 192 bits are expected to differ, and over RADIUS do in about one case of 10^5. The bits are three blocks of 64:
two fingerprints within RADIUS differ by at most NEAR bits in one block, so the blocks miss none; of unlike fingerprints
one in some thousands gets through. Candidates within the radius are decided by weighted Jaccard similarity.

Items of fewer than five words are one shingle, their whole sequence: they match texts equal to them. Items or texts
without words match nothing; null ids are carried; items of one id are one item, found at its best window; of equally good
windows the first counts; repeated rows are matched alike; other columns are not used; empty tables give no rows. Items
are taken in passes of about ITEMS rows and ITEM_BYTES of text, those of one id together, so what a task holds of them is
bounded; beside them it holds the weights of shingles that several items share, which are the same in every pass, as are
the results. One pass is one lazy plan. Of several each is run and written before the next is made, and its broadcast is let go,
so driver and executors hold one at a time, however many there are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.staging import Stage
from agorascope.llm.textkit import NO_WORD, shingle_rows, strings

K = 5
BITS = 192
RADIUS = 51
#: Bits that may differ in a block: within RADIUS, one block of three is within its own.
NEAR = np.array([16, 16, 17])
ITEMS, ITEM_BYTES = 200_000, 32 << 20
#: Positions in a row whose windows are summed at once, and items compared with them at once.
SPAN, SIDE = 4096, 256


def _normals() -> np.ndarray:
    """Normal numbers per byte and its value, centred so that unlike shingles share nothing; whole, so sums are exact."""
    found = np.random.Generator(np.random.PCG64(20240608)).normal(size=(8, 256, BITS))
    return np.rint((found - found.mean(1, keepdims=True)) * 2**14).astype(np.int64)


_NORMALS = _normals()


def _rays(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The vector of each shingle, by the root of its weight."""
    pieces = values.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = _NORMALS[0][pieces[:, 0]]
    for b in range(1, 8):
        out += _NORMALS[b][pieces[:, b]]
    return out * np.rint(np.sqrt(weights) * 2**14).astype(np.int64)[:, None]


def _window_sums(values: np.ndarray, weights: np.ndarray, m: int) -> np.ndarray:
    """The sum over the distinct shingles of each window of m, from its first position on."""
    rays, n = _rays(values, weights), len(values)
    order = np.argsort(values, kind="stable")
    same = np.flatnonzero(values[order][1:] == values[order][:-1])
    before, after = np.full(n, -1), np.full(n, n)
    before[order[same + 1]], after[order[same]] = order[same], order[same + 1]
    gone, come = np.arange(n - m), np.arange(m, n)
    change = rays[come] * (before[come] <= gone)[:, None] - rays[gone] * (after[gone] >= come)[:, None]
    return np.cumsum(np.vstack((rays[:m][before[:m] < 0].sum(0)[None], change)), 0)


def _prints(sums: np.ndarray) -> np.ndarray:
    """Rows of three 64-bit blocks."""
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8")


class Items:
    """One pass of items: shingle weights, seeds with their items, and fingerprints.

    shared: sorted shingles of several items, and how many hold each; counted over the given items if there are none."""

    def __init__(self, ids: list, texts: list[str], shared: tuple[np.ndarray, np.ndarray] | None = None, threshold: float = 0.8):
        own = [(i, v) for i, (_, v) in zip(ids, shingle_rows(pa.array(texts, pa.large_string()), K, True, NO_WORD), strict=True) if len(v)]
        sets = [np.unique(v) for _, v in own]
        if shared is None:
            kinds = {u.tobytes(): u for u in sets}
            shared = np.unique(np.concatenate(list(kinds.values())) if kinds else np.zeros(0, np.uint64), return_counts=True)
        self.shared, self.weight, self.threshold = shared[0], 1.0 / shared[1], threshold
        self.ids, self.length = [i for i, _ in own], np.array([len(v) for _, v in own], np.int64)
        self.flat, self.at = (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.cumsum([0, *map(len, sets)])
        self.marks = np.concatenate([_prints(_rays(u, self.weights(u)).sum(0)[None]) for u in sets]) if sets else np.zeros((0, 3), np.uint64)
        self.total = np.array([self.weights(u).sum() for u in sets])
        heavy = [self._heaviest(u) for u in sets]
        seeds, owners = np.concatenate(heavy) if heavy else self.flat, np.repeat(np.arange(len(sets)), [len(h) for h in heavy])
        order = np.argsort(seeds, kind="stable")
        self.owners, self.own_at = owners[order], np.cumsum([0, *map(len, heavy)])
        self.seeds, first = np.unique(seeds[order], return_index=True)
        self.first, self.own = np.append(first, len(seeds)), np.searchsorted(self.seeds, seeds)
        self.mask = np.uint64((1 << max(16, (8 * len(self.seeds)).bit_length())) - 1)
        self.filter = np.zeros(int(self.mask) + 1, bool)
        self.filter[(self.seeds & self.mask).astype(np.int64)] = True

    def _heaviest(self, values: np.ndarray) -> np.ndarray:
        """The fewest of an item's shingles without which a window cannot reach the threshold, the heaviest first."""
        weights = self.weights(values)
        order = np.argsort(-weights, kind="stable")
        enough = np.cumsum(weights[order]) > (1 - self.threshold) * weights.sum() * (1 + 1e-9)
        return values[order[: int(np.argmax(enough)) + 1 if enough.any() else len(order)]]

    def hits(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of seeds among values, and which seed each is."""
        maybe = np.flatnonzero(self.filter[(values & self.mask).astype(np.int64)])
        if not len(maybe) or not len(self.seeds):
            return maybe[:0], maybe[:0]
        at = np.minimum(np.searchsorted(self.seeds, values[maybe]), len(self.seeds) - 1)
        same = self.seeds[at] == values[maybe]
        return maybe[same], at[same]

    def weights(self, values: np.ndarray) -> np.ndarray:
        if not len(self.shared):
            return np.ones(len(values))
        at = np.minimum(np.searchsorted(self.shared, values), len(self.shared) - 1)
        return np.where(self.shared[at] == values, self.weight[at], 1.0)

    def similarity(self, a: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of a sorted set and an item's."""
        b = self.flat[self.at[item] : self.at[item + 1]]
        place = np.minimum(np.searchsorted(b, a), len(b) - 1)
        weights = self.weights(a)
        both = weights[b[place] == a].sum()
        return float(both / (weights.sum() + self.total[item] - both))

    def candidates(self, prints: np.ndarray, items: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Windows and items whose fingerprints are within the radius, found by their blocks."""
        for k in range(0, len(items), SIDE):
            side = items[k : k + SIDE]
            may = np.zeros((len(prints), len(side)), bool)
            for b in range(3):
                may |= np.bitwise_count(prints[:, b, None] ^ self.marks[side, b][None]) <= NEAR[b]
            w, i = np.nonzero(may)
            close = np.bitwise_count(prints[w] ^ self.marks[side[i]]).sum(1, dtype=np.int64) <= RADIUS
            yield w[close], side[i[close]]

    def matches(self, values: np.ndarray, first: bool = False) -> list[tuple]:
        """(item, similarity, first word, words) of the best window of each item that reaches the threshold; first: of one."""
        hits, kinds = self.hits(values)
        if not len(hits):
            return []
        best: dict[int, tuple] = {}
        seeds = np.unique(kinds)
        near = np.unique(np.concatenate([self.owners[self.first[k] : self.first[k + 1]] for k in seeds]))
        for n in np.unique(self.length[near]).tolist():
            m, items = min(n, len(values)), near[self.length[near] == n]
            asked = np.isin(seeds, self._seeds_of(items), assume_unique=True)
            begin = np.unique(np.clip(hits[np.isin(kinds, seeds[asked])][:, None] - np.arange(m), 0, len(values) - m))
            # Windows that do not overlap are summed apart, so memory is bounded by SPAN positions and one window.
            cuts = np.flatnonzero((np.diff(begin) > m) | (np.diff(begin // SPAN) > 0)) + 1
            for own in np.split(begin, cuts):
                lo, hi = own[0], own[-1] + m
                prints = _prints(_window_sums(values[lo:hi], self.weights(values[lo:hi]), m)[own - lo])
                for windows, found in self.candidates(prints, items):
                    for w, i in zip(windows.tolist(), found.tolist(), strict=True):
                        start, name = int(own[w]), self.ids[i]
                        s = self.similarity(np.unique(values[start : start + m]), i)
                        if s >= self.threshold and (s, -start) > best.get(name, (0.0, 0, 0))[:2]:
                            best[name] = (s, -start, m + K - 1)
                            if first:
                                return [(name, s, start, m + K - 1)]
        return [(i, s, -start, n) for i, (s, start, n) in best.items()]

    def _seeds_of(self, items: np.ndarray) -> np.ndarray:
        """Numbers of the seeds that some of the items own."""
        return np.unique(np.concatenate([self.own[self.own_at[i] : self.own_at[i + 1]] for i in items.tolist()]))


def shared_shingles(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that two distinct items at least hold, sorted, and the number of those items. Counted on the executors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, v in shingle_rows(strings(batch.column("t")), K, True, NO_WORD):
                if len(v):
                    u = np.unique(v)
                    kind = hashlib.md5(u.tobytes(), usedforsecurity=False).digest()
                    yield pa.RecordBatch.from_arrays([pa.array([kind], pa.binary()), pa.array([u.view(np.int64)], pa.list_(pa.int64()))], ["kind", "held"])

    kinds = rows.select("t").distinct().mapInArrow(run, "kind binary, held array<long>").groupBy("kind").agg(F.first("held").alias("held"))
    got = kinds.select(F.explode("held").alias("s")).groupBy("s").count().where("count > 1").toArrow()
    values, df = got["s"].to_numpy().view(np.uint64), got["count"].to_numpy()
    order = np.argsort(values)
    return values[order], df[order]


def item_passes(items: DataFrame, threshold: float = 0.8, id_col: str = "item_id", text_col: str = "text") -> Iterator[Items]:
    """The items in passes of about ITEMS rows and ITEM_BYTES of text, by a hash of their ids; weights are those of the
    whole table."""
    rows = items.select(F.col(id_col).cast("long").alias("i"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    total, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()
    if not total:
        return
    if total <= ITEMS and size <= ITEM_BYTES:
        got = rows.collect()
        yield Items([r["i"] for r in got], [r["t"] for r in got], None, threshold)
        return
    shared = shared_shingles(rows)
    cuts = max(-(-2 * total // ITEMS), -(-2 * size // ITEM_BYTES))
    parts = rows.withColumn("cut", F.expr(f"pmod(xxhash64(i), {cuts})"))
    for c in range(cuts):
        got = parts.where(F.col("cut") == c).collect()
        if got:
            yield Items([r["i"] for r in got], [r["t"] for r in got], shared, threshold)


FOUND = "doc_id long, item_id long, similarity double, start_word long, n_words long"


def _by_pass(rows: DataFrame, items: DataFrame, threshold: float, work: Callable, schema: str) -> DataFrame | None:
    """What work(batches, broadcast items) gives for every pass; None without items."""
    spark, passes = rows.sparkSession, item_passes(items, threshold)
    first, second = next(passes, None), next(passes, None)
    if first is None:
        return None

    def of(held) -> DataFrame:
        return rows.mapInArrow(lambda batches: work(batches, held), schema)

    if second is None:
        return of(spark.sparkContext.broadcast(first))
    stage, out = Stage(spark, "passes"), None
    passes = chain([first, second], passes)
    del first, second
    for n, own in enumerate(passes):
        held = spark.sparkContext.broadcast(own)
        found = stage.table(of(held), f"pass-{n}")
        held.destroy()
        out = found if out is None else out.unionByName(found)
    return out


def _matches(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in FOUND.split(", ")]
    for batch in batches:
        ids, found = batch.column("doc_id").to_pylist(), []
        for r, values in shingle_rows(strings(batch.column("text")), K, True, NO_WORD):
            found += [(ids[r], *m) for m in held.value.matches(values)]
        cols = list(zip(*found, strict=True)) if found else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "similarity" else pa.int64()) for n, c in zip(names, cols, strict=True)], names)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: each item that a text holds, at its best window. No shuffle."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = _by_pass(rows, items, threshold, _matches, FOUND)
    return docs.sparkSession.createDataFrame([], FOUND) if found is None else found


def clean_of(docs: DataFrame, items: DataFrame, threshold: float = 0.8, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text holds no item.

    No shuffle where items make one pass; of several each tells the digests of the texts that it hits, and rows of these go."""
    spark, passes = docs.sparkSession, item_passes(items, threshold)
    first, second = next(passes, None), next(passes, None)
    if first is None:
        return docs
    if second is None:
        held = spark.sparkContext.broadcast(first)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = [not held.value.matches(v, first=True) for _, v in shingle_rows(strings(batch.column(text_col)), K, True, NO_WORD)]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return docs.mapInArrow(clean, docs.schema)
    del first, second

    def hit(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([digests[r] for r, v in shingle_rows(strings(batch.column("text")), K, True, NO_WORD) if held.value.matches(v, first=True)], pa.string())], ["digest"])

    text = F.col(text_col).cast("string")
    rows = docs.select(text.alias("text"), F.sha2(text, 256).alias("digest"))
    gone = Stage(spark, "passes").table(_by_pass(rows, items, threshold, hit, "digest string").distinct(), "gone").toDF("digest_")
    kept = docs.select(F.struct("*").alias("row_"), F.sha2(text, 256).alias("digest_")).join(gone, "digest_", "left_anti")
    return kept.select("row_.*")
