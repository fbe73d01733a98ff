"""SimHash near duplicates by meet-in-the-middle ball hashing, exactly.

A text's fingerprint has a bit set where over half of its word shingles' XXH64 hashes have it. Two fingerprints link when they
differ in at most `radius` bits (an even number): then some value lies within half the radius of both. So every
fingerprint emits all variants within half the radius, variants meet in a shuffle, and equal ones give pairs, which are
deduplicated and verified by their distance.

Variants are dealt by a linear hash of their bits: hash(fingerprint ^ flips) = hash(fingerprint) ^ hash(flips). A bucket gets a
fingerprint once, whatever number of its variants fall in there, and makes just these anew, so a fingerprint travels in 8 bytes
per bucket instead of 16 per variant. The number of buckets grows with that of the fingerprints, so a bucket holds about VARIANTS
of them, and buckets are taken in passes of which none sends a fingerprint to more than COPIES buckets on average: at most nine
passes at any size. Fingerprints are distinct and each spreads over the buckets, so no text or group of copies is a hot key.

All fingerprints that share a variant are within the radius of each other, so a group of equal variants is told by its smallest
member and each other one: no pairs within a group. A bucket's pairs are deduplicated, verified by their distance, and come
out as its components: each fingerprint with the smallest that links join it to. So a bucket gives fewer rows than it has
fingerprints, and a large group of near copies about the same ones from every bucket. These rows make components over
distinct fingerprints, and documents join them by fingerprint.

Null, empty and blank texts have fingerprint zero and link like any other. A null id gets the component of its text, which is
the smallest id there that is not null, and null if there is none. Repeated rows are copies of each other; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.components import connected
from agorascope.llm.staging import Stage
from agorascope.llm.textkit import LOWER, slices, strings, utf8, words

#: Variants in a bucket, about; buckets that a fingerprint goes to in one pass, on average.
VARIANTS, COPIES = 1 << 22, 256
#: Bits that name an entry while a bucket's variants are sorted; a bucket with more entries is sorted another way.
PLACE = 24
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 16


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that over half of the hashes have; zero without any."""
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), COUNTED):
        count += np.unpackbits(hashes[at : at + COUNTED, None].view(np.uint8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view(np.uint64)[0])


def shingle_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, k: int, seed: int) -> np.ndarray:
    """XXH64 of every k words of one text, joined by a space; of all of them if they are fewer."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    # The words one space apart: a word's bytes move back by what the blanks before it have too many.
    heads = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    joined = np.full(int(heads[-1] + lengths[-1]), 0x20, np.uint8)
    inside = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    joined[np.repeat(heads, lengths) + inside] = LOWER[data[np.repeat(starts, lengths) + inside]]
    text, many = memoryview(joined.tobytes()), max(1, len(starts) - k + 1)
    stops = (heads + lengths)[-many:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a:z], seed) for a, z in zip(heads[:many].tolist(), stops.tolist(), strict=True)), np.uint64, many)


def _fingerprints(batches: Iterator[pa.RecordBatch], k: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = strings(batch.column("text"))
        for a, z in slices(text):
            data, at = utf8(text.slice(a, z - a))
            starts, ends, before = words(data, at)
            own = [fingerprint(shingle_hashes(data, starts[i:j], ends[i:j], k, seed)) for i, j in zip(before[:-1], before[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, z - a), pa.array(np.array(own, np.uint64).view(np.int64))], ["doc_id", "print"])


def flips(within: int) -> np.ndarray:
    """All 64-bit masks of at most `within` bits."""
    return np.array([sum(1 << b for b in own) for n in range(within + 1) for own in combinations(range(64), n)], np.uint64)


class Deal:
    """Deals variants to 2 ** bits buckets by a linear hash, and makes those of one bucket."""

    def __init__(self, radius: int, bits: int):
        self.masks = flips(radius // 2)
        self.rows = np.random.Generator(np.random.PCG64(11)).integers(1, 2**64, bits, np.uint64)
        own = self.hash(self.masks)
        order = np.argsort(own, kind="stable")
        #: Masks by their hash: the distinct hashes, and where the masks of each begin.
        self.masks = self.masks[order]
        self.kinds, self.begin, self.many = np.unique(own[order], return_index=True, return_counts=True)

    def hash(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for i, row in enumerate(self.rows):
            out |= (np.bitwise_count(x & row) & np.uint8(1)).astype(np.int64) << i
        return out

    def buckets(self, prints: np.ndarray) -> np.ndarray:
        """(print, kind): the buckets that hold variants of each fingerprint."""
        return self.hash(prints)[:, None] ^ self.kinds

    def variants(self, bucket: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The variants in a bucket, and which fingerprint each is of."""
        kind = np.searchsorted(self.kinds, self.hash(prints) ^ bucket)
        many = self.many[kind]
        of = np.repeat(np.arange(len(prints)), many)
        within = np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
        return prints[of] ^ self.masks[self.begin[kind][of] + within], of


def _emit(batches: Iterator[pa.RecordBatch], radius: int, bits: int, turn: int, turns: int) -> Iterator[pa.RecordBatch]:
    deal = Deal(radius, bits)
    step = max(1, (1 << 21) // len(deal.kinds))
    for batch in batches:
        every = batch.column("print").to_numpy().view(np.uint64)
        for at in range(0, len(every), step):
            prints = every[at : at + step]
            to = deal.buckets(prints)
            row, kind = np.nonzero(to % turns == turn) if turns > 1 else np.divmod(np.arange(to.size), to.shape[1])
            to = to[row, kind]
            order = np.argsort(to, kind="stable")
            to, own = to[order], prints[row[order]]
            cuts = np.flatnonzero(np.append(True, to[1:] != to[:-1])) if len(to) else np.zeros(0, np.int64)
            blocks = pa.BinaryArray.from_buffers(pa.binary(), len(cuts), [None, pa.py_buffer((np.append(cuts, len(to)) * 8).astype(np.int32)), pa.py_buffer(own)])
            yield pa.RecordBatch.from_arrays([pa.array(to[cuts], pa.int64()), blocks], ["bucket", "prints"])


def collisions(bucket: int, prints: np.ndarray, deal: Deal) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs (places in prints) that share a variant of the bucket: the first of each variant, and each other one."""
    variants, of = deal.variants(bucket, prints)
    if len(variants) < 1 << PLACE:
        # Sorted by a hash with the entry's place in the low bits: one sort of plain numbers, wrong only in a few too many.
        low = np.uint64((1 << PLACE) - 1)
        keys = (variants * np.uint64(0x9E3779B97F4A7C15)) & ~low | np.arange(len(variants), dtype=np.uint64)
        keys.sort()
        same = (keys[1:] ^ keys[:-1]) <= low
        near = np.append(same, False) | np.append(False, same)
        entries = (keys[near] & low).astype(np.int64)
    else:
        entries = np.argsort(variants, kind="stable")
    variants, own = variants[entries], of[entries]
    order = np.lexsort((own, variants))
    variants, own = variants[order], own[order]
    head = np.append(True, variants[1:] != variants[:-1])[: len(variants)]
    first = own[np.flatnonzero(head)][np.cumsum(head) - 1]
    pairs = np.unique(first[~head] * len(prints) + own[~head])
    return np.divmod(pairs, max(1, len(prints)))


def joined(bucket: int, prints: np.ndarray, deal: Deal, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The components that links of the bucket make: the smallest fingerprint of each, and each other one."""
    prints = np.unique(prints)
    a, b = collisions(bucket, prints, deal)
    close = np.bitwise_count(prints[a] ^ prints[b]) <= radius
    a, b, least = a[close], b[close], np.arange(len(prints))
    while (least[a] != least[b]).any():
        both = np.minimum(least[a], least[b])
        for side in (a, b):
            np.minimum.at(least, least[side], both)
        while (least[least] != least).any():
            least = least[least]
    others = np.flatnonzero(least != np.arange(len(prints)))
    return prints[least[others]], prints[others]


def _collide(batches: Iterator[pa.RecordBatch], radius: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Over blocks sorted by bucket: the components of each."""
    deal, bucket, held = Deal(radius, bits), None, []

    def rows() -> pa.RecordBatch:
        a, b = joined(bucket, np.frombuffer(b"".join(held), np.uint64), deal, radius)
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (a, b)], ["a", "b"])

    for batch in batches:
        for own, block in zip(batch.column("bucket").to_pylist(), batch.column("prints"), strict=True):
            if held and own != bucket:
                yield rows()
                held = []
            bucket = own
            held.append(block.as_py())
    if held:
        yield rows()


def linked(prints: DataFrame, stage: Stage, radius: int = 4) -> DataFrame:
    """prints(print), distinct -> (a, b): pairs that join all fingerprints which links join, and no others."""
    if radius % 2 or not 0 <= radius <= 8:
        raise ValueError("the radius is an even number up to 8")
    total = sum(math.comb(64, n) for n in range(radius // 2 + 1))
    bits = max(0, math.ceil(math.log2(max(1, prints.count() * total / VARIANTS))))
    turns = max(1, math.ceil(min(2**bits, total) / COPIES))
    found = []
    for turn in range(turns):
        dealt = prints.mapInArrow(partial(_emit, radius=radius, bits=bits, turn=turn, turns=turns), "bucket long, prints binary")
        dealt = dealt.repartition("bucket").sortWithinPartitions("bucket")
        found.append(stage.table(dealt.mapInArrow(partial(_collide, radius=radius, bits=bits), "a long, b long").distinct(), f"pairs-{turn}"))
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, radius: int = 4, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), class_id (smallest id with that fingerprint), component_id (smallest id reachable)."""
    stage = Stage(docs.sparkSession, "simhash")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = stage.table(docs.mapInArrow(partial(_fingerprints, k=k, seed=seed), "doc_id long, print long"), "rows")
    classes = stage.table(rows.groupBy("print").agg(F.min("doc_id").alias("class_id")), "classes")
    links = stage.table(linked(classes.select("print"), stage, radius), "links")
    stage.drop(*(f"pairs-{turn}" for turn in range(9)))
    groups = connected(links, stage, "groups").toDF("print", "group")
    own = classes.join(groups, "print", "left").withColumn("group", F.coalesce("group", "print"))
    own = stage.table(own, "grouped")
    least = own.groupBy("group").agg(F.min("class_id").alias("component_id"))
    labels = stage.table(own.join(least, "group").select("print", "class_id", "component_id"), "labels")
    return rows.join(labels, "print").select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "class_id", "component_id")
