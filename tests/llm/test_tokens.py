"""Token counts, the token store and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from agorascope.llm import fst_count, packing, rans_store
from agorascope.llm.encoders import ByteBpe, WordBpe
from agorascope.llm.queries import tokenizer
from agorascope.llm.staging import Stage

BYTE, WORD = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")


def noise(n: int = 4000) -> list[str]:
    r = random.Random(3)
    parts = ["'s", "'re", "'ll", "'v", "'l", " ", "  ", "\n", "\t", "\r", "a", "b", "ing", "The", "1", "23", "!", "?!", "'", "''", "é", "ü", "İ", "中", "\U0001f389", "<|endoftext|>", "r", "e", "l", "v", "aaaa", "....", "٣", "ǅ", "ª", "\x85", "–", "é"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)] + ["", "a" * 3000, "=" * 3000, " " * 500 + "x"]


def every_character() -> list[str]:
    return [f"{chr(c)}x{chr(c)}1{chr(c)} {chr(c)}'s" for c in range(32, 0x2100)]


def test_machine_counts_as_library(documents):
    texts = noise() + every_character() + [r.text or "" for r in documents.collect()]
    want = [len(e.ids) for e in Tokenizer.from_file(BYTE).encode_batch_fast(texts, add_special_tokens=False)]
    assert fst_count.Machine(BYTE).count(pa.array(texts, pa.large_string())).tolist() == want


def test_machine_restarts(monkeypatch):
    monkeypatch.setattr(fst_count, "MOST_STATES", 50)
    texts = noise(300)
    machine = fst_count.Machine(BYTE)
    want = [len(e.ids) for e in Tokenizer.from_file(BYTE).encode_batch_fast(texts, add_special_tokens=False)]
    assert [machine.count(pa.array([t], pa.large_string()))[0] for t in texts] == want


def test_chunk_scan():
    splitter = fst_count.Splitter()
    cls = np.random.default_rng(0).integers(0, fst_count.CLASSES, 3 * fst_count.CHUNK + 17).astype(np.uint8)
    state, want = fst_count.START, []
    for c in cls.tolist():
        want.append(state)
        state = fst_count._next(state, c)
    assert splitter.states(cls).tolist() == want


@pytest.mark.parametrize(("kind", "path"), [(ByteBpe, BYTE), (WordBpe, WORD)])
def test_encoders_are_the_library(kind, path):
    texts = noise() + every_character()
    want = [e.ids for e in Tokenizer.from_file(path).encode_batch_fast(texts, add_special_tokens=False)]
    assert [x.tolist() for x in kind(path).many(texts)] == want
    small = kind(path, 5) if kind is WordBpe else kind(path)
    assert [x.tolist() for x in small.many(texts[:500])] == want[:500]


def test_count_edge(edge, nothing):
    slow = Tokenizer.from_file(BYTE)
    for r in fst_count.count_tokens(edge, BYTE).join(edge.select("doc_id", "text").distinct(), "doc_id").collect():
        n = len(slow.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 512)
    assert fst_count.count_tokens(edge, BYTE).count() == edge.count() and fst_count.count_tokens(nothing, BYTE).count() == 0


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 16384, 16385, 50_000])
def test_shard_round_trip(n):
    ids = (np.random.default_rng(n).zipf(1.3, n) % 49408).astype(np.uint32)
    assert (rans_store.decode(rans_store.encode(ids)) == ids).all()


def test_shard_blocks():
    """Any block decodes alone, and a damaged one harms no other."""
    ids = (np.random.default_rng(3).zipf(1.3, 70_000) % 49408).astype(np.uint32)
    body = bytearray(rans_store.encode(ids))
    shard = rans_store.Shard(bytes(body))
    for b in range(shard.blocks):
        assert (shard.ids(b, b + 1) == ids[b * rans_store.BLOCK : (b + 1) * rans_store.BLOCK]).all()
    assert (shard.ids(1, 3) == ids[rans_store.BLOCK : 3 * rans_store.BLOCK]).all() and not len(shard.ids(9, 12))
    body[-2000] ^= 1
    harmed = rans_store.Shard(bytes(body))
    assert (harmed.ids(0, shard.blocks - 1) == ids[: (shard.blocks - 1) * rans_store.BLOCK]).all()
    with pytest.raises(ValueError, match="checksum"):
        harmed.ids(shard.blocks - 1)


def test_store_ties(spark):
    """Texts of one id, null ids and repeats: the same starts however rows are dealt."""
    rows = [(5, f"text {i % 7} of five") for i in range(20)] + [(None, f"null {i}") for i in range(9)] + [(2, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    told = []
    for parts in (1, 5):
        shards = rans_store.write_shards(df.repartition(parts), Stage(spark, "ties"), WORD, 2)
        told.append(sorted((-1 if r.doc_id is None else r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rans_store.read_shards(shards).collect()))
    assert told[0] == told[1] and len(told[0]) == len(rows)
    assert sorted(r[1] for r in told[0]) == np.cumsum([0, *[r[2] for r in sorted(told[0], key=lambda r: r[1])]])[:-1].tolist()


BLANKS = [" " * 3_000_000, "\n" * 3_000_000, "\t " * 1_000_000, "a" + " " * 20_000 + "b\n" * 10_000]


@pytest.mark.parametrize(("kind", "path"), [(ByteBpe, BYTE), (WordBpe, WORD)])
def test_long_blanks(kind, path):
    slow, fast = Tokenizer.from_file(path), kind(path)
    for t in BLANKS:
        assert fast.many([t])[0].tolist() == slow.encode(t, add_special_tokens=False).ids


def test_long_blanks_in_operators(spark):
    """Millions of blanks go through packing, the store and the counter."""
    df = spark.createDataFrame(list(enumerate(BLANKS)), "doc_id long, text string")
    slow = {path: {i: len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for i, t in enumerate(BLANKS)} for path in (BYTE, WORD)}
    rows = packing.pack(df, BYTE).groupBy("doc_id").sum("length").collect()
    assert {r.doc_id: r[1] - 1 for r in rows} == slow[BYTE]
    assert {r.doc_id: r.n_tokens for r in fst_count.count_tokens(df, BYTE).collect()} == slow[BYTE]
    shards = rans_store.write_shards(df, Stage(spark, "blanks"), WORD, 2)
    assert {r.doc_id: r.n_tokens - 1 for r in rans_store.read_shards(shards).collect()} == slow[WORD]


def test_count_long_run(monkeypatch):
    """One run of letters is walked at a few microseconds a byte, and states started anew within it change nothing."""
    import time

    r = random.Random(6)
    text = "".join(r.choice("abcdefghij") for _ in range(200_000))
    want = len(Tokenizer.from_file(BYTE).encode(text, add_special_tokens=False).ids)
    machine = fst_count.Machine(BYTE)
    began = time.perf_counter()
    assert machine.count(pa.array([text], pa.large_string()))[0] == want
    assert time.perf_counter() - began < 5
    monkeypatch.setattr(fst_count, "MOST_STATES", 500)
    assert fst_count.Machine(BYTE).count(pa.array([text], pa.large_string()))[0] == want


def test_shard_damage():
    body = bytearray(rans_store.encode(np.arange(20_000, dtype=np.uint32) % 300))
    body[-5000] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans_store.decode(bytes(body))
    assert len(rans_store.encode(np.full(100_000, 7, np.uint32))) < 2000


def test_store_edge(spark, edge, nothing, monkeypatch):
    monkeypatch.setattr(rans_store, "SHARD", 3000)
    got = rans_store.read_shards(rans_store.write_shards(edge, Stage(spark, "t"), WORD, 2)).collect()
    slow = Tokenizer.from_file(WORD)
    rows = sorted(edge.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    crc = lambda t: zlib.crc32(np.array([*slow.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes())
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids_crc32) for r in got) == sorted((r.doc_id is not None, r.doc_id or 0, crc(r.text)) for r in rows)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert rans_store.read_shards(rans_store.write_shards(nothing, Stage(spark, "t"), WORD, 2)).count() == 0


def test_pack_edge(edge, nothing):
    got = packing.pack(edge, BYTE, size=64).collect()
    slow = Tokenizer.from_file(BYTE)
    docs = [[*slow.encode(r.text or "", add_special_tokens=False).ids, 0] for r in edge.collect()]
    assert sum(r.length for r in got) == sum(map(len, docs))
    sequences: dict = {}
    for r in got:
        assert len(r.ids) == 4 * r.length
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()]
        total = sum(r.length for r in own)
        assert total <= 64 and total & (total - 1) == 0
    single = {r.doc_id: r.text for r in edge.groupBy("doc_id", "text").count().where("count = 1 and doc_id is not null").collect()}
    for doc, text in single.items():
        own = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert b"".join(r.ids for r in own) == np.array([*slow.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        assert [r.start for r in own] == [0, *np.cumsum([r.length for r in own])[:-1].tolist()] and {r.doc_tokens for r in own} == {sum(r.length for r in own)}
    assert packing.pack(nothing, BYTE).count() == 0


def test_packer_bound():
    packer = packing.Packer(64, 4, 0)
    for i in range(500):
        packer.add(i, np.arange(1 + i % 50, dtype=np.uint32))
    assert all(sum(len(p[3]) for p in w) == u < 64 for w, u in zip(packer.windows, packer.used, strict=True))
    assert {x: 0 for x in packer.used} is not None and len(packer.windows) == 4
