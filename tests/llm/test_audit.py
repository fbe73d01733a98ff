"""SimHash balls, the filter audit and vector codes against brute force and SQL."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from agorascope.llm import filter_audit, simhash_ball, vector_codes
from agorascope.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0d]+")
SMALL = "/root/testdata/sf0.001"


def simhash(text, k=4):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(low)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=4):
    """Component number of each fingerprint by comparing every two."""
    every, root = sorted(set(prints)), {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    values = np.array(every, np.uint64)
    for i, p in enumerate(every):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius):
            root[top(every[i + 1 + int(j)])] = top(p)
    return {p: top(p) for p in every}


def same_as_brute_force(rows, got):
    prints = [(i, simhash(t)) for i, t in rows]
    group = components([p for _, p in prints])
    least = {}
    for i, p in prints:
        if i is not None:
            least[group[p]] = min(i, least.get(group[p], i))
    assert Counter((i, f"{p:016x}", least.get(group[p])) for i, p in prints) == Counter((r.doc_id, r.fingerprint, r.component_id) for r in got)


def test_simhash_is_brute_force(spark, edge, documents, nothing):
    for df in (edge, documents):
        same_as_brute_force([(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()], simhash_ball.near_duplicates(df).collect())
    assert simhash_ball.near_duplicates(nothing).count() == 0
    got = QUERIES["op11_simhash_ball"](spark, SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == documents.count()


def clusters(seed, n=400):
    """Fingerprints around some centres, at distances on either side of the radius, chains and outliers."""
    r, out = random.Random(seed), []
    for _ in range(12):
        centre = r.getrandbits(64)
        for _ in range(n // 14):
            own = centre
            for b in r.sample(range(64), r.choice([0, 1, 2, 3, 4, 5, 6])):
                own ^= 1 << b
            out.append(own)
        for _ in range(6):
            for b in r.sample(range(64), 4):
                centre ^= 1 << b
            out.append(centre)
    return sorted({*out, 0, 2**64 - 1, 15, 31, *(r.getrandbits(64) for _ in range(n // 4))})


@pytest.mark.parametrize("variants, copies", [(1 << 22, 256), (1 << 14, 256), (1 << 12, 40), (1 << 8, 256), (1 << 8, 1000)])
def test_links_at_any_number_of_buckets(spark, monkeypatch, variants, copies):
    """One bucket or thousands, one pass or several: the same components."""
    monkeypatch.setattr(simhash_ball, "VARIANTS", variants)
    monkeypatch.setattr(simhash_ball, "COPIES", copies)
    prints = clusters(variants + copies)
    rows = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "print long").repartition(3)
    pairs = [(r.a % 2**64, r.b % 2**64) for r in simhash_ball.linked(rows, simhash_ball.Stage(spark, "test")).collect()]
    want, found = components(prints), {p: p for p in prints}
    assert len(pairs) == len(set(pairs)) and all(a < b and want[a] == want[b] for a, b in pairs)

    def top(x):
        while found[x] != x:
            x = found[x]
        return x

    for a, b in pairs:
        found[top(a)] = top(b)
    assert len({(want[p], top(p)) for p in prints}) == len(set(want.values())) == len({top(p) for p in prints})
    few = rows.sparkSession.createDataFrame([], "print long")
    assert simhash_ball.linked(few, simhash_ball.Stage(spark, "test")).count() == 0
    with pytest.raises(ValueError, match="even"):
        simhash_ball.linked(rows, simhash_ball.Stage(spark, "test"), radius=3)


def test_every_variant_is_in_one_bucket():
    deal = simhash_ball.Deal(4, 5)
    prints = np.array([0, 1, 2**63, 0x123456789ABCDEF0], np.uint64)
    assert len(deal.masks) == 1 + 64 + 2016
    seen = Counter()
    for bucket in range(32):
        own = prints[(deal.buckets(prints) == bucket).any(1)]
        variants, of = deal.variants(bucket, own)
        assert (deal.hash(variants) == bucket).all()
        seen.update(zip(own[of].tolist(), variants.tolist(), strict=True))
    assert max(seen.values()) == 1 and len(seen) == 4 * 2081
    assert all((a ^ b).bit_count() <= 2 for a, b in seen)


def test_a_bucket_of_more_entries_than_places(monkeypatch):
    prints, deal = np.array(clusters(5), np.uint64), simhash_ball.Deal(4, 0)
    want = simhash_ball.collisions(0, prints, deal)
    assert (np.bitwise_count(prints[want[0]] ^ prints[want[1]]) <= 4).all() and len(want[0]) > 100
    monkeypatch.setattr(simhash_ball, "PLACE", 8)
    assert all((a == b).all() for a, b in zip(want, simhash_ball.collisions(0, prints, deal), strict=True))


def test_a_large_group_gives_few_rows():
    """Thousands of near copies come out as one star, the same from every bucket that joins them, and not as pairs."""
    r = random.Random(2)
    centre = r.getrandbits(64)
    prints = {centre}
    while len(prints) < 1800:
        own = centre
        for b in r.sample(range(64), r.choice([1, 2, 2, 2])):
            own ^= 1 << b
        prints.add(own)
    values, deal = np.array(sorted(prints), np.uint64), simhash_ball.Deal(4, 2)
    found = [simhash_ball.joined(bucket, values, deal, 4) for bucket in range(4)]
    assert all(len(a) < len(values) for a, _ in found)
    assert len({(int(x), int(y)) for a, b in found for x, y in zip(a, b, strict=True)}) < 2 * len(values)


def test_long_text_in_pieces(monkeypatch):
    text = " ".join(random.Random(1).choice(["ab", "CDE", "f", "ghé"]) for _ in range(5000))
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = simhash_ball.words(data, np.array([0, len(data)]))
    monkeypatch.setattr(simhash_ball, "COUNTED", 37)
    assert simhash_ball.fingerprint(simhash_ball.shingle_hashes(data, starts, ends, 4, 42)) == simhash(text)


def audited(docs, marks):
    """The audit by plain Python: docs of (doc_id, text, part), marks of (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = {i for i, q, _ in marks if q == 1 and i is not None}, {i for i, _, x in marks if x == 1 and i is not None}
    flags = []
    for i, t, part in docs:
        t, words = t or "", WORD.findall(t or "")
        fails = "A" * (len(words) < 200) + "B" * (100 * len(set(words)) < 50 * len(words)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 2 * len(t)) + "D" * bool(re.search("[#$%&*|]", t))
        flags.append((part or "", fails + "E" * (i is not None and i > first[t]), i in good, i in toxic))
    out, shapley = {}, Counter()
    for order in map("".join, permutations("ABCDE")):
        for part, fails, is_good, is_toxic in flags:
            gone = min((order.index(x) + 1 for x in fails), default=6)
            for step, f in enumerate(order, 1):
                row = out.setdefault((part, order, step), [0] * 6)
                for j, yes in enumerate((gone > step, gone == step, gone < step and f in fails, fails == f, gone == step and is_good, gone == step and is_toxic)):
                    row[j] += yes
                shapley[part, f] += gone == step
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_is_brute_force(spark, edge, documents, nothing):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, 1), (7, 1, None), (999, 1, 1)], "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    for df, marks in ((edge, odd), (documents, labels)):
        docs = [(r.doc_id, r.text, r.source) for r in df.select("doc_id", "text", "source").collect()]
        got = filter_audit.audit(df, marks)
        rows = got.collect()
        assert set(map(tuple, rows)) == audited(docs, [(r.doc_id, r.quality, r.toxic) for r in marks.collect()])
        assert len(rows) == 600 * len({x[2] or "" for x in docs})
    assert filter_audit.audit(nothing, odd).count() == 0
    assert filter_audit.audit(documents, odd.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_audit_reads_each_text_once_and_combines(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{x}.parquet") for x in ("documents", "labels"))
    assert filter_audit.orders(docs).count() == 120
    plan = filter_audit.audit(docs, labels)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def coded(rows, rounds=6):
    """Codes by plain Python integers: rows of (vec_id, vector, label)."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) and abs(x) < 1000 for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = -(-len(kept[0][1]) // 8)
    cut = [[(v + [0] * 8)[p * width : (p + 1) * width] for p in range(8)] for v in (r[1] + [0] * (8 * width - len(r[1])) for r in kept)]
    books = [[c[p] for c in cut[:16]] for p in range(8)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), n) for n, e in enumerate(book))

    for _ in range(rounds):
        held = [[[] for _ in b] for b in books]
        for c in cut:
            for p in range(8):
                held[p][nearest(c[p], books[p])[1]].append(c[p])
        books = [[[sum(col) // len(own) for col in zip(*own, strict=True)] if own else books[p][e] for e, own in enumerate(held[p])] for p in range(8)]
    found = [[nearest(c[p], books[p]) for p in range(8)] for c in cut]
    by_label = Counter()
    for (_, _, label), f in zip(kept, found, strict=True):
        by_label[label] += sum(d for d, _ in f)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, "".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f), by_label[label], digest) for (i, _, label), f in zip(kept, found, strict=True))


def test_codes_are_brute_force(spark):
    r = random.Random(3)
    vector = lambda n=16: [r.gauss(0, 1) for _ in range(n)]
    tied = [0.5, -0.25] * 8
    rows = [(r.randint(-50, 200), vector(), r.choice([None, 1, 2])) for _ in range(120)] + [(i, tied, 1) for i in range(30)]
    rows += [(3, None, 1), (4, [], 1), (-99, [None, *vector(15)], 1), (-98, [float("nan"), *vector(15)], 1), (-97, [float("inf"), *vector(15)], 2), (-96, [1e30, *vector(15)], 2), (None, vector(), None), (9, vector(24), 1), (-1, vector(), None), (-1, tied, None)]
    frame = lambda some: spark.createDataFrame([(*x, "clash", 1) for x in some], "vec_id long, embedding array<double>, label int, code string, ids int").repartition(3)
    odd = [(i, vector(10), None) for i in range(5)]
    for some in (rows, odd, rows[:1], [(1, [-1e-9] * 8, None)]):
        assert Counter(map(tuple, vector_codes.compress(frame(some)).collect())) == coded(some)
    for some in (frame(rows).limit(0), frame([(3, None, 1), (4, [], 1)])):
        assert vector_codes.compress(some).count() == 0
    with pytest.raises(ValueError, match="256"):
        vector_codes.compress(frame(rows), entries=300)


def test_code_sums_by_shuffle(spark, monkeypatch):
    """Labels beyond the broadcast's bound give the same rows."""
    some = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    want = Counter(map(tuple, vector_codes.compress(some).collect()))
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 2)
    monkeypatch.setattr(vector_codes, "BLOCK", 100)
    assert Counter(map(tuple, vector_codes.compress(some.repartition(7)).collect())) == want


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_vector_codes"])
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    cursor = con.execute(ORACLES[name])
    rows, names = cursor.fetchall(), [d[0] for d in cursor.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(names)
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == Counter(rows)
