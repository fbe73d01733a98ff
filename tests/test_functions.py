import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agorascope.functions import jsontext, labels, sequences, text, timeutil, vectors
from agorascope.operators.filters import parse


def values(spark, rows, schema, *columns):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    ("raw", "clean"),
    [(None, ""), ("", ""), ("[t](http://x) y", "[t]( y"), ("see [docs](a/b)", "see docs"), ("a ```x\ny``` b", "a b"), ("> quote\n# head\n- item", "quote head item"), ("`c` *b* ~s~ _u_", "c b s u"), ("hi \U0001f600 there", "hi there"), ("a  b ", "a b"), ("go www.x.org/1 now", "go now")],
)
def test_clean_text(spark, raw, clean):
    assert values(spark, [(raw,)], "t string", text.clean_text(F.col("t"))) == [(clean,)]


def test_bots_and_deleted(spark):
    rows = [("I am a bot, beep",), ("**bot says",), ("robot arms",), (None,), ("",), (" AutoMod here",), ("not automod",)]
    assert [r[0] for r in values(spark, rows, "t string", text.is_bot(F.col("t")))] == [True, True, False, True, True, True, False]
    assert values(spark, [(" [Deleted] ",), ("[removed]",), ("x",), (None,)], "t string", text.is_deleted(F.col("t"))) == [(True,), (True,), (False,), (False,)]


def test_topic_text(spark):
    rows = [("T *x*", "b `c`", True), ("T", "b", False), ("T", "", True), (None, "b", True)]
    assert [r[0] for r in values(spark, rows, "t string, b string, s boolean", text.topic_text(F.col("t"), F.col("b"), F.col("s")))] == ["T x\nb c", "T", "T", "b"]


def test_measures(spark):
    rows = [(None,), ("",), ("abcd",), ("abcde",), (" a b  c ",)]
    got = values(spark, rows, "t string", text.estimate_tokens(F.col("t")), text.estimate_tokens(F.col("t"), True), text.word_count(F.col("t")))
    assert got == [(1, 0, 0), (1, 0, 0), (1, 1, 1), (2, 2, 1), (2, 2, 3)]
    assert values(spark, [("abc def ghi",)], "t string", text.shorten(F.col("t"), 7), text.shorten(F.col("t"), 7, 4), text.shorten(F.col("t"), 0)) == [("abc def...", "abc...", "abc def ghi")]


@settings(max_examples=20, deadline=None)
@given(st.text(st.characters(codec="ascii"), max_size=20))
def test_string_hash(spark, s):
    h = 0
    for c in s:
        h = (h * 31 + ord(c) + 2**31) % 2**32 - 2**31
    assert values(spark, [(s,)], "t string", text.string_hash(F.col("t"))) == [(abs(h),)]


def test_labels(spark):
    raw = [(None,), ("",), (" Agree ",), ("support",), ("oppose",), ("none",), ("partial",), ("unclear",), ("Neutral",)]
    got = values(spark, raw, "t string", labels.stance(F.col("t")), labels.stance(F.col("t"), "neutral"))
    assert got == [(None, None), (None, None), ("agree", "agree"), ("agree", "agree"), ("disagree", "disagree"), ("neutral", "neutral"), (None, "neutral"), (None, "neutral"), ("neutral", "neutral")]


def test_confidence_and_weight(spark):
    raw = [(None, 3), ("", None), ("0.8", -5), ("x", 0), ("-1", 10), ("2", 10**6)]
    got = values(spark, raw, "c string, s long", labels.confidence(F.col("c")), labels.compute_weight(F.col("s"), labels.confidence(F.col("c"))))
    want = [1, 1, 0.8, 1, 0, 1]
    assert [g[0] for g in got] == want
    for (c, s), (_, w), k in zip(raw, got, want, strict=True):
        assert w == pytest.approx((1 + math.log1p(max(0, s or 0))) * (0.5 + 0.5 * k))


def test_polarization(spark):
    rows = [(0.5, 0.5, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0), (0.25, 0.25, 0.5), (0.0, 0.0, 0.0)]
    got = [r[0] for r in values(spark, rows, "a double, d double, n double", labels.polarization(F.col("a"), F.col("d"), F.col("n")))]
    assert got == pytest.approx([1, 0, 0, 0.5, 1])
    assert values(spark, [(1.0, 1.0, 1.0), (0.0, 1.0, 1.0), (0.0, 0.0, 1.0)], "a double, d double, n double", labels.dominant(F.col("a"), F.col("d"), F.col("n"))) == [("agree",), ("disagree",), ("neutral",)]


def test_nli(spark):
    rows = [(0.9, 0.1, 0.0), (0.1, 0.8, 0.3), (0.5, 0.4, 0.1), (0.1, 0.2, 0.9)]
    assert [r[0] for r in values(spark, rows, "a double, d double, n double", labels.nli_stance(F.col("a"), F.col("d"), F.col("n")))] == ["FAVOR", "AGAINST", "NONE", "NONE"]


def test_time(spark):
    days = {"2021-01-03": ("2020-W53", "2021-01-03"), "2024-12-30": ("2025-W01", "2024-12-29"), "1970-01-01": ("1970-W01", "1969-12-28")}
    rows = [(d,) for d in days]
    c = F.unix_seconds(F.col("d").cast("timestamp"))
    assert values(spark, rows, "d string", timeutil.snapshot_week(c), F.date_format(timeutil.bucket(c, "week"), "yyyy-MM-dd")) == list(days.values())
    assert values(spark, [("12.9",), ("x",), (None,)], "d string", timeutil.to_epoch_seconds(F.col("d"))) == [(12,), (0,), (0,)]
    assert [timeutil.bucket_unit(d) for d in (None, 90, 120, 180)] == ["week", "day", "day", "week"]


def test_parse_filters():
    f = parse("30d", "all", "topic_1", now=10_000_000)
    assert (f.days, f.since, f.subreddit, f.topic) == (30, 10_000_000 - 30 * 86400, None, "topic_1")
    assert parse("weird", now=1).since is None and parse(None, now=10**9).days == 90


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 30), st.integers(1, 8), st.integers(0, 9))
def test_chunks_cover(spark, n, size, overlap):
    tokens = [str(i) for i in range(n)]
    (got,) = values(spark, [(tokens,)], "t array<string>", sequences.chunk_tokens(F.col("t"), size, overlap))[0]
    step = max(1, size - max(0, min(overlap, size - 1)))
    want, at = [], 0
    while at < n:
        want.append(tokens[at : at + size])
        if at + size >= n:
            break
        at += step
    assert got == want


def test_vectors(spark):
    rows = [([3.0, 4.0], [0.0, 0.0]), ([1.0, 0.0], [0.0, 1.0])]
    got = values(spark, rows, "a array<double>, b array<double>", *[F.round(vectors.distance(F.col("a"), F.col("b"), m), 6) for m in ("cosine", "manhattan", "euclidean")], vectors.l2_normalize(F.col("b")))
    assert got == [(1.0, 7.0, 5.0, [0.0, 0.0]), (1.0, 2.0, round(2**0.5, 6), [0.0, 1.0])]


def test_json(spark):
    rows = [('[{"a": 1}]',), ('Sure: [{"a": 1}] ok',), ('{"results": [{"a": 1}, {"a": 2}]}',), ('[{"a": 1',), ("",), (None,), ('{"a": 7}',)]
    got = [r[0] for r in values(spark, rows, "t string", jsontext.rows_of(F.col("t"), "struct<a:int>"))]
    assert [None if g is None else [x["a"] for x in g] for g in got] == [[1], [1], [1, 2], None, None, None, [7]]
    assert jsontext.loose_records("```json\n[{'a': True}]\n```") == [{"a": True}]
    assert jsontext.loose_records('{"evaluations": [{"a": 1}]}') == [{"a": 1}] and jsontext.loose_records("no") == []
