"""Chat strings, web archives, page texts and the pipeline."""

import base64
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from agorascope.llm import chat, html_extract, queries, warc
from agorascope.llm.staging import Stage

SAID = [(-8, 0, "user", "a\\<|end|> \\\\ <|turn|>x<<|text|>[INST]\\["), (-8, 1, "assistant", None), (-8, 2, None, "<s>\\"), (-8, 3, "assistant", "[/INST]</s>\\\\"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"), (-7, 0, "user", "</s>[INST] ok [/INST]"), (None, 0, "assistant", "é\n\U0001f600"), (5, 1, "user", "same"), (5, 1, "user", "same"), (6, None, "assistant", "")]


def test_chat_round_trip(spark):
    df = spark.createDataFrame([(*r, 1, 2) for r in SAID], "conv_id long, turn long, role string, text string, rank int, all int")
    got = {r.conv_id: r for r in chat.digest(chat.format_chat(df)).collect()}
    for conv in {r[0] for r in SAID}:
        own = sorted(((-1 if t is None else t), role or "", text or "") for c, t, role, text in SAID if c == conv)
        told = "".join(f"{role}\n{text}\n" for _, role, text in own)
        loss = "".join(text for _, role, text in own if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.turns_sha256) == (len(own), hashlib.sha256(told.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_controls_are_escaped(spark):
    df = spark.createDataFrame(SAID[:6], "conv_id long, turn long, role string, text string")
    for r in chat.format_chat(df).collect():
        body = re.sub(r"<\|(?:turn|text|end)\|>", "", r.formatted)
        assert not re.search(r"<\||</?s>|\[/?INST\]", body)


def test_chat_parts(spark):
    part = lambda t, text=None, ref=None, units=None: (t, text, ref, units)
    rows = [(1, 0, "user", [part("text", "see <|x"), part("image", ref="i.png", units=4), part("text", " and "), part("audio", ref="a.wav", units=10)]), (1, 1, "assistant", [part("text", "ok")]), (1, 2, "user", None), (1, 3, "user", [part("document", ref="d.pdf"), part("odd", "plain")])]
    r = chat.format_chat(spark.createDataFrame(rows, f"conv_id long, turn long, role string, text {chat.PART}")).first()
    assert r.formatted == "<|turn|>user<|text|>see <\\|x<|image 0.1|> and <|audio 0.3|><|end|><|turn|>assistant<|text|>ok<|end|><|turn|>user<|text|><|end|><|turn|>user<|text|><|document 3.0|>plain<|end|>"
    assert [tuple(a) for a in r.attachments] == [(0, 1, "image", "i.png", 1024), (0, 3, "audio", "a.wav", 250), (3, 0, "document", "d.pdf", 600)] and r.attachment_tokens == 1874
    assert [r.formatted[s.start : s.end] for s in r.loss] == ["ok"]


def test_archives(spark):
    big = "z" * (2 * warc.CHUNK + 77)
    rows = [(1, "http://a/x y", "<p>é"), (2, None, None), (3, "u", ""), (0, "u", "<p>é"), (5, "u", big), (4, "u", big), (9, "u", "a\r\n\r\nWARC/1.1\r\n"), (9, "u", "a\r\n\r\nWARC/1.1\r\n"), (None, "u", "alone"), (None, "u", big)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, sha1 int").repartition(2)
    manifest = warc.write_archives(df, Stage(spark, "warc"))
    assert warc.read_chunks(manifest).rdd.getNumPartitions() == manifest.count() == 2
    got = sorted((r.page_id if r.page_id is not None else -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.pages(warc.read_chunks(manifest)).collect())
    body = lambda t: (t or "").encode()
    first: dict = {}
    for i, _, t in rows:
        if i is not None:
            first[body(t)] = min(i, first.get(body(t), i))
    want = []
    for i, _, t in rows:
        f = first.get(body(t), i)
        want.append((i if i is not None else -1, len(body(t)), base64.b32encode(hashlib.sha1(body(t)).digest()).decode(), "response" if f == i else "revisit", None if f == i else f))
    assert got == sorted(want, key=lambda w: w[:4])
    chunks = warc.read_chunks(manifest).where("record_id = 'urn:x-page:4'").orderBy("chunk_no").collect()
    assert b"".join(c.data for c in chunks) == big.encode() and all(len(c.data) <= warc.CHUNK for c in chunks) and len(chunks) == 3
    assert [c.is_last for c in chunks] == [False] * (len(chunks) - 1) + [True]


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_record_stream(monkeypatch, step):
    monkeypatch.setattr(warc, "CHUNK", 7)
    bodies = [b"", b"\r\n\r\n", b"0123456789" * 5]
    stream = b""
    for i, body in enumerate(bodies):
        http = warc.HTTP % len(body)
        stream += warc.header(i, "response", "u", "d", "x", len(body), len(http) + len(body), None) + http + body + b"\r\n\r\n"
    reader, got, one = warc.RecordStream(), [], b""
    for a in range(0, len(stream), step):
        for _, piece, last in reader.feed(stream[a : a + step]):
            assert len(piece) <= 7
            one += piece
            if last:
                got.append(one)
                one = b""
    assert got == bodies


def test_archive_is_standard(spark):
    """gzip members that any reader of archives takes apart."""
    import gzip

    df = spark.createDataFrame([(1, "http://a/", "<p>x")], "page_id long, url string, html string")
    manifest = warc.write_archives(df, Stage(spark, "warc"))
    path = manifest.first().path.removeprefix("file:")
    body = gzip.open(path).read().decode()
    head, _, rest = body.partition("\r\n\r\n")
    assert head.startswith("WARC/1.1\r\nWARC-Type: response") and rest.endswith("<p>x\r\n\r\n")
    size = int(re.search(r"Content-Length: (\d+)$", head)[1])
    assert len(rest.encode()) == size + 4
    empty = warc.write_archives(df.limit(0), Stage(spark, "warc"))
    assert empty.count() == 0 and warc.read_chunks(empty).count() == 0 and warc.pages(warc.read_chunks(empty)).count() == 0


def test_warc_members_at_any_place_of_chunks(monkeypatch):
    """Wherever a chunk of the archive ends, between the bytes that tell a gzip member as well."""
    import gzip
    import io

    some = [gzip.compress(bytes([65 + i]) * (3 + i)) for i in range(5)]
    whole, want = b"".join(some), b"".join(map(gzip.decompress, some))
    for size in range(1, len(whole) + 1):
        monkeypatch.setattr(warc, "CHUNK", size)
        assert b"".join(warc.inflated(io.BytesIO(whole), 0, len(whole))) == want
    assert b"".join(warc.inflated(io.BytesIO(b"W"), 0, 1)) == b"W"


def test_foreign_archives(spark, tmp_path):
    """Records of other writers: any id and type, other blocks, names of fields in other cases, compressed or not."""
    import gzip

    def record(kind, name, body, more=""):
        return f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <{name}>\r\nContent-Length: {len(body)}\r\n{more}\r\n".encode() + body + b"\r\n\r\n"

    http = "Content-Type: application/http; msgtype=response\r\n"
    some = [
        record("warcinfo", "urn:uuid:a", b"software: x\r\n\r\n", "Content-Type: application/warc-fields\r\n"),
        record("response", "urn:uuid:b", b"HTTP/1.1 200 OK\r\nX: y\r\n\r\nbody", http),
        record("response", "urn:uuid:c", b"no header end", http),
        record("resource", "urn:uuid:d", b"", ""),
        record("revisit", "urn:uuid:e", b"HTTP/1.1 200 OK\r\n\r\n", http + "WARC-Payload-Digest: sha1:ABC\r\nWARC-Refers-To: <urn:uuid:b>\r\n"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, some)))
    (tmp_path / "b.warc").write_bytes(b"".join(some))
    rows = warc.read_chunks(warc.archives_at(spark, f"file://{tmp_path}/*")).collect()
    told = sorted((r.record_id, r.warc_type, bytes(r.data), r.payload_bytes, r.refers_to) for r in rows)
    want = [("urn:uuid:a", "warcinfo", b"software: x\r\n\r\n", 15, None), ("urn:uuid:b", "response", b"body", 4, None), ("urn:uuid:c", "response", b"no header end", 13, None), ("urn:uuid:d", "resource", b"", 0, None), ("urn:uuid:e", "revisit", b"", None, "urn:uuid:b")]
    assert told == sorted(want * 2, key=lambda w: w[0]) and all(r.is_last for r in rows)
    assert {r.payload_digest for r in rows if r.record_id == "urn:uuid:e"} == {"ABC"}


def test_archives_inflate_in_bounds(tmp_path):
    """A record that inflates two hundredfold costs a few chunks of memory."""
    import gzip
    import tracemalloc

    size = 60 << 20
    path = tmp_path / "big.warc.gz"
    with gzip.open(path, "wb") as f:
        f.write(f"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: {size}\r\n\r\n".encode())
        for _ in range(size >> 20):
            f.write(bytes(1 << 20))
        f.write(b"\r\n\r\n")
    end = path.stat().st_size
    tracemalloc.start()
    with open(path, "rb") as f:
        stream, got = warc.RecordStream(), 0
        for piece in warc.inflated(f, 0, end):
            got += sum(len(p) for _, p, _ in stream.feed(piece))
        stream.end()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == size and peak < 12 * warc.CHUNK
    with open(path, "rb") as f, pytest.raises(ValueError, match="ends within"):
        list(warc.inflated(f, 0, end - 100))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1><a href=/>Home</a></header>
<nav><ul><li><a href=a>menu one</a></li></ul></nav><div id="cookie-notice">We use cookies. Accept, please, now.</div><!-- <p>no</p> -->
<div class=wrap><div class="post-content"><h1>Title &amp; more</h1><p>First para, with <a href=x>link</a> and more
  words in it, quite long really.<p>Implied <b>end</b> here<br>and a break.</p><ul><li>one item of text</li><li>two items</li></ul>
<div class="ad-slot">Buy this now!</div><p>Short.</p><script>var x = "<p>bad</p>";</script><p>Second para &eacute;&#233;&#xe9; is long too, and goes on, and on.</p>
<form><p>Subscribe to our list</p></form></div><aside><p>Some sidebar text that is long enough, with commas, to be content.</p></aside></div>
<section id="comments"><article class="comment"><p>I disagree, this is a long comment, with commas, and more.</p></article></section><footer>c 2020</footer></body></html>"""


def test_page_text():
    assert html_extract.main_text(PAGE).split("\n") == ["Title & more", "First para, with link and more words in it, quite long really.", "Implied end here and a break.", "one item of text", "two items", "Short.", "Second para ééé is long too, and goes on, and on."]
    assert html_extract.main_text(None) == html_extract.main_text("") == html_extract.main_text("<nav>x</nav>") == ""
    assert html_extract.main_text("plain &lt;text&gt;") == "plain <text>" and html_extract.main_text("<p>a<p>b<p></p>") == "a\nb"
    assert html_extract.main_text("<div><p>" + "x, " * 50_000) == ("x, " * 50_000).strip()
    assert html_extract.main_text("<a <b> <p class='x" + "y" * 2000) is not None


def test_page_parts():
    """Chosen blocks stay wherever the article's element ends; lists of links in an article are part of it."""
    said = lambda w, n: " ".join(f"{w}{i} and more, of it." for i in range(n))
    lead, body = said("lead", 18), [said(w, 40) for w in ("one", "two", "three", "four")]
    ps = "".join(f"<p>{b}</p>" for b in body)
    assert html_extract.main_text(f"<body><div class=post><div class=lead><p>{lead}</p></div><div class=body>{ps}</div></div></body>").split("\n") == [lead, *body]
    parts = f"<body><div><article><p>{body[0]}</p><p>{body[1]}</p></article><article><h2>Part two</h2><p>{body[2]}</p><p>{lead}</p></article></div></body>"
    assert html_extract.main_text(parts).split("\n") == [body[0], body[1], "Part two", body[2], lead]
    cited = f"<body><article>{ps}<ul><li><a href=x>A book, by an author</a></li><li><a href=y>Another one</a></li></ul></article></body>"
    assert html_extract.main_text(cited).split("\n") == [*body, "A book, by an author", "Another one"]
    assert html_extract.main_text(f"<body><ul><li><a href=x>Start</a></li></ul>{ps}<ul><li><a href=x>Home</a></li></ul></body>").split("\n") == body


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        want = article_of(r.html)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url
    odd = spark.createDataFrame([(None, None, None, 1), (1, "u", "", 2), (1, "u", "", 2)], "page_id long, url string, html string, text int")
    assert [(r.page_id, r.text, r.n_chars) for r in html_extract.extract(odd).orderBy("page_id").collect()] == [(None, "", 0), (1, "", 0), (1, "", 0)]
    assert html_extract.extract(odd.limit(0)).count() == 0


def article_of(page):
    """The text of a test page's article, by its markup."""
    import html

    parts = re.split(r"</?(?:p|h1)>", re.search(r"<article>(.*)</article>", page, re.S)[1])
    return "\n".join(x for x in (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", p.replace("<br>", " ")))).strip() for p in parts) if x)


def test_page_ratios_decide(spark, monkeypatch):
    """Without its names a page gives nearly the same; with other scores it does not."""
    import random

    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    want, n = [article_of(p) for p in pages], len(pages)
    unnamed = [re.sub(r' (?:class|id)="[^"]*"', "", p).replace("article>", "div>") for p in pages]
    bare = [re.sub(r"(</?)(?:nav|footer)>", r"\1div>", p) for p in unnamed]
    for variant, least in ((pages, n), (unnamed, 0.9 * n), (bare, 0.9 * n)):
        got = [html_extract.main_text(p) for p in variant]
        assert sum(g == w for g, w in zip(got, want, strict=True)) >= least
        assert all(set(w.split("\n")) - {""} <= set(g.split("\n")) for g, w in zip(got, want, strict=True)) or least < n
    real, r = html_extract.scores, random.Random(5)
    for other in (lambda f: [1.0] * len(f), lambda f: [-x for x in real(f)], lambda f: [r.random() for _ in f]):
        monkeypatch.setattr(html_extract, "scores", other)
        for variant in (pages, unnamed):
            assert sum(html_extract.main_text(p) != w for p, w in zip(variant, want, strict=True)) > 0.9 * n


def test_page_ratios_decide_beside_the_prior(spark, monkeypatch):
    """The prior stays and the ratios alone are replaced: pages without names lose their articles."""
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    want = [article_of(p) for p in pages]
    bare = [re.sub(r"(</?)(?:nav|footer|article)>", r"\1div>", re.sub(r' (?:class|id)="[^"]*"', "", p)) for p in pages]
    right = lambda: sum(html_extract.main_text(p) == w for p, w in zip(bare, want, strict=True))
    before, real = right(), html_extract.ratios
    assert before > 0.9 * len(bare)
    for other in (lambda f, paths: [1.0] * len(f), lambda f, paths: [1 / (1 + x) for x in real(f, paths)]):
        monkeypatch.setattr(html_extract, "ratios", other)
        assert right() < 0.1 * len(bare)


def words_of(r, n):
    """Prose of n characters."""
    out = ""
    while len(out) < n:
        out += r.choice(["the", "report", "was", "read", "by", "many,", "and", "then", "it", "was", "discussed."]) + " "
    return out[: n - 1].strip().ljust(n - 1, "x") + "."


@pytest.mark.parametrize("paragraph", [60, 100, 120, 250, 400])
@pytest.mark.parametrize("comment", [110, 250, 300, 500])
def test_an_article_beside_denser_comments(paragraph, comment):
    """Comments without a name of their own do not take the place of a named article, however long and many they are."""
    import random

    r = random.Random(paragraph * comment)
    for n in (3, 12):
        article, said = [words_of(r, paragraph) for _ in range(4)], [words_of(r, comment) for _ in range(n)]
        for tag in ("article", "main"):
            body = "".join(f"<p>{p}</p>" for p in article)
            for talk in ("".join(f"<p>{c}</p>" for c in said), "".join(f"<div><b>Ann</b><p>{c}</p></div>" for c in said)):
                page = f"<body><nav><a href=/>Home</a></nav><{tag}><h1>Title here</h1>{body}</{tag}><section><h2>Responses</h2>{talk}</section><footer>c</footer></body>"
                assert html_extract.main_text(page).split("\n") == ["Title here", *article]
                page = f"<body><div><h1>Title here</h1><{tag}>{body}</{tag}><section><h2>Responses</h2>{talk}</section></div></body>"
                assert html_extract.main_text(page).split("\n") == ["Title here", *article]


@pytest.mark.parametrize("name", ["notice-of-award", "share-price", "comments-policy", "related-work", "search-results-section", "alert-level", "modal-verbs", "hidden-figures", "tags-of-war", "promotion-prospects", "tag-history", "reply-to-critics"])
def test_names_weigh_and_do_not_filter(name):
    """Prose in an element whose name only holds such a word stays, in a named article and in one found by its ratios."""
    import random

    r = random.Random(len(name))
    a, b, c = (words_of(r, n) for n in (220, 180, 240))
    for tag in ("article", "div"):
        page = f'<body><nav><a href=/>Home</a></nav><{tag}><h1>T</h1><p>{a}</p><div class="{name}"><p>{b}</p></div><p>{c}</p></{tag}><footer>c</footer></body>'
        assert html_extract.main_text(page).split("\n") == ["T", a, b, c]


@pytest.mark.parametrize("name", ["ad", "ads", "ad-slot", "advert", "share", "share-buttons", "related-posts", "comments", "comment-list", "cookie-notice", "newsletter-signup", "sidebar", "td-post-sharing", "commentBody", "wp-block-ad", "recommended-articles ad"])
def test_names_that_say_nothing_else(name):
    """What is called nothing but an advert, a comment or the like goes, in an article too."""
    import random

    r = random.Random(len(name))
    a, b, c = (words_of(r, n) for n in (220, 200, 240))
    for tag in ("article", "div"):
        page = f'<body><{tag}><h1>T</h1><p>{a}</p><div class="{name}"><p>{b}</p></div><p>{c}</p></{tag}><footer>c</footer></body>'
        assert html_extract.main_text(page).split("\n") == ["T", a, c]


def test_page_prior():
    """A page that stands in a form as a whole keeps its article; long prose in sidebars and comments goes."""
    said = lambda w, n: " ".join(f"{w}{i}, and more of it." for i in range(n))
    body = "".join(f"<p>{said(w, 30)}</p>" for w in ("one", "two", "three"))
    want = [said(w, 30) for w in ("one", "two", "three")]
    assert html_extract.main_text(f"<body><form><nav><a href=x>Home</a></nav><div>{body}</div></form></body>").split("\n") == want
    aside = f"<aside><p>{said('side', 40)}</p></aside><div class=comments><div><p>{said('said', 60)}</p></div></div>"
    assert html_extract.main_text(f"<body><div>{body}</div>{aside}</body>").split("\n") == want
    assert html_extract.main_text(f"<body><p hidden>{said('no', 50)}</p>{body}<ul><li>in between</li></ul><p>{said('four', 30)}</p></body>").split("\n") == [*want, "in between", said("four", 30)]


def test_page_is_linear():
    """Hostile pages of about a megabyte take no more than seconds."""
    import time

    pages = ['<a x="' * 170_000, "<a x='" * 170_000 + "<p>end", "<div>" * 200_000, "<div>x" * 150_000, "<div>x<span>" * 80_000, "<" * 1_000_000, "</div>" * 160_000, "<p>" + "<span>" * 50_000 + "</b>x<i>" * 80_000, "<!--" * 250_000, "<ul>" + "<li>x" * 160_000]
    for page in pages:
        began = time.perf_counter()
        html_extract.main_text(page)
        assert time.perf_counter() - began < 8, page[:20]
    assert html_extract.main_text("<p>" + "x" * 30 + "</p><a title=\"unclosed><p>still here</p>").endswith("still here")


def test_chat_oracle(spark):
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.001/conversations.parquet'")
    cursor = con.execute(queries.ORACLES["op2_chat"])
    names = [d[0] for d in cursor.description]
    df = queries.QUERIES["op2_chat"](spark, "/root/testdata/sf0.001").select(*names)
    assert sorted(map(tuple, df.collect())) == sorted(cursor.fetchall())


def test_native_plans(spark):
    """The native operators run no Python on the executors."""
    for name in ("op1_quality", "op2_chat", "op7_pii"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_one_row_of_each_group(spark):
    """Repeated rows, repeated ids and null ids: one row of each group stays, all that is in no group stays."""
    import corpus_pipeline as cp

    said = lambda w: " ".join(f"{w}{i}" for i in range(60))
    rows = [(5, said("a")), (5, said("a")), (5, said("a")), (9, said("a")), (5, said("b")), (None, said("a") + " end"), (None, said("c")), (None, said("c")), (7, said("d")), (None, said("d")), (None, said("e")), (3, ""), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = cp.one_of_each_group(spark, docs, "")
    want = [(5, said("a")), (5, said("b")), (None, said("c")), (7, said("d")), (None, said("e")), (3, ""), (None, None)]
    assert got.columns == docs.columns and sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_edge(spark, edge, nothing):
    """Nulls, blanks, long texts, ties, repeats and clashing names go through every stage and through all of them."""
    import corpus_pipeline as cp
    from agorascope.llm import packing

    d = "/root/testdata/sf0.001"
    long = spark.createDataFrame([(900, " " * 3_000_000 + "end of it", "en", "s", 5, *edge.first()[5:])], edge.schema)
    docs = edge.unionByName(long)
    for name, work in cp.STAGES:
        got, none = work(spark, docs, d), work(spark, nothing, d)
        assert none.count() == 0
        if name == "pack":
            assert {r.doc_id for r in got.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").distinct().collect()}
        else:
            assert got.columns == docs.columns and 0 < got.count() <= docs.count()
    assert cp.run_on(spark, nothing, d).count() == 0
    rows = cp.run_on(spark, docs, d).collect()
    stays = docs
    for _, work in cp.STAGES[:-1]:
        stays = work(spark, stays, d)
    packed = packing.pack(stays, queries.tokenizer("byte_bpe_50k.json")).groupBy("doc_id").sum("length").collect()
    total: dict = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {r.doc_id: r[1] for r in packed} and total


def test_no_machine_local_folder(spark):
    """Without a named folder only a local master gets one of its own."""
    from types import SimpleNamespace

    from agorascope.sources.store import shared_dir

    made = {}
    conf = SimpleNamespace(get=lambda k, other=None: made.get(k, other), set=made.__setitem__)
    session = lambda master: SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1000]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(master))
    assert shared_dir(session("local[4]")).startswith("file:")


def test_pipeline(spark):
    """run() equals its stages done one by one, and each stage's decisions hold by brute force."""
    import corpus_pipeline as cp
    from tests.llm.test_documents import components, sets_of, spans_of

    d = "/root/testdata/sf0.001"
    docs = queries.table(spark, d, "documents")
    good = cp.good_documents(spark, docs, d)
    kept = {r.doc_id for r in queries.op1_quality(spark, d).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == docs.columns
    texts = {r.doc_id: r.text for r in good.collect()}
    groups = components(sets_of(texts.items()))
    single = cp.one_of_each_group(spark, good, d)
    assert sorted(r.doc_id for r in single.collect()) == sorted(k for k, v in groups.items() if k == v) and single.columns == docs.columns
    clean = cp.without_benchmarks(spark, single, d)
    items = [r.text for r in queries.table(spark, d, "benchmark").collect()]
    left = {r.doc_id: r.text for r in clean.collect()}
    assert not any(i in t for i in items for t in left.values()) and clean.columns == docs.columns
    safe = cp.without_personal_data(spark, clean, d)
    assert not any(spans_of(r.text) for r in safe.collect()) and safe.columns == docs.columns and safe.count() == len(left)
    assert safe.where(F.col("n_chars") != F.length("text")).count() == 0
    want = {r.doc_id: r.text for r in safe.collect()}
    rows = cp.run(spark, d).collect()
    assert {r.doc_id for r in rows} == set(want)
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == {k: len(slow.encode(t, add_special_tokens=False).ids) + 1 for k, t in want.items()}
