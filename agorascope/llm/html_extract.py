"""Main text of web pages by tag-path ratios.

A page becomes blocks of text, each with the path of block tags from the root. Text length outside links and punctuation
are summed per path and set against its number of nodes; the two ratios are smoothed along the page over blocks near each
other in the tree, fused, and weighted by a prior for elements that are seldom part of an article (menus, footers, forms, elements
whose class or id is nothing but words for adverts, comments and the like). A name that holds such a word beside others (share-price)
halves the weight and no more. Where an <article>, or else a <main>, holds text outside links, what lies outside it weighs
as little as a menu, however dense it is: so comments below an article that say more than its paragraphs do not take its
place. The threshold that separates the page's positive scores best, by the variance between the two
sides, chooses paths; their blocks are content nodes. The deepest element that holds nearly all their score is the article: its
other blocks belong to it too (headings, captions, lists), but for what the prior speaks against. Outside it, content nodes
stay, and so do headings right above them. Where the article's element is the whole page, other blocks stay only between
content nodes. Where no block says anything outside links, only the prior speaks.

Null pages count as empty and give an empty text; ids and URLs are carried; repeated rows get equal rows; an empty table
gives no rows; other columns are not used. A page takes time in proportion to its length: tags that never end are found by
one backward pass over quotes, elements keep what is asked of their ancestors. Memory is bounded by one page and a batch.
"""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.textkit import strings

NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: The rest of a tag: quoted values may hold what ends tags elsewhere.
REST = re.compile(r"((?>[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
RAW_END = {t: re.compile(rf"</{t}[\s/>]", re.I) for t in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption", "optgroup"}
#: An opening tag ends an open element of these, up to the scope element.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "optgroup": ({"optgroup", "option"}, {"select"})}
SCOPE = {"td", "th", "button", "caption", "object", "html", "body", "article", "section", "div", "blockquote", "li", "table"}
#: Elements without text of the page, and such as are seldom part of an article.
HIDDEN = {"head", "svg", "canvas", "object", "audio", "video", "math", "select", "datalist"}
OUTSIDE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "fieldset", "label"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar", "tablist"}
#: Words in class or id that mark what is no part of an article.
MARKS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "sponsors", "promo", "promotion", "promoted", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "signin", "paywall", "sidebar", "sidebars", "aside", "rail", "menu", "menus", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar", "toolbar", "comment", "comments", "commentlist", "disqus", "replies", "reply", "respond", "responses", "related", "recommended", "recommendations", "share", "sharing", "social", "widget", "widgets", "pagination", "pager", "search", "outbrain", "taboola", "tags", "toc", "skip", "hidden", "copyright", "disclaimer", "sitemap"}
#: Words that class names are built with and that say nothing of what an element holds.
PLAIN = {"list", "item", "items", "box", "block", "blocks", "container", "wrapper", "wrap", "area", "section", "inner", "outer", "bar", "button", "buttons", "btn", "link", "links", "icon", "icons", "form", "top", "bottom", "left", "right", "header", "head", "title", "content", "body", "text", "slot", "unit", "panel", "module", "row", "col", "column", "primary", "secondary", "main", "site", "page", "global", "mobile", "desktop", "inline", "sticky", "fixed", "article", "story", "post", "posts", "entry", "news", "blog", "user", "reader", "readers", "group", "grid", "card", "cards", "thread", "feed", "count", "tools", "media", "message", "wrapper", "holder", "placeholder", "google", "facebook", "twitter", "whatsapp", "email", "mail", "all", "more", "you", "may", "like", "the", "and", "web", "elementor", "bootstrap", "nested"}
#: Openings of class names that tell a state or category, and what an article element is called that is not the article.
STATES = {"has", "no", "with", "without", "is", "tag", "category", "type", "status", "format", "js", "layout", "page", "single"}
OTHER_ARTICLE = {"comment", "comments", "reply", "ad", "ads", "advert", "advertisement", "promo", "promoted", "sponsored", "related", "recommended", "teaser"}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
PUNCTUATION = re.compile(r"[.,;:!?。，；：！？、…]")
SPACES = re.compile(r"\s+")
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Weight of the prior against an element, of a doubtful name, and the least share of a page's text that a named article has,
#: and one of several paragraphs; width of the smoothing, and how fast it falls off in the tree; share of the content's score that the article holds.
PRIOR, DOUBT, NAMED, LONG_NAMED = 0.05, 0.5, 0.04, 0.01
SMOOTH, NEAR, HOLD = 1.0, 4, 0.8
#: Elements too small to be an article.
PARTS = HEADINGS | {"p", "li", "td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "pre", "blockquote", "ul", "ol", "dl", "table", "caption", "figcaption"}
WHOLE = {"#", "html", "body"}


class Element:
    """`out` counts the elements, from the root to this one, that the prior speaks against, `doubt` those of a doubtful name;
    `path` numbers its block tags."""

    __slots__ = ("tag", "parent", "number", "depth", "path", "out", "doubt", "linked", "hidden", "in_article", "paragraph")

    def __init__(self, tag: str, parent, number: int, path: int):
        self.tag, self.parent, self.number, self.path = tag, parent, number, path
        self.out, self.doubt, self.linked, self.hidden, self.in_article, self.paragraph, self.depth = 0, 0, False, False, tag in ("article", "main"), None, 0
        if parent is not None:
            self.doubt = parent.doubt
            self.out, self.linked, self.hidden, self.in_article = parent.out, parent.linked or tag == "a", parent.hidden or tag in HIDDEN, parent.in_article or self.in_article
            # The open paragraph that a block would end.
            self.paragraph = self if tag == "p" else None if tag in SCOPE else parent.paragraph
            self.depth = parent.depth + (tag in BLOCKS)


def _marks(tag: str, words: list[str]) -> float:
    """How far the words of a class or id name what is no part of an article: 1 where they say nothing else, DOUBT where such
    a word opens or ends them beside others, 0 if none does. States and categories do not count."""
    if not words or words[0] in STATES:
        return 0
    if tag == "article":
        return float(not OTHER_ARTICLE.isdisjoint(words))
    if words[0] not in MARKS and words[-1] not in MARKS:
        return 0
    return 1 if all(w in MARKS or w in PLAIN or len(w) <= 2 for w in words) and not {"of", "in", "to", "on", "at", "by"} & set(words) else DOUBT


def _traits(tag: str, attributes: str, parent: Element) -> tuple[float, bool]:
    """How far the prior speaks against an element (1, DOUBT or 0), and whether a browser would not show it."""
    if tag in OUTSIDE or (tag == "header" and not parent.in_article):
        return 1, False
    if not attributes or tag in ("html", "body", "main"):
        return 0, False
    against = 0.0
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name in ("class", "id"):
            against = max([against, *(_marks(tag, [w.lower() for w in WORD.findall(v)]) for v in value.split())])
        if name == "role" and value.lower() in ROLES and tag != "article":
            against = 1
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            return 0, True
    return against, False


class Tags:
    """Where the tags of a page end. Quotes that never close would make each tag read to the end of the page; from the first
    such tag on, ends come from one backward pass over quotes and brackets, and failing that are the next bracket."""

    def __init__(self, page: str):
        self.page, self.marks, self.ends = page, None, None

    def rest(self, at: int) -> tuple[str, int] | None:
        """The text up to the tag's end and the place behind it; None if no tag ends any more."""
        if self.marks is None:
            m = REST.match(self.page, at)
            if m:
                return m[1], m.end()
            self.marks = [(m.start(), m[0]) for m in re.compile("[>\"']").finditer(self.page, at)]
            self.ends, after = [-1] * (len(self.marks) + 1), {">": -1, '"': -1, "'": -1}
            self.brackets = [-1] * (len(self.marks) + 1)
            for k in range(len(self.marks) - 1, -1, -1):
                place, mark = self.marks[k]
                self.ends[k] = place if mark == ">" else -1 if after[mark] < 0 else self.ends[after[mark] + 1]
                self.brackets[k] = place if mark == ">" else self.brackets[k + 1]
                after[mark] = k
        k = bisect_left(self.marks, (at, ""))
        end = self.ends[k] if self.ends[k] >= 0 else self.brackets[k]
        return None if end < 0 else (self.page[at:end], end + 1)


def blocks(page: str) -> tuple[list[Element], list[tuple[Element, str, int]]]:
    """All elements, parents first, and (element, text, characters inside links) of each block, in page order."""
    root = Element("#", None, 0, 0)
    elements, paths, here, at, out = [root], {}, root, 0, []
    opened: dict[str, int] = {}
    parts: list[tuple[str, bool]] = []
    owner, tags, size = root, Tags(page), len(page)

    def flush() -> None:
        nonlocal parts
        if parts:
            text = SPACES.sub(" ", "".join(p for p, _ in parts)).strip()
            if text:
                out.append((owner, text, sum(len(p.strip()) for p, linked in parts if linked)))
            parts = []

    def say(raw: str) -> None:
        nonlocal owner
        if raw and not here.hidden:
            if not parts:
                owner = here
            parts.append((entities.unescape(raw), here.linked))

    def leave(e: Element) -> None:
        """Closes all elements down to e, and e."""
        nonlocal here
        while here is not e.parent:
            opened[here.tag] -= 1
            here = here.parent

    def close(names: set, scope: set) -> None:
        if not any(opened.get(n) for n in names):
            return
        e = here
        while e is not root and e.tag not in names:
            if e.tag in scope:
                return
            e = e.parent
        if e is not root:
            leave(e)

    while at < size:
        start = page.find("<", at)
        if start < 0:
            say(page[at:])
            break
        say(page[at:start])
        m = NAME.match(page, start)
        if not m:
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                at = size if end < 0 else end + 3
            elif page.startswith("<![CDATA[", start):
                end = page.find("]]>", start)
                say(entities.escape(page[start + 9 : size if end < 0 else end]))
                at = size if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), start):
                at = page.find(">", start) + 1 or size
            else:
                say("<")
                at = start + 1
            continue
        found = tags.rest(m.end())
        if found is None:
            say(page[start:])
            break
        attributes, at = found
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCKS:
                flush()
            if opened.get(tag):
                e = here
                while e.tag != tag:
                    e = e.parent
                leave(e)
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in RAW:
            end = RAW_END[tag].search(page, at)
            at = end.start() if end else size
            if end:
                at = page.find(">", at) + 1 or size
            continue
        if tag in BLOCKS:
            flush()
            if here.paragraph is not None:
                leave(here.paragraph)
        if tag in HEADINGS and here.tag in HEADINGS:
            leave(here)
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in ("body", "main", "article"):
            close({"head"}, set())
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in BLOCKS and tag not in ("a", "b", "i", "em", "strong", "span"):
            continue
        path = paths.setdefault((here.path, tag), len(paths) + 1) if tag in BLOCKS else here.path
        e = Element(tag, here, len(elements), path)
        against, unseen = _traits(tag, attributes, here)
        e.out, e.doubt, e.hidden = e.out + (against == 1), e.doubt + (against == DOUBT), e.hidden or unseen
        elements.append(e)
        opened[tag] = opened.get(tag, 0) + 1
        here = e
    flush()
    return elements, out


def _nearness(a: Element, b: Element) -> float:
    """How much of their way from the root two blocks share, 1 for blocks of one element."""
    longer = max(a.depth, b.depth)
    while a is not b:  # parents are numbered before their children
        if a.number > b.number:
            a = a.parent
        else:
            b = b.parent
    return (a.depth + 1) / (longer + 1)


def named_article(elements: list[Element], found: list[tuple[Element, str, int]]) -> set[int]:
    """Numbers of the <article> with most text outside links, or else the <main>, and of what it holds; with it go others of
    its kind beside it. Empty if the page has none that the prior does not speak against, or none with enough text."""
    base = min(e.out for e, _, _ in found)
    own, many, said = [0] * len(elements), [0] * len(elements), 0
    for e, text, linked in found:
        if e.out == base:
            said += max(0, len(text) - linked)
            if e.tag not in HEADINGS:
                own[e.number] += max(0, len(text) - linked)
                many[e.number] += 2 * linked < len(text)
    for e in reversed(elements[1:]):
        own[e.parent.number] += own[e.number]
        many[e.parent.number] += many[e.number]
    for tag in ("article", "main"):
        some = [e for e in elements if e.tag == tag and e.out == base and own[e.number] and own[e.number] >= (NAMED if many[e.number] < 2 else LONG_NAMED) * said]
        if some:
            best = max(some, key=lambda e: (own[e.number], -e.number))
            held = {e.number for e in some if e.parent is best.parent and e.path == best.path}
            for e in elements[1:]:
                if e.parent.number in held:
                    held.add(e.number)
            return held
    return set()


def ratios(found: list[tuple[Element, str, int]], paths: list[tuple]) -> list[float]:
    """The two ratios of each block's tag path, length and punctuation to nodes, smoothed and fused."""
    sums: dict[tuple, list] = {}
    for p, (_, text, linked) in zip(paths, found, strict=True):
        s = sums.setdefault(p, [0, 0, 0])
        s[0] += max(0, len(text) - linked)
        s[1] += len(PUNCTUATION.findall(text)) if 2 * linked <= len(text) else 0
        s[2] += 1
    length, points = ([sums[p][k] / sums[p][2] for p in paths] for k in (0, 1))
    side = math.exp(-1 / (2 * SMOOTH * SMOOTH))
    weight = [side * _nearness(a[0], b[0]) ** NEAR for a, b in zip(found[:-1], found[1:], strict=True)]

    def smooth(x: list[float]) -> list[float]:
        out = []
        for i, v in enumerate(x):
            before, after = weight[i - 1] if i else 0.0, weight[i] if i < len(weight) else 0.0
            out.append((v + (before * x[i - 1] if i else 0.0) + (after * x[i + 1] if i < len(weight) else 0.0)) / (1 + before + after))
        return out

    # Where a block says nothing itself, the neighbours' ratios do not lift it.
    return [math.sqrt(a * (1 + b)) if n else 0.0 for a, b, n in zip(smooth(length), smooth(points), length, strict=True)]


def scores(found: list[tuple[Element, str, int]]) -> list[float]:
    """Each block's ratio weighted by the prior; the mean over the path's blocks, which stand or fall together."""
    # Elements that the prior speaks against, more than against the whole page, do not share sums with others of their path.
    base = min(e.out for e, _, _ in found)
    paths = [(e.path, e.out > base, e.doubt > 0) for e, _, _ in found]
    fused = [r * (PRIOR if e.out > base else DOUBT if e.doubt else 1.0) for r, (e, _, _) in zip(ratios(found, paths), found, strict=True)]
    sums: dict[tuple, list] = {}
    for p, r in zip(paths, fused, strict=True):
        s = sums.setdefault(p, [0.0, 0])
        s[0], s[1] = s[0] + r, s[1] + 1
    return [sums[p][0] / sums[p][1] for p in paths]


def threshold(ratio: list[float]) -> float:
    """The least score of the upper side, where the variance between the two sides is largest; blocks that say nothing
    themselves are left out. The score itself if all are alike, 0 if all say nothing."""
    order = sorted(r for r in ratio if r > 0 or min(ratio) < 0)
    total, below, best, at = sum(order), 0.0, 0.0, order[0] if order else 0.0
    for k in range(1, len(order)):
        below += order[k - 1]
        if order[k] - order[k - 1] > 1e-9:
            gap = (total - below) / (len(order) - k) - below / k
            if (gain := k * (len(order) - k) * gap * gap) > best:
                best, at = gain, order[k]
    return at


def _ancestors(e: Element) -> Iterator[Element]:
    while e is not None:
        yield e
        e = e.parent


def main_text(page: str | None) -> str:
    """The article's blocks joined by line ends; empty if there are none. Null counts as empty."""
    elements, found = blocks(page or "")
    if not found:
        return ""
    # A page all of which is a menu or the like has no article; a form may hold a whole page, and then menus in it.
    levels = {e.out for e, _, _ in found}
    if levels == {1} and not any(a.tag == "form" for a in _ancestors(found[0][0])):
        return ""
    named = named_article(elements, found)
    if named:
        least, first = min(levels), min(named)
        roots = {elements[n].parent for n in named if elements[n].parent.number not in named}
        for e in elements:
            title = e.tag in HEADINGS and e.number < first and e.out == least and e.parent in roots
            e.out += e.number not in named and not title
        levels = {e.out for e, _, _ in found}
    ratio = scores(found)
    bar = threshold(ratio)
    passed = [r >= bar and (bar != 0 or e.out == min(levels)) for r, (e, _, _) in zip(ratio, found, strict=True)]
    # The score that each element holds, its own blocks' and those below it.
    mass = [0.0] * len(elements)
    for (e, _, _), r, own in zip(found, ratio, passed, strict=True):
        if own:
            mass[e.number] += r
    for e in reversed(elements[1:]):
        mass[e.parent.number] += mass[e.number]
    article, inside = elements[0], [True] * len(elements)
    for e in elements[1:]:
        if e.parent is article and mass[e.number] >= HOLD * mass[0] and e.tag not in PARTS:
            article = e
    for e in elements:
        inside[e.number] = e is article or (e.parent is not None and inside[e.parent.number])
    is_whole, most = article.tag in WHOLE, min(levels) if named else article.out
    # Blocks between content nodes belong to a page without an element for its article; of links, those of the same parent.
    ends: dict[Element | None, list] = {}
    for k, ((e, _, _), own) in enumerate(zip(found, passed, strict=True)):
        if own:
            ends.setdefault(e.parent, [k, k])[1] = ends.setdefault(None, [k, k])[1] = k
    kept: list[bool] = []
    for k, ((e, text, linked), own) in enumerate(zip(found, passed, strict=True)):
        first, last = ends.get(e.parent if 2 * linked > len(text) else None, (k, k))
        within = inside[e.number] and e.out <= most and (not is_whole or first < k < last)
        kept.append(own or within)
    for k in range(len(found) - 2, -1, -1):  # headings right above what stays, of the same parent or above its element
        e, below = found[k][0], found[k + 1][0]
        kept[k] = kept[k] or (e.tag in HEADINGS and kept[k + 1] and e.out <= most and (e.parent is below.parent or bool(named) and below.number in named))
    return "\n".join(text for (_, text, _), own in zip(found, kept, strict=True) if own)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row. No shuffle; memory is bounded by one page's blocks and a batch of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in strings(batch.column("html"))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
