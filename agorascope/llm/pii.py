"""Personal data by candidates and gradient boosting, in DataFrame functions only.

Base kinds (email, ip, card, phone) are found by fixed patterns and always stay. Beyond them, generators of high recall
propose overlapping spans (tel, ssn, iban, secret, mail); boosted trees score each by its format, its shape as a link, path, name,
digest or number of something, the check digits of accounts, and CONTEXT characters on either side, spans at or above their kind's calibrated threshold are selected, those furthest above it first where they
overlap. The trees are fitted on the driver to SAMPLE labelled candidates made by rule from a fixed seed (no table holds
such labels), thresholds to as many others, and both run as column expressions. Tests of whole texts only spare work: each
holds wherever its generator matches, so no span depends on what stands elsewhere in a text.

Positions are code points, end exclusive. Null texts count as empty and have no spans; ids are carried; repeated rows
get equal rows; other columns are not used or changed. Patterns use possessive groups, so very long runs of digits,
labels or letters neither overflow the stack nor cost more than their length.
"""

from __future__ import annotations

import functools
import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.llm.boosting import Boosted, calibrated

BASE = ["email", "ip", "card", "phone"]
ADDED = ["tel", "ssn", "iban", "secret", "mail"]
#: A match starts where a run of its first class starts, or where the last match ended.
_LOCAL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++"
PATTERNS = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A sign in brackets, or a dot as a word, in brackets or between blanks: plain "at" and a full stop are prose.
_AT = r" ?(?:\(at\)|\[at\]) ?"
_DOT = r"(?: ?(?:\(dot\)|\[dot\]) ?| dot | \. )"
_LABEL = r"[A-Za-z0-9-]++"
GENERATORS = {
    "tel": r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?[ ./-]{1,2}[0-9]{3,4}[ ./-][0-9]{3,5}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}[ -][0-9]{2}[ -][0-9]{4}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "secret": r"(?<![A-Za-z0-9_])(?:(?i:password|passwd|pwd|secret|token|api_?key)\s{0,2}[=:]\s{0,2}[\"']?[^\s\"'<>]{4,}+|[A-Za-z0-9_+/=-]{16,}+)",
    "mail": rf"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++(?:{_AT}{_LABEL}(?:(?:{_DOT}|\.){_LABEL})++| at {_LABEL}(?:\.{_LABEL})*+{_DOT}{_LABEL}(?:(?:{_DOT}|\.){_LABEL})*+)",
}
HINTS = {
    "call": r"(?i)(?:tel|phone|call|fax|mobile|cell|whatsapp|rufnummer|t[eé]l[eé]fono?)",
    "mail": r"(?i)(?:mail|contact|write|reach)",
    "secret": r"(?i)(?:password|passwd|pwd|secret|token|key|credential)",
    "tax": r"(?i)(?:ssn|social|iban|account|bank|konto|tax|id)",
    "goods": r"(?i)(?:version|order|invoice|part|isbn|item|model|build|price|date|page|no\.|case|docket|court|serial|article|population|total|number of|figure|about|some|nearly)",
    "digest": r"(?i)(?:commit|sha-?[0-9]*|md5|hash|checksum|digest|rev(?:ision)?|blob|uuid|guid|session|etag)[\s:=#]*$",
    "link": r"(?:://|www\.)[^\s\"'<>]*$",
    "sign": r"[=#_/\\]$",
}
#: What the value itself says: joined words, a path, camel case, hexadecimal digits, a UUID, groups of digits, an assignment, a label
#: and what stands behind it.
SHAPES = {
    "words": r"^[A-Za-z]+(?:[-_/][A-Za-z]+)*$",
    "path": r"/[^/]*/|^[a-z]+/|/[a-z]+$",
    "hex": r"^(?:[0-9a-f]+|[0-9A-F]+)$",
    "uuid": r"^[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$",
    "groups": r"^[0-9]+(?:[ -][0-9]+)+$",
    "assigned": r"^[A-Za-z_]{1,12}=",
    "equals": r"^(?i:password|passwd|pwd|secret|token|api_?key)=",
    "said": r"^(?i:password|passwd|pwd|secret|token|api_?key)\s{0,2}[=:]\s{0,2}[\"']?[^\s]*[0-9]",
    "place": r" at (?:this|that|these|those|the|a|an|it|noon|night|home|work|school|once|last|least|first|all|any|one|two|my|his|her|their|our|your|me|him|them|us|some|which|what|peace|war|sea|hand|end|times?|random|polka)\b",
    "blank_dot": r" \. ",
    "trunk": r"^\(?0",
    "thousands": r"^[0-9]{3}[ -][0-9]{3}[ -][0-9]{3}$",
    "camel": r"^[A-Z]?[a-z]++(?:[A-Z][a-z]++)++$",
}
#: Openings of access keys of well-known services.
KEYS = r"^(?:AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|sk-|sk_live_|xox[abprs]-|eyJ)[A-Za-z0-9_-]{12}"
#: Holds for every text in which the generator of mail matches: its core, from the sign on.
MAILED = rf"{_AT}[A-Za-z0-9-]| at {_LABEL}(?:\.{_LABEL})*+{_DOT}[A-Za-z0-9-]"
#: Ends of addresses: domains of the world and of countries with many sites. Fixed values.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|co|me|tv|app|dev|eu|uk|us|ca|au|de|at|ch|fr|be|nl|lu|es|pt|it|pl|cz|se|no|dk|fi|ie|gr|ru|ua|tr|il|in|cn|jp|kr|br|mx|ar|za"
ENDED = rf"(?i)(?:[ .)\]])(?:{DOMAINS})$"
SIGNED = r"\(at\)|\[at\]"
SPELLED = r"\(dot\)|\[dot\]| dot "
SAMPLE, PRECISION = 6000, 0.99
CONTEXT = 40
SPAN = "array<struct<kind:string,start:int,end:int>>"


def _once(value: Column, f) -> Column:
    """Binds a costly value for a lambda, so it is computed once."""
    return F.transform(F.array(value), f)[0]


def found(text: Column, pattern: str, kind: str) -> Column:
    """(kind, start, end, value) of the leftmost non-overlapping matches, from the pieces between them."""
    empty = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.when(x["m"].isNull(), acc["all"]).otherwise(F.concat(acc["all"], F.array(span))).alias("all"))

    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("all")), step)["all"]


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits passes Luhn's check."""
    def step(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str):
    octet = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
    if kind == "ip":
        return lambda s: s["value"].rlike(rf"^{octet}(?:\.{octet}){{3}}$")
    if kind == "card":
        digits = lambda s: F.regexp_replace(s["value"], r"[^0-9]", "")
        return lambda s: F.when(F.length(digits(s)).between(13, 19), luhn(digits(s))).otherwise(F.lit(False))
    if kind == "phone":
        return lambda s: F.length(F.regexp_replace(s["value"], r"[^0-9]", "")).between(9, 15)
    return None


def base_spans(text: Column, kind: str) -> Column:
    """Valid spans of a base kind; a cheap test of the text comes first."""
    need = {"email": F.contains(text, F.lit("@")), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"), "phone": text.rlike(r"\+[0-9]")}[kind]
    spans = found(text, PATTERNS[kind], kind)
    if test := _valid(kind):
        spans = F.filter(spans, test)
    return F.when(need, spans.cast(SPAN_VALUE)).otherwise(F.array().cast(SPAN_VALUE))


SPAN_VALUE = "array<struct<kind:string,start:int,end:int,value:string>>"


def iban_valid(value: str) -> bool:
    """Whether the check digits of an account number fit: its characters, the first four last, are 1 modulo 97."""
    v = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def iban_valid_column(value: Column) -> Column:
    v = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(v, F.lit(5), F.length(v)), F.substr(v, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def features(value: str, before: str, after: str, kind: str) -> list[float]:
    """The features of a candidate in Python, for fitting; feature_columns() are their twins."""
    import re

    n = max(1, len(value))
    count = lambda p: len(re.findall(p, value, re.A))
    return [
        *(float(kind == k) for k in ADDED), float(len(value)), count(r"[0-9]") / n, count(r"[A-Z]") / n, count(r"[a-z]") / n, float(count(r"[ ./()-]")), float(count(r"-")), float(count(r"\.")), float(len(set(value))),
        float(count(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])")), *(float(bool(re.search(p, before, re.A))) for p in HINTS.values()), float(bool(re.search(HINTS["secret"] + r"\s{0,2}[=:]", value, re.A))), float(bool(re.search(KEYS, value))), float(bool(re.search(r"[$€£#]\s?$", before, re.A))), float(bool(re.search(r"^\s?[%€$]", after, re.A))), *(float(bool(re.search(p, value, re.A))) for p in (ENDED, SIGNED, SPELLED)),
        *(float(bool(re.search(p, value, re.A))) for p in SHAPES.values()), float(count(r"[a-z](?=[A-Z])")), float(count("/")), float(kind == "iban" and iban_valid(value)),
    ]


def feature_columns(value: Column, before: Column, after: Column, kind: Column) -> list[Column]:
    n = F.greatest(F.length(value), F.lit(1))
    count = lambda p: F.regexp_count(value, F.lit(p)).cast("double")
    flag = lambda c: c.cast("double")
    return [
        *(flag(kind == k) for k in ADDED), F.length(value).cast("double"), count(r"[0-9]") / n, count(r"[A-Z]") / n, count(r"[a-z]") / n, count(r"[ ./()-]"), count(r"-"), count(r"\."), F.size(F.array_distinct(F.split(value, ""))).cast("double"),
        count(r"[0-9](?=[A-Za-z])|[A-Za-z](?=[0-9])"), *(flag(before.rlike(p)) for p in HINTS.values()), flag(value.rlike(HINTS["secret"] + r"\s{0,2}[=:]")), flag(value.rlike(KEYS)), flag(before.rlike(r"[$€£#]\s?$")), flag(after.rlike(r"^\s?[%€$]")), *(flag(value.rlike(p)) for p in (ENDED, SIGNED, SPELLED)),
        *(flag(value.rlike(p)) for p in SHAPES.values()), count(r"[a-z](?=[A-Z])"), count("/"), flag(F.when(kind == "iban", iban_valid_column(value)).otherwise(F.lit(False))),
    ]


def labelled(n: int = SAMPLE, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Labelled candidates made by rule: personal data in usual formats and contexts, and what merely looks alike: links, paths,
    names in code, digests, numbers of books and cases, counts, and prose with "at" and "dot" in it."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    a = lambda k, s="abcdefghijklmnopqrstuvwxyz": "".join(r.choice(s) for _ in range(k))
    upper, mixed, hexa = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "0123456789abcdef"
    plain = lambda: r.choice(["", "and the ", "of a ", "we saw ", "in ", a(5) + " " + a(3) + " "])
    end = lambda: r.choice(DOMAINS.split("|"))
    word = lambda: a(r.randint(3, 9))
    words = lambda k, by: by.join(word() for _ in range(k))
    place = lambda: r.choice(["this", "that", "the", "noon", "home", "work", "last", "a", "night", "once", "all", "random"])
    label = lambda: r.choice(["password", "passwd", "pwd", "token", "api_key", "apikey", "secret", "Password", "TOKEN"])
    say = {"tel": ["call ", "tel: ", "phone ", "mobile: ", "fax "], "ssn": ["ssn ", "social security ", "tax id ", "his ssn is "], "iban": ["iban ", "account ", "bank: ", "IBAN: "], "secret": ["key ", "token ", "the key is "], "mail": ["mail me ", "contact ", "reach me: ", "write to "]}
    other = ["order ", "version ", "part no. ", "page ", "$", "case no. ", "docket ", "isbn ", "population of ", "total ", "serial "]

    def account(k: int, valid: bool) -> str:
        body, land = d(k), a(2, upper)
        check = f"{98 - int(body + str(int(land[0], 36)) + str(int(land[1], 36)) + '00') % 97:02}" if valid else d(2)
        whole = land + check + body
        return r.choice([whole, " ".join(whole[i : i + 4] for i in range(0, len(whole), 4))])

    # Each gives what is found, and before it what must or may stand there; None leaves the choice to the kind.
    good = {
        "tel": [lambda: (f"({d(3)}) {d(3)}-{d(4)}", None), lambda: (f"{d(3)}-{d(3)}-{d(4)}", None), lambda: (f"0{d(2)} {d(4)} {d(4)}", None), lambda: (f"{d(3)}.{d(3)}.{d(4)}", None), lambda: (f"{d(3)} {d(3)} {d(4)}", r.choice(say["tel"])), lambda: (f"{d(3)} {d(4)} {d(4)}", r.choice(say["tel"]))],
        "ssn": [lambda: (f"{d(3)}-{d(2)}-{d(4)}", None), lambda: (f"{d(3)} {d(2)} {d(4)}", r.choice(say["ssn"]))],
        "iban": [lambda: (account(r.choice([14, 16, 18, 20]), True), None), lambda: (account(r.choice([16, 18]), False), r.choice(say["iban"]))],
        "secret": [
            lambda: (label() + r.choice(["=", ": ", ":", " = "]) + r.choice(["", '"']) + a(r.randint(8, 40), mixed) + d(2), None), lambda: (label() + "=" + a(r.randint(6, 24)), None), lambda: (label() + r.choice([": ", "=", " = "]) + word() + d(r.randint(1, 4)), None), lambda: (label() + r.choice([' = "', "=", ": "]) + a(r.choice([32, 40, 64]), hexa), None),
            lambda: ("AKIA" + a(16, upper + "234567"), None), lambda: ("ghp_" + a(36, mixed), None), lambda: ("sk-" + a(r.randint(24, 48), mixed), None), lambda: ("AIza" + a(35, mixed), None), lambda: (a(r.randint(28, 44), mixed), None), lambda: (a(r.choice([32, 40]), hexa), r.choice(say["secret"])), lambda: (a(r.randint(18, 30), mixed), r.choice(say["secret"])),
        ],
        "mail": [lambda: (f"{word()} [at] {word()} [dot] {end()}", None), lambda: (f"{word()}(at){word()}.{end()}", None), lambda: (f"{a(4)}.{a(5)} at {word()} dot {end()}", None), lambda: (f"{word()} at {word()} dot {end()}", r.choice(say["mail"])), lambda: (f"{word()} at {word()} dot {a(4)} dot {end()}", None), lambda: (f"{word()} at {word()} (dot) {end()}", None), lambda: (f"{word()} at {word()} . {end()}", r.choice(say["mail"])), lambda: (f"{word()} [at] {word()} dot {a(r.randint(2, 5))}", None)],
    }
    bad = {
        "tel": [lambda: (f"{d(4)}-{d(4)}-{d(3)}", None), lambda: (f"19{d(2)}-{d(4)}-{d(4)}", None), lambda: (f"{d(2)}/{d(3)}/{d(4)}", None), lambda: (f"{d(2)} {d(3)} {d(3)}", None), lambda: (f"{r.choice('123456789')}{d(2)} {d(4)} {d(4)}", None), lambda: ("-".join(d(3) for _ in range(3)), None), lambda: (f"{r.choice('123456789')}{d(2)} {d(3)} {d(4)}", r.choice(["population of ", "total ", "about ", ""])), lambda: (f"{d(4)}-{d(4)}-{d(4)}", r.choice(["x=", "id_", "no. ", "#", ""])), lambda: (f"{d(3)}-{d(3)}-{d(4)}", r.choice(["part ", "order ", "serial "]))],
        "ssn": [lambda: (f"{d(3)} {d(2)} {d(4)}", None), lambda: (f"{d(3)}-{d(2)}-{d(4)}", r.choice(["case no. ", "docket ", "court file ", "order ", "part ", "case ", "item "]))],
        "iban": [lambda: (f"{a(2, upper)}{d(2)} {a(4, upper)} {a(4, upper)}", None), lambda: (account(r.choice([8, 12, 16]), False), None)],
        "secret": [
            lambda: (a(r.randint(16, 30)), None), lambda: (words(r.randint(3, 7), "-"), None), lambda: (words(r.randint(3, 5), "_"), None), lambda: (a(1, upper) + a(r.randint(15, 28)), None), lambda: ("=" * r.randint(16, 80), None), lambda: ("-" * r.randint(16, 80), None), lambda: (a(r.randint(16, 40), upper), None), lambda: (d(r.randint(16, 20)), None),
            lambda: (words(r.randint(3, 6), "/"), r.choice(["", "./", "https://example."])), lambda: ("/" + words(r.randint(2, 5), "/") + r.choice(["", d(1), "/" + d(4)]), None), lambda: (f"{end()}/{word()}/20{d(2)}/{d(2)}/{words(4, '-')}", r.choice(["https://www.", "see https://" + word() + "."])), lambda: (f"{end()}/{word()}/{a(r.randint(8, 30), mixed)}", "http://" + word() + "."),
            lambda: (a(r.choice([32, 40, 64]), hexa), r.choice(["commit ", "sha256: ", "md5 ", "hash ", "checksum: ", ""])), *[lambda: ("-".join(a(k, r.choice([hexa, hexa + "0123456789" * 3])) for k in (8, 4, 4, 4, 12)), r.choice([None, "uuid: ", "id "]))] * 2, lambda: ("".join(x.title() for x in words(r.randint(3, 8), " ").split()), None), lambda: (word() + "".join(x.title() for x in words(r.randint(3, 8), " ").split()), r.choice([None, "call "])),
            lambda: (f"97{r.choice('89')}-{d(1)}-{d(2)}-{d(6)}-{d(1)}", r.choice(["isbn ", "", "ISBN: "])), lambda: (r.choice(["x", "id", "n", "ref"]) + "=" + "-".join(d(4) for _ in range(3)), None), lambda: ("-".join(d(r.randint(2, 5)) for _ in range(4)), None), *[lambda: (r.choice(["Password", "secret", "token", "Token", "Secret", "password"]) + ": " + word(), None)] * 2, lambda: (a(r.randint(16, 24), hexa), None), lambda: (word() + "_" + word() + "_" + d(r.randint(2, 6)), None), lambda: (words(3, "-") + "-" + d(r.randint(1, 4)), None),
        ],
        "mail": [lambda: (f"{word()} at {word()} . {a(1, upper)}{word()}", None), lambda: (f"{word()} at {word()} . {word()}", None), lambda: (f"{word()} at {word()} dot {word()}", None), lambda: (f"{word()} at {place()} dot {r.choice([end(), word()])}", None), lambda: (f"{word()} at {place()} . {r.choice([end(), word()])}", r.choice([None, "we "])), lambda: (f"{word()} at {word()} . {end()}", "")],
    }
    rows, y = [], []
    for _ in range(n):
        kind, is_good = r.choice(ADDED), r.random() < 0.5
        value, must = r.choice((good if is_good else bad)[kind])()
        if must is None:
            must = (r.choice(say[kind]) if r.random() < 0.5 else "") if is_good else (r.choice(other) if r.random() < 0.4 else "")
        rows.append(features(value, plain() + must, r.choice([" ", ". ", ", ", "%" if not is_good and r.random() < 0.3 else " "]) + a(4), kind))
        y.append(float(is_good))
    return np.array(rows), np.array(y)


@functools.lru_cache(1)
def model() -> Boosted:
    return Boosted.fit(*labelled())


@functools.lru_cache(1)
def thresholds() -> dict[str, float]:
    """Per kind, the least score that keeps PRECISION among SAMPLE candidates that the trees were not fitted to."""
    x, y = labelled(SAMPLE, 12)
    score = model().score(x)
    return {k: calibrated(score[x[:, i] > 0], y[x[:, i] > 0], PRECISION) for i, k in enumerate(ADDED)}


def added_spans(text: Column, base: Column) -> Column:
    """Selected candidates that lie outside the base spans; of overlapping ones the best, then the first.

    A secret runs to its end: one that meets base spans is judged by what stands before them, and gives the pieces around."""
    none = F.array().cast(SPAN_VALUE)
    digits, letters = text.rlike(r"[0-9]"), text.rlike(r"[A-Za-z0-9_+/=-]{16}|(?i:password|passwd|pwd|secret|token|api_?key)\s{0,2}[=:]")
    mail = text.rlike(MAILED)
    need = {"tel": digits, "ssn": digits, "iban": digits, "secret": letters, "mail": mail}
    proposed = F.concat(*[F.when(need[k], found(text, p, k).cast(SPAN_VALUE)).otherwise(none) for k, p in GENERATORS.items()])
    apart = lambda s, t: (s["end"] <= t["start"]) | (t["end"] <= s["start"])

    def inner(s: Column) -> Column:
        return F.filter(base, lambda t: ~apart(s, t))

    def head(s: Column) -> Column:
        """The candidate up to the first base span in it; null if that is no candidate."""
        until = F.array_min(F.transform(inner(s), lambda t: t["start"]))
        value = F.substr(text, s["start"] + 1, until - s["start"])
        return F.when(until.isNull(), s["value"]).when((s["kind"] == "secret") & (until > s["start"]) & value.rlike(rf"^{GENERATORS['secret']}$"), value)

    def pieces(s: Column) -> Column:
        starts = F.concat(F.array(s["start"]), F.array_sort(F.transform(inner(s), lambda t: t["end"])))
        ends = F.concat(F.array_sort(F.transform(inner(s), lambda t: t["start"])), F.array(s["end"]))
        around = F.filter(F.arrays_zip(starts.alias("start"), ends.alias("end")), lambda p: p["start"] < p["end"])
        return F.transform(around, lambda p: F.struct(s["kind"].alias("kind"), p["start"].alias("start"), p["end"].alias("end")))

    def scored(s: Column) -> Column:
        stop = s["start"] + F.length(s["value"])
        before = F.substr(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT)))
        after = F.substr(text, stop + 1, F.lit(CONTEXT))
        score = model().column(feature_columns(s["value"], before, after, s["kind"]))
        least = F.try_element_at(F.create_map(*[F.lit(x) for pair in thresholds().items() for x in pair]), s["kind"])
        return F.struct((least - score).alias("loss"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))

    empty = F.array().cast("array<struct<loss:double,start:int,end:int,kind:string>>")

    def choose(acc: Column, s: Column) -> Column:
        return F.when(F.exists(acc, lambda t: ~apart(s, t)), acc).otherwise(F.concat(acc, F.array(s)))

    def select(candidates: Column) -> Column:
        heads = F.transform(candidates, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), head(s).alias("value")))
        free = F.filter(heads, lambda s: s["value"].isNotNull())
        ranked = F.array_sort(F.filter(F.transform(free, scored), lambda s: s["loss"] <= 0))
        return F.aggregate(ranked, empty, choose)

    return F.when(digits | letters | mail, F.flatten(F.transform(_once(proposed, select), pieces)).cast(SPAN)).otherwise(F.array().cast(SPAN))


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds base_spans and added_spans: arrays of (kind, start, end) by kind as listed, then start."""
    docs = docs.withColumn("pii_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    docs = docs.withColumn("base_spans", F.concat(*[base_spans(F.col("pii_text"), k) for k in BASE]))
    docs = docs.withColumn("added_spans", added_spans(F.col("pii_text"), F.col("base_spans")))
    rank = lambda s: F.array_position(F.array(*map(F.lit, ADDED)), s["kind"])
    ordered = F.array_sort(F.transform("added_spans", lambda s: F.struct(rank(s).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    docs = docs.withColumn("added_spans", F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(SPAN))
    return docs.withColumn("base_spans", F.transform("base_spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).cast(SPAN)).drop("pii_text")


def told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = with_spans(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    count = {f"n_{k}": F.size(F.filter("base_spans", _is_kind(k))).cast("long") for k in BASE}
    return rows.select("doc_id", *[c.alias(n) for n, c in count.items()], F.sha2(told(F.col("base_spans")), 256).alias("base_sha256"), told(F.concat("base_spans", "added_spans")).alias("spans"))


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


def redacted(docs: DataFrame, text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows with each span in text_col replaced by <KIND>; overlapping spans become one, named by the first.

    length_col, if given, is set to the new text's code points. Null texts stay null; other columns stay as they are."""
    rows = with_spans(docs.select(F.struct("*").alias("row_"), F.col(text_col).cast("string").alias("text")))
    spans = F.array_sort(F.transform(F.concat("base_spans", "added_spans"), lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("until"), s["kind"].alias("kind"))))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        piece = F.concat(F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        return F.struct(F.greatest(acc["at"], -s["until"]).alias("at"), F.when(fresh, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"))

    folded = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step)
    whole = _once(folded, lambda f: F.concat(F.array_join(f["out"], ""), F.substr(text, f["at"] + 1, F.length(text))))
    clean = F.when(F.size("base_spans") + F.size("added_spans") > 0, whole).otherwise(text)
    rows = rows.select("row_", clean.alias("clean_"))
    new = {text_col: F.col("clean_")} | ({length_col: F.length("clean_").cast("long")} if length_col else {})
    return rows.select(*[new.get(c, F.col("row_").getField(c)).alias(c) for c in docs.columns])
