"""Cleaning and measuring of text. Space means Unicode white space throughout, as for Python's str methods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Patterns of what cleaning removes.
URL = r"(?i)(https?://\S+|www\.\S+)"
CODE_BLOCK = r"(?s)```.*?```"
LINK = r"\[([^\]]+)\]\([^)]+\)"
INLINE_CODE = r"`([^`]+)`"
LINE_PREFIX = r"(?mU)^[>\s#*\-+]+\s*"
SYMBOLS = r"[*_~]"
EMOJI_RANGES = r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2700}-\x{27BF}\x{1F900}-\x{1F9FF}\x{1FA70}-\x{1FAFF}\x{2600}-\x{26FF}"
EMOJI = f"[{EMOJI_RANGES}]+"
IMAGE_URL = r"\.(jpg|png|gif|jpeg|webp)$"
DELETED = ["[deleted]", "[removed]"]
#: Phrases by which automatic comments are known.
BOT_PHRASES = [
    "your post is getting popular",
    "this post has reached",
    "i am a bot",
    "^beep boop",
    "this action was performed automatically",
    r"^[\*\s]*bot",
    "contact the moderators",
    "^automod",
    "^automoderator",
    "please contact the moderators",
    "if you have any questions or concerns",
]


#: All of Unicode's white space, as \s under (?U) has it.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def or_none(text: Column) -> Column:
    """The stripped text, null if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def strip_markdown(text: Column) -> Column:
    for pattern, by in ((CODE_BLOCK, " "), (LINK, "$1"), (INLINE_CODE, "$1"), (LINE_PREFIX, ""), (SYMBOLS, "")):
        text = F.regexp_replace(text, pattern, by)
    return text


def remove_emojis(text: Column) -> Column:
    return F.regexp_replace(text, EMOJI, "")


def normalize_whitespace(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_text(text: Column) -> Column:
    """URLs, then markdown, then emojis, then white space; null gives an empty text."""
    return normalize_whitespace(remove_emojis(strip_markdown(remove_urls(F.coalesce(text, F.lit(""))))))


def topic_text(title: Column, body: Column, is_self: Column) -> Column:
    """The cleaned title, and below it the cleaned body of a self post that has one."""
    title, body = clean_text(title), clean_text(body)
    return F.when(F.coalesce(is_self, F.lit(False)) & (body != ""), strip(F.concat(title, F.lit("\n"), body))).otherwise(title)


def post_text(topic: Column, title: Column, body: Column) -> Column:
    return F.coalesce(or_none(topic), topic_text(title, body, F.coalesce(body, F.lit("")) != ""))


def first_text(*texts: Column) -> Column:
    """The first text that is not blank, stripped; else empty."""
    return F.coalesce(*map(or_none, texts), F.lit(""))


def estimate_tokens(text: Column, blank_is_zero: bool = False) -> Column:
    tokens = F.greatest(F.lit(1), F.ceil(F.length(F.coalesce(text, F.lit(""))) / 4)).cast("long")
    return F.when(F.coalesce(or_none(text), F.lit("")) == "", F.lit(0).cast("long")).otherwise(tokens) if blank_is_zero else tokens


def word_count(text: Column) -> Column:
    own = or_none(text)
    return F.when(own.isNull(), F.lit(0)).otherwise(F.size(F.split(own, r"(?U)\s+")))


def shorten(text: Column, most: int, keep: int | None = None) -> Column:
    """White space collapsed; a text longer than `most` is cut at `keep` (default: most) and ends in three dots; 0: no limit."""
    text = normalize_whitespace(F.coalesce(text, F.lit("")))
    if not most:
        return text
    cut = F.regexp_replace(F.substring(text, 1, most if keep is None else keep), r"(?U)\s+$", "")
    return F.when(F.length(text) > most, F.concat(cut, F.lit("..."))).otherwise(text)


def trim_text(text: Column, limit: int) -> Column:
    """The text, its first `limit` characters and three dots if it is longer; null gives an empty text."""
    own = F.coalesce(text, F.lit(""))
    return F.when(F.length(own) > limit, F.concat(F.substring(own, 1, limit), F.lit("..."))).otherwise(own)


def title_case(text: Column) -> Column:
    """Parts between underscores, each with its first letter in upper case and the rest as it is."""
    parts = F.split(F.coalesce(text, F.lit("")), "_", -1)
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 2**31 - 1))), " ")


def _or_dash(value: Column, said: Column) -> Column:
    return F.when(value.isNull() | F.isnan(value.cast("double")), "-").otherwise(said)


def format_number(value: Column) -> Column:
    """Thousands with commas, up to three decimals; a dash for none."""
    return _or_dash(value, F.regexp_replace(F.format_number(F.round(value.cast("double"), 3), 3), r"\.?0+$", ""))


def format_percent(value: Column) -> Column:
    """A share in per cent with one decimal; a dash for none."""
    return _or_dash(value, F.format_string("%.1f%%", value.cast("double") * 100))


def format_date_time(at: Column) -> Column:
    """Month, day, hour and minute of a timestamp; a dash for none."""
    return F.coalesce(F.date_format(at, "MMM dd, hh:mm a"), F.lit("-"))


def is_empty(body: Column) -> Column:
    return F.coalesce(body, F.lit("")) == ""


def is_bot(body: Column) -> Column:
    """Whether a comment is automatic; empty ones count as such."""
    own = F.coalesce(body, F.lit(""))
    return is_empty(body) | strip(F.lower(own)).rlike("|".join(f"(?:{p})" for p in BOT_PHRASES))


def is_deleted(text: Column, blank: bool = False) -> Column:
    return strip(F.lower(F.coalesce(text, F.lit("")))).isin(DELETED + ([""] if blank else []))


def has_text(*texts: Column) -> Column:
    found = F.lit(False)
    for t in texts:
        found = found | (F.coalesce(t, F.lit("")) != "")
    return found


def is_image_url(url: Column) -> Column:
    return F.coalesce(F.lower(url).rlike(IMAGE_URL), F.lit(False))


def render(template: str, placeholder: str, value: Column) -> Column:
    """A template with one placeholder filled."""
    return F.replace(F.lit(template), F.lit(placeholder), value)


def string_hash(text: Column) -> Column:
    """The absolute value of a 31-polynomial hash in 32-bit arithmetic over UTF-16 units, pairs beyond the basic plane included."""
    wrap = lambda x: F.when(F.pmod(x, F.lit(2**32)) >= 2**31, F.pmod(x, F.lit(2**32)) - 2**32).otherwise(F.pmod(x, F.lit(2**32)))
    units = F.hex(F.encode(F.coalesce(text, F.lit("")), "UTF-16BE"))
    places = F.when(units != "", F.sequence(F.lit(0), (F.length(units) / 4).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.abs(F.aggregate(places, F.lit(0).cast("long"), lambda h, i: wrap(h * 31 + F.conv(F.substr(units, i * 4 + 1, F.lit(4)), 16, 10).cast("long"))))
