"""Labels, confidences, weights and distributions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from agorascope.functions.text import strip

#: Labels and the words that stand for them.
STANCES = ["agree", "disagree", "neutral"]
SENTIMENTS = ["positive", "negative", "neutral"]
STANCE_WORDS = {"agree": ["favor", "support", "pro", "yes", "for"], "disagree": ["against", "oppose", "con", "no", "anti"], "neutral": ["none"]}
SENTIMENT_WORDS = {"positive": ["pos"], "negative": ["neg"], "neutral": []}


def normalize_label(raw: Column, labels: list[str], words: dict[str, list[str]], unknown: str = "drop") -> Column:
    """The label that a raw one stands for; others are null, or neutral where unknown="neutral". Blank is null.

    One look-up in a literal map, so the raw label is stripped once per row."""
    named = {w: label for label in reversed(labels) for w in [*words.get(label, []), label]}
    table = F.create_map(*[F.lit(x) for pair in named.items() for x in pair])
    own = F.lower(strip(raw))
    found = F.try_element_at(table, own)
    return F.coalesce(found, F.when(own != "", F.lit("neutral"))) if unknown == "neutral" else found


def stance(raw: Column, unknown: str = "drop") -> Column:
    return normalize_label(raw, STANCES, STANCE_WORDS, unknown)


def sentiment(raw: Column, unknown: str = "drop") -> Column:
    return normalize_label(raw, SENTIMENTS, SENTIMENT_WORDS, unknown)


def parse_float(raw: Column) -> Column:
    return strip(raw.cast("string")).try_cast("double")


def clamp(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def confidence(*raw: Column, numbers: bool = False) -> Column:
    """The first that is a number, within [0, 1]; 1 if there is none. numbers: the columns are numeric already."""
    given = [r.cast("double") if numbers else parse_float(r) for r in raw]
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(*given, F.lit(1.0))))


def compute_weight(score: Column, conf: Column) -> Column:
    votes = F.greatest(F.lit(0.0), F.coalesce(score.cast("double"), F.lit(0.0)))
    return (1 + F.log1p(votes)) * (0.5 + 0.5 * conf)


def polarization(agree: Column, disagree: Column, neutral: Column) -> Column:
    sides = F.greatest(agree + disagree, F.lit(1e-9))
    return clamp((1 - neutral) * (1 - F.abs(agree - disagree) / sides), 0.0, 1.0)


def dominant(agree: Column, disagree: Column, neutral: Column) -> Column:
    """The largest of three; ties go to agree, then to disagree."""
    return F.when((agree >= disagree) & (agree >= neutral), "agree").when((disagree >= agree) & (disagree >= neutral), "disagree").otherwise("neutral")


def missing_labels(first: Column, second: Column, mode: str = "both") -> Column:
    """Whether both, or either, of two labels are null or empty."""
    a, b = (F.coalesce(x, F.lit("")) == "" for x in (first, second))
    if mode not in ("both", "either"):
        raise ValueError(f"unknown mode: {mode}")
    return a & b if mode == "both" else a | b


def known(label: Column, unclear: bool = True) -> Column:
    """A label with null, and the unclear one where asked for, as unknown."""
    out = F.coalesce(label, F.lit("unknown"))
    return F.when(out == "unclear", F.lit("unknown")).otherwise(out) if unclear else out


def nli_stance(favor: Column, against: Column, neutral: Column, least: float = 0.55) -> Column:
    """The stance of the largest score, NONE if it is below `least`; ties in this order."""
    top = F.greatest(favor, against, neutral)
    return F.when(top < least, "NONE").when(favor == top, "FAVOR").when(against == top, "AGAINST").otherwise("NONE")
