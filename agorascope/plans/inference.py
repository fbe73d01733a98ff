"""Stances by inference: how a comment stands to its post, from what a model says follows from the two.

The premise is post and comment; two hypotheses say that the commenter supports the post and opposes it. A scorer, a plain function
from (premise, hypothesis) pairs to three numbers each, is called on the workers for batches of pairs; all else is columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What the model reads, and the order of its numbers.
PREMISE = ("POST: ", "\nCOMMENT: ")
HYPOTHESES = {"support": "The commenter supports the post.", "oppose": "The commenter opposes the post."}
OUTCOMES = ("contradiction", "neutral", "entailment")
LEAST = 0.55

Scorer = Callable[[list[tuple[str, str]]], np.ndarray]


def premise(post: Column, comment: Column) -> Column:
    return F.concat(F.lit(PREMISE[0]), F.coalesce(post, F.lit("")), F.lit(PREMISE[1]), F.coalesce(comment, F.lit("")))


def softmax(scores: Column) -> Column:
    """Shares of raw scores; the largest is taken off first, so none overflows."""
    raised = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda a, y: a + y))


def stance_scores(support: Column, oppose: Column, outcomes: tuple[str, ...] = OUTCOMES) -> Column:
    """FAVOR, AGAINST and NONE from the shares of both hypotheses: a stance follows from one or contradicts the other."""
    of = lambda shares, name: F.get(shares, F.lit(outcomes.index(name))) if name in outcomes else F.lit(0.0)
    return F.struct(
        F.greatest(of(support, "entailment"), of(oppose, "contradiction")).alias("FAVOR"),
        F.greatest(of(oppose, "entailment"), of(support, "contradiction")).alias("AGAINST"),
        F.greatest(of(support, "neutral"), of(oppose, "neutral")).alias("NONE"),
    )


def decision(scores: Column, least: float = LEAST) -> Column:
    """label and score: the largest, ties in the order above; a stance below `least` is NONE, with the score of that."""
    top = F.greatest(scores["FAVOR"], scores["AGAINST"], scores["NONE"])
    label = F.when(scores["FAVOR"] == top, "FAVOR").when(scores["AGAINST"] == top, "AGAINST").otherwise("NONE")
    sure = (top >= least) & (label != "NONE")
    return F.struct(F.when(sure, label).otherwise("NONE").alias("label"), F.when(sure, top).otherwise(scores["NONE"]).alias("score"))


def stances(pairs: DataFrame, scorer: Scorer, post: str = "post_text", comment: str = "comment_text", least: float = LEAST, batch: int = 32, outcomes: tuple[str, ...] = OUTCOMES) -> DataFrame:
    """Adds stance_scores, stance and stance_score. The scorer gets `batch` pairs at a time, both hypotheses of a row side by side."""

    @F.pandas_udf("array<array<double>>")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            asked = [(p, h) for p in part for h in HYPOTHESES.values()]
            found = [np.asarray(scorer(asked[i : i + batch]), float) for i in range(0, len(asked), batch)]
            every = np.concatenate(found) if found else np.zeros((0, len(outcomes)))
            yield pd.Series(list(every.reshape(len(part), len(HYPOTHESES), -1).tolist()), index=part.index)

    rows = pairs.withColumn("raw_", scored(premise(F.col(post), F.col(comment))))
    support, oppose = (softmax(F.get("raw_", F.lit(i))) for i in range(2))
    rows = rows.withColumn("stance_scores", stance_scores(support, oppose, outcomes)).withColumn("d_", decision(F.col("stance_scores"), least))
    return rows.select(*pairs.columns, "stance_scores", F.col("d_.label").alias("stance"), F.col("d_.score").alias("stance_score"))


def rule_scorer(pairs: list[tuple[str, str]]) -> np.ndarray:
    """A stand-in that needs no model: numbers by letters of the premise and the length of the hypothesis."""
    return np.array([[p.count("e") % 7 / 2, len(p) % 5 / 2, (p.count("a") + len(h)) % 7 / 2] for p, h in pairs], float).reshape(-1, 3)
