"""Distributions per post as a stateful fold: comments come in any order, late, twice and corrected.

State per post: the sums of weights by label, and for each recent comment what it has added. A row with a known comment takes
the comment's old share back before it adds the new one, so a relabelled or re-weighted comment counts once, as it is now. Of two
rows of one comment that of the later change wins, whichever comes first. When the watermark has passed a comment's last change by
the correction time, its entry goes and its share stays in the sums: state is bounded by the comments of that time, and a change
of such an old comment is not known for one and would count twice, so it is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from agorascope.functions import labels
from agorascope.operators.weights import with_weight

KINDS = [f"stance_{k}" for k in labels.STANCES] + [f"sentiment_{k}" for k in labels.SENTIMENTS]
SUMS = ", ".join([*(f"{k} double" for k in KINDS), *(f"n_{k} long" for k in KINDS)])
SHARE = "stance string, sentiment string, weight double, changed long"
OUT = "post_id string, agree double, disagree double, neutral double, positive double, negative double, neutral_sentiment double, polarization_score double, stance_count long, sentiment_count long"
#: A state store that the processor needs.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def distribution(post_id: str, sums: dict[str, float], counts: dict[str, int], min_comments: int = 5) -> tuple:
    """A row of OUT from sums and counts per label, as weights.post_distribution has it."""
    shares, n = {}, {}
    for kind, names in (("stance", labels.STANCES), ("sentiment", labels.SENTIMENTS)):
        total = sum(sums[f"{kind}_{k}"] for k in names if counts[f"{kind}_{k}"])
        n[kind] = sum(counts[f"{kind}_{k}"] for k in names)
        for k in names:
            shares[f"{kind}_{k}"] = (sums[f"{kind}_{k}"] if counts[f"{kind}_{k}"] else 0.0) / total if total > 0 else None
    agree, disagree, neutral = (shares[f"stance_{k}"] for k in labels.STANCES)
    polar = None
    if n["stance"] >= min_comments and agree is not None:
        polar = min(1.0, max(0.0, (1 - neutral) * (1 - abs(agree - disagree) / max(agree + disagree, 1e-9))))
    return (post_id, *shares.values(), polar, n["stance"], n["sentiment"])


class Fold(StatefulProcessor):
    """The fold of one post; see the module."""

    def __init__(self, keep_ms: int, min_comments: int):
        self.keep_ms, self.min_comments = keep_ms, min_comments

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", SUMS)
        self.shares = handle.getMapState("shares", "comment_id string", SHARE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803 Spark's names
        held = self.sums.get() if self.sums.exists() else (0.0,) * len(KINDS) + (0,) * len(KINDS)
        sums, counts = dict(zip(KINDS, held[: len(KINDS)], strict=True)), dict(zip(KINDS, held[len(KINDS) :], strict=True))
        known: dict[str, tuple] = {}
        least = timerValues.getCurrentWatermarkInMs() - self.keep_ms

        def count(share: tuple, sign: int) -> None:
            for kind, label in (("stance", share[0]), ("sentiment", share[1])):
                if label is not None:
                    sums[f"{kind}_{label}"] += sign * share[2]
                    counts[f"{kind}_{label}"] += sign

        for frame in rows:
            columns = (frame[c].tolist() for c in ("comment_id", "s_", "e_", "weight", "changed_ms", "created_ms"))
            for comment, stance, sentiment, weight, changed, created in zip(*columns, strict=True):
                if comment not in known and self.shares.containsKey((comment,)):
                    known[comment] = tuple(self.shares.getValue((comment,)))
                old = known.get(comment)
                if old is None and (changed <= least or created < changed and created <= least):
                    continue  # its first row may be one that has been forgotten
                if old is not None:
                    if old[3] >= changed:
                        continue
                    count(old, -1)
                known[comment] = (stance, sentiment, weight, changed)
                count(known[comment], 1)
        for comment, share in known.items():
            self.shares.updateValue((comment,), share)
        if known:
            self.handle.registerTimer(max(share[3] for share in known.values()) + self.keep_ms + 1)
        self.sums.update((*(float(sums[k]) for k in KINDS), *(int(counts[k]) for k in KINDS)))
        yield pd.DataFrame([distribution(key[0], sums, counts, self.min_comments)], columns=[c.split()[0] for c in OUT.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        """Forgets comments that no correction may reach any more."""
        least = timerValues.getCurrentWatermarkInMs() - self.keep_ms
        for (comment,), share in list(self.shares.iterator()):
            if share[3] <= least:
                self.shares.removeKey((comment,))
        yield from ()

    def close(self) -> None:
        pass


def post_fold(comments: DataFrame, correct: str = "7 days", late: str = "1 day", min_comments: int = 5, changed: str = "changed_utc") -> DataFrame:
    """A stream of comments and their changes -> a stream of distributions per post, a row whenever one has changed (update mode).

    changed: epoch seconds of a row's change, by which the watermark moves; created_utc is when the comment was made. The session's
    spark.sql.streaming.stateStore.providerClass must be STORE."""
    keep = comments.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp_seconds(0) + interval {correct})")).first()[0]
    rows = with_weight(comments.where("post_id is not null and comment_id is not null"))
    rows = rows.withColumns({"s_": labels.stance(F.col("stance_label")), "e_": labels.sentiment(F.col("sentiment_label")), "at_": F.timestamp_seconds(changed), "changed_ms": F.col(changed) * 1000, "created_ms": F.coalesce("created_utc", F.col(changed)) * 1000})
    rows = rows.withWatermark("at_", late).select("post_id", "comment_id", "s_", "e_", "weight", "changed_ms", "created_ms", "at_")
    return rows.groupBy("post_id").transformWithStateInPandas(Fold(keep, min_comments), OUT, "Update", "EventTime")


def latest(comments: DataFrame, changed: str = "changed_utc") -> DataFrame:
    """The batch that the fold equals: each comment as its last change left it."""
    order = F.struct(changed, *[c for c in comments.columns if c not in (changed, "comment_id")])
    own = comments.groupBy("comment_id").agg(F.max_by(F.struct(*[c for c in comments.columns if c != "comment_id"]), order).alias("r_"))
    return own.select("comment_id", "r_.*").select(comments.columns)
