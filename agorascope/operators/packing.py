"""Items into batches under limits of tokens and counts. Order is kept; items come sorted by the columns given."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorascope.functions.sequences import batch_number
from agorascope.sources import store


def next_fit(sizes: list[int], budget: int, most: int | None = None) -> list[int | None]:
    """Batch of each item: a new one begins where the item would break a limit; an item over the budget gets none."""
    out, batch, used, count = [], 0, 0, 0
    for s in sizes:
        if s > budget:
            out.append(None)
            continue
        if count and (used + s > budget or (most and count >= most)):
            batch, used, count = batch + 1, 0, 0
        out.append(batch)
        used, count = used + s, count + 1
    return out


def first_fit_skip(sizes: list[int], budget: int, base: int = 0) -> list[int | None]:
    """0 for items that still fit beside those before; the others are skipped."""
    out, used = [], base
    for s in sizes:
        fits = used + s <= budget
        used += s if fits else 0
        out.append(0 if fits else None)
    return out


def packed(rows: DataFrame, group: str, order: list[str], size: str, pack: Callable[[list[int]], list]) -> DataFrame:
    """Adds batch, numbered from 0 within each group; items without one are left out.

    One task per group, for rules whose state passes from item to item in other ways than next fit (packed_in_order)."""
    schema = rows.withColumn("batch", F.lit(0).cast("long")).schema

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(order, kind="stable").reset_index(drop=True)
        part["batch"] = pd.array(pack(part[size].tolist()), dtype="Int64")
        return part[part["batch"].notna()]

    return rows.groupBy(group).applyInPandas(run, schema)


def next_starts(sizes: np.ndarray, breaks: np.ndarray, budget: int | np.ndarray, most: int | None) -> np.ndarray:
    """For each item, where the next batch begins if one begins at the item. breaks: items that no batch may reach from before;
    budget: one, or that of each item's group."""
    n, total = len(sizes), np.concatenate(([0], np.cumsum(sizes)))
    out = np.searchsorted(total, total[:-1] + budget, side="right") - 1
    cuts = np.append(np.flatnonzero(breaks), n)
    out = np.minimum(out, cuts[np.searchsorted(cuts, np.arange(n), side="right")])
    return np.minimum(out, np.arange(n) + most) if most else out


def summary(sizes: np.ndarray, budget: int | np.ndarray, most: int | None, ends: bool, heads: np.ndarray | None = None) -> tuple:
    """How a range of items changes any open batch: (first, shut, closed, batches, used, held, tail).

    An open batch takes p of the first items and a new one begins at p, with p at most what an empty batch takes. The
    lists hold, for each such p, the batches begun and the tokens and count of the one left open. `first` are the sizes
    of those items; shut and closed: whether the batch open before, or that left open, is ended by an item over the budget or
    a new group (heads: the items that begin one). tail: batches begun from the last of these groups on, None without one."""
    fits = sizes <= budget
    own = sizes[fits]
    n = len(own)
    marks = np.zeros(len(sizes), np.int64) if heads is None else np.cumsum(heads)
    before = marks[fits]
    if ends:
        marks = marks + np.cumsum(~fits)
    breaks = np.diff(marks[fits], prepend=0) > 0
    total = int(marks[-1]) if len(marks) else 0
    shut, closed = bool(n and breaks[0]), total > (int(marks[fits][-1]) if n else 0)
    last = None if heads is None or not heads.any() else int(np.searchsorted(before, int(np.sum(heads))))
    if not n:
        return [], closed, closed, [0], [0], [0], None if last is None else 0
    starts, sums = next_starts(own, breaks, budget if isinstance(budget, int) else budget[fits], most).tolist(), np.concatenate(([0], np.cumsum(own))).tolist()
    begun, used, held = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        j = starts[i]
        begun[i] = begun[j] + 1
        used[i], held[i] = (used[j], held[j]) if j < n else (0, 0) if closed else (sums[n] - sums[i], n - i)
    end = starts[0]
    return own[:end].tolist(), shut, closed, begun[: end + 1], used[: end + 1], held[: end + 1], None if last is None else begun[last]


def entered(parts: list[tuple], most: int | None) -> list[tuple[int, int, int, int, int]]:
    """(part, batches begun before, tokens and count of the batch open there, batches begun before the group there) from
    (part, first group, its budget, last group, *summary) in order."""
    out, batches, used, held, base, group = [], 0, 0, 0, 0, None
    for part, head, budget, end, first, shut, closed, begun, left, count, tail in parts:
        if head != group:
            used, held, base = 0, 0, batches
        group = end
        out.append((part, batches, used, held, base))
        p, u, h = 0, used, held
        if held and not shut:
            while p < len(first) and u + first[p] <= budget and not (most and h >= most):
                p, u, h = p + 1, u + first[p], h + 1
        if begun[p]:
            batches, used, held = batches + begun[p], left[p], count[p]
        else:
            used, held = (0, 0) if closed else (u, h)
        if tail is not None:
            base = batches - tail
    return out


def packed_in_order(rows: DataFrame, order: list[str], size: str, budget: int | str, most: int | None = None, ends: bool = False, group: list[str] | None = None) -> DataFrame:
    """Adds batch, numbered from 0: next fit along one global order, or that of each group; items over the budget or without a
    size get no batch and are left out, and end the open batch if `ends`. budget: a number, or a column with that of each group.

    Rows are sorted by ranges into a table. Each range says how it changes any open batch (a summary as long as one batch
    has items); these few rows are composed in order on the driver, and then all ranges are packed at once, each from the
    batch that is open where it begins. So a group of any size is packed by as many tasks as it has ranges, and batches do not
    depend on the number of ranges. Ties keep the table's order."""
    spark, group = rows.sparkSession, group or []
    held = rows.withColumn("g_", F.to_json(F.struct(*group), {"ignoreNullFields": "false"}) if group else F.lit("")).withColumn("m_", F.col(budget) if isinstance(budget, str) else F.lit(budget))
    held = held.where(F.col(size).isNotNull() if ends else F.col(size) <= F.col("m_"))
    held = held.repartitionByRange("g_", *order).sortWithinPartitions("g_", *order)
    table = store.kept(held.withColumn("at_", F.monotonically_increasing_id()).withColumn("part_", F.shiftright("at_", 33)), "packed")
    names = ["part_", "head", "room", "end", "first", "shut", "closed", "begun", "used", "held", "tail"]

    def summed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("at_")
        own = part["g_"].to_numpy()
        got = summary(part["n_"].to_numpy(), part["m_"].to_numpy(), most, ends, np.append(False, own[1:] != own[:-1]))
        return pd.DataFrame([(part["part_"].iloc[0], own[0], part["m_"].iloc[0], own[-1], *got)], columns=names).astype({"tail": "Int64"})

    narrow = table.select("part_", "at_", "g_", F.col("m_").cast("long").alias("m_"), F.col(size).cast("long").alias("n_"))
    sums = narrow.groupBy("part_").applyInPandas(summed, "part_ long, head string, room long, end string, first array<long>, shut boolean, closed boolean, begun array<long>, used array<long>, held array<long>, tail long")
    begins = entered(sorted((tuple(r) for r in sums.collect()), key=lambda r: r[0]), most)
    begins = spark.createDataFrame(begins, "part_ long, b_ long, u_ long, h_ long, o_ long")
    schema = rows.withColumn("batch", F.lit(None).cast("long")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, of, batch, used, count, base = None, None, 0, 0, 0, 0
        for frame in frames:
            own = []
            for s, room, g, part, b, u, h, o in zip(*(frame[c].tolist() for c in (size, "m_", "g_", "part_", "b_", "u_", "h_", "o_")), strict=True):
                if part != here:
                    here, of, batch, used, count, base = part, g, b - 1, u, h, o
                elif g != of:
                    of, used, count, base = g, 0, 0, batch + 1
                if s > room:
                    used, count = 0, 0
                    own.append(None)
                    continue
                if not count or used + s > room or (most and count >= most):
                    batch, used, count = batch + 1, 0, 0
                used, count = used + s, count + 1
                own.append(batch - base)
            frame = frame.drop(columns=["g_", "m_", "at_", "part_", "b_", "u_", "h_", "o_"]).assign(batch=pd.array(own, dtype="Int64"))
            yield frame[frame["batch"].notna()]

    # One row per range, so the side that is broadcast does not grow with the rows of a range.
    return table.join(F.broadcast(begins), "part_").repartition("part_").sortWithinPartitions("part_", "at_").mapInPandas(run, schema)


def by_count(rows: DataFrame, group: str, order: list[str], most: int) -> DataFrame:
    """Adds batch where only a count limits: closed form, no state."""
    w = Window.partitionBy(group).orderBy(*order)
    return rows.withColumn("batch", batch_number(F.row_number().over(w), most))


def grouped(rows: DataFrame, group: str, order: str, fields: list[str], text: str) -> DataFrame:
    """Nested lists in order, and the first text of each group that is not blank."""
    given = F.when(F.coalesce(text, F.lit("")) != "", F.struct(order, text))
    return rows.groupBy(group).agg(F.min(given)[text].alias("post_text"), F.transform(F.sort_array(F.collect_list(F.struct(order, *fields))), lambda s: F.struct(*[s[f].alias(f) for f in fields])).alias("items"))
