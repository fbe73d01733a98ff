"""Labels from models: prompts, requests, replies, retries and audits. Models are plain functions from prompt to reply."""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.config import Busy, Pace
from agorascope.functions import jsontext, text
from agorascope.functions.labels import missing_labels
from agorascope.operators import packing, sampling, sets

Model = Callable[[str], str]
LABEL = "post_id string, comment_id string, sentiment string, stance string, confidence double, rationale string"
TOPIC = "topic_id string, chunk_id int, topic_name string, topic_description string, confidence double, representative_indices array<int>"
#: Fixed value: what stands between the chunks of a prompt.
BETWEEN = "\n\n---\n\n"
RATING = "post_id string, matches boolean, fit_score double, rationale string, better_topic_name string, better_topic_description string"


def answered(model: Model, prompt: str, tries: int = 3, wait: float = 0.0, timeout: float | None = None, pace: Pace | None = None, pool: ThreadPoolExecutor | None = None) -> tuple[str, str | None]:
    """The model's reply, or an empty one and what the last try failed with. Waits double from try to try; a call longer
    than timeout counts as failed.

    pace: every try waits for its turn; a model that raises config.Busy is asked again when it said, which counts as a try.
    pool: threads for calls under a timeout; one that never returns keeps its thread."""
    error = None
    for turn in range(tries):
        if turn and wait:
            time.sleep(wait * 2 ** (turn - 1))
        if pace:
            pace.wait()
        try:
            if timeout is None:
                return model(prompt), None
            own = pool or ThreadPoolExecutor(1)
            try:
                return own.submit(model, prompt).result(timeout), None
            finally:
                if own is not pool:
                    own.shutdown(wait=False, cancel_futures=True)
        except Busy as e:
            error = f"{type(e).__name__}: {e}"[:500]
            if pace:
                pace.hold(e.seconds)
            elif turn + 1 < tries:
                time.sleep(e.seconds)
        except Exception as e:  # noqa: BLE001 a client may raise anything; the caller gets what it was
            error = f"{type(e).__name__}: {e}"[:500]
    return "", error


def ask(requests: DataFrame, model: Model, prompt: str = "prompt", tries: int = 3, wait: float = 0.0, timeout: float | None = None, rate: float | None = None, workers: int | None = None) -> DataFrame:
    """Adds reply, empty if all tries failed, and reply_error. The model is called on the workers, prompt by prompt.

    rate: calls a second that all workers together may make, retries included. Requests are dealt to `workers` tasks (as many as
    the cluster runs at once, unless told otherwise), and each has its share; fewer at a time only make fewer calls. Whoever
    retries in the model itself (chat_model's retries) should not with a rate, as its tries have no turn."""
    schema = requests.withColumns({"reply": F.lit("").cast("string"), "reply_error": F.lit(None).cast("string")}).schema
    tasks = 0
    if rate:
        tasks = workers or requests.sparkSession.sparkContext.defaultParallelism
        requests = requests.repartition(tasks)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(rate, tasks, TaskContext.get().partitionId()) if rate else None
        with_pool = ThreadPoolExecutor(tries) if timeout is not None else None
        try:
            for part in parts:
                got = [answered(model, p, tries, wait, timeout, pace, with_pool) for p in part[prompt]]
                yield part.assign(reply=[r for r, _ in got], reply_error=[e for _, e in got])
        finally:
            if with_pool:
                with_pool.shutdown(wait=False, cancel_futures=True)

    return requests.mapInPandas(run, schema)


def rule_model(prompt: str) -> str:
    """A stand-in that needs no service: labels by the words and ids that the prompt holds."""
    import json
    import re

    comments = [c | {"post_id": r.get("post_id")} for r in jsontext.loose_records(prompt) for c in r.get("comments", [])]
    if comments:
        said = lambda c, words: any(w in (c.get("comment_text") or "").lower() for w in words)
        return json.dumps([{"post_id": c["post_id"], "comment_id": c["comment_id"], "sentiment": "positive" if said(c, ["good", "the"]) else "negative" if said(c, ["bad"]) else "neutral", "stance": "agree" if said(c, ["yes", "and"]) else "disagree" if said(c, ["no"]) else "unclear", "confidence": 0.75, "rationale": "by rule"} for c in comments])
    keys = re.findall(r"topic_id: (\S+) chunk_id: (\d+)", prompt)
    return json.dumps([{"topic_id": t, "chunk_id": int(c), "topic_name": f"Name of {t}", "topic_description": f"About {t}", "confidence": 0.5, "representative_indices": [0]} for t, c in keys])


def export_missing(comments: DataFrame, posts: DataFrame, mode: str = "both", per_post: int | None = None, most_posts: int | None = None, total: int | None = None) -> DataFrame:
    """post_id, post_text, comments of posts with a text, whose comments lack labels, are not deleted and say something."""
    rows = comments.where(missing_labels(F.col("stance_label"), F.col("sentiment_label"), mode)).withColumn("said", text.first_text(*[F.col(c) for c in ("comment_text_clean", "body_clean", "comment_text", "body") if c in comments.columns]))
    rows = rows.where((F.col("said") != "") & ~text.is_deleted(F.col("said")))
    own = posts.select("post_id", text.post_text(*[F.col(c) if c in posts.columns else F.lit(None).cast("string") for c in ("topic_text", "title", "selftext")]).alias("post_text")).where("post_text <> ''")
    rows = sampling.capped(rows.join(own, "post_id"), per_post, most_posts, total)
    found = rows.groupBy("post_id").agg(F.first("post_text").alias("post_text"), F.sort_array(F.collect_list(F.struct("created_utc", "comment_id", F.col("said").alias("comment_text")))).alias("c"))
    return found.select("post_id", "post_text", F.transform("c", lambda c: F.struct(c["comment_id"].alias("comment_id"), c["comment_text"].alias("comment_text"))).alias("comments"))


def stance_requests(exported: DataFrame, template: str, budget: int = 100_000, most_comments: int = 4, most_batches: int = 100, place: str = "{{POSTS_JSON}}") -> DataFrame:
    """request, prompt, comment_ids: comments in batches of a post, batches in requests under the token budget.

    A batch ends where its count or its own prompt would pass a limit; only a comment whose prompt alone does is left out."""
    said = lambda c: F.struct(c["comment_id"].alias("comment_id"), c["comment_text"].alias("comment_text"))
    written = lambda c: F.to_json(F.struct("post_id", "post_text", c.alias("comments")))
    # A prompt of k comments: the template, two brackets, the post, and per comment its text and all but once a comma.
    fixed = len(template.replace(place, "")) + template.count(place) * (F.length(written(F.slice("comments", 1, 0))) + 1)
    room = F.floor((4 * budget - fixed) / max(1, template.count(place))).cast("long")
    each = exported.select("post_id", "post_text", room.alias("room"), F.posexplode("comments").alias("i", "c"))
    each = each.select("post_id", "post_text", "room", "i", "c.comment_id", "c.comment_text", (F.length(F.to_json(said(F.col("c")))) + 1).alias("chars"))
    # Packed along ranges of all comments, each post by itself: a post with very many is no one task.
    each = packing.packed_in_order(each, ["i"], "chars", "room", most_comments, ends=True, group=["post_id"])
    batches = each.groupBy("post_id", "batch").agg(F.first("post_text").alias("post_text"), F.sort_array(F.collect_list(F.struct("i", "comment_id", "comment_text"))).alias("c"))
    rows = batches.select("post_id", "batch", written(F.transform("c", said)).alias("entry"), F.transform("c", lambda c: c["comment_id"]).alias("ids"))
    # The prompt of some entries: the template, two brackets, and per entry its text and all but once a comma.
    places = template.count(place)
    whole = (4 * budget - len(template.replace(place, ""))) // max(1, places) - 1
    rows = rows.withColumnRenamed("batch", "part").withColumn("chars", F.length("entry") + 1 if places else F.lit(0))
    rows = packing.packed_in_order(rows, ["post_id", "part"], "chars", whole, most_batches, ends=True)
    found = rows.groupBy(F.col("batch").alias("request")).agg(F.sort_array(F.collect_list(F.struct("post_id", "part", "entry", "ids"))).alias("e"))
    body = F.concat(F.lit("["), F.array_join("e.entry", ","), F.lit("]"))
    return found.select("request", text.render(template, place, body).alias("prompt"), F.flatten("e.ids").alias("comment_ids"))


def stance_labels(requests: DataFrame, model: Model) -> tuple[DataFrame, DataFrame]:
    """Labels from the model's replies, and the audit of requests whose replies hold another number of them."""
    replies = ask(requests, model)
    own = replies.select("request", F.explode(jsontext.rows_of(F.col("reply"), f"struct<{LABEL.replace(' ', ':').replace(',:', ',')}>")).alias("r")).select("request", "r.*")
    return own, sets.audit(requests.select("request", F.explode("comment_ids").alias("id")), own, "request")


def label_chunks(posts: DataFrame, terms: DataFrame, near: int = 20, far: int = 5, budget: int = 10_000) -> DataFrame:
    """topic_id, chunk_id, post_count, near_count, far_count, token_estimate, cluster_token_sum, terms, block per chunk.

    posts(topic_id, post_id, distance, text); terms(topic_id, terms)."""
    rows = sampling.near_far(posts.where("topic_id is not null and topic_id <> 'noise' and coalesce(text, '') <> ''"), near, far)
    line = F.concat(F.lit("["), F.col("tag"), F.lit(" "), F.format_string("%.6f", "distance"), F.lit("] "), F.col("text"))
    rows = rows.withColumns({"line": line, "tokens": text.estimate_tokens(line)})
    rows = packing.packed_in_order(rows, ["post_index"], "tokens", budget, group=["topic_id"])
    chunks = rows.groupBy("topic_id", (F.col("batch") + 1).cast("int").alias("chunk_id")).agg(F.count("*").alias("post_count"), F.count_if(F.col("tag") == "NEAR").alias("near_count"), F.count_if(F.col("tag") == "FAR").alias("far_count"), F.sum("tokens").alias("token_estimate"), F.sort_array(F.collect_list(F.struct("post_index", "line"))).alias("l"))
    from pyspark.sql import Window

    chunks = chunks.withColumn("cluster_token_sum", F.sum("token_estimate").over(Window.partitionBy("topic_id"))).join(terms, "topic_id", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    head = F.concat(F.lit("topic_id: "), F.col("topic_id"), F.lit(" chunk_id: "), F.col("chunk_id").cast("string"), F.lit("\nterms: "), F.array_join("terms", ", "))
    return chunks.withColumn("block", F.concat_ws("\n\n", head, F.array_join("l.line", "\n"))).drop("l")


def label_topics(chunks: DataFrame, model: Model, template: str = "{{CHUNKS}}", budget: int = 30_000, most: int = 3, passes: int = 2) -> DataFrame:
    """Results per chunk; chunks that a reply leaves out are asked for again, up to `passes` times. Few rows: topics, not posts."""
    left, done = chunks.select("topic_id", "chunk_id", "block"), None
    room = 4 * budget - len(template.replace("{{CHUNKS}}", "")) + len(BETWEEN)
    for turn in range(1, passes + 1):
        rows = packing.packed_in_order(left.withColumn("chars", F.length("block") + len(BETWEEN)), ["topic_id", "chunk_id"], "chars", room, most, ends=True)
        blocks = F.transform(F.sort_array(F.collect_list(F.struct("topic_id", "chunk_id", "block"))), lambda c: c["block"])
        calls = rows.groupBy("batch").agg(text.render(template, "{{CHUNKS}}", F.array_join(blocks, BETWEEN)).alias("prompt"))
        parsed = ask(calls, model).select("batch", F.explode(jsontext.rows_of(F.col("reply"), f"struct<{TOPIC.replace(', ', ',').replace(' ', ':')}>")).alias("r")).select(F.col("batch").alias("order_"), "r.*")
        own = sets.with_results(left.select("topic_id", "chunk_id"), parsed, ["topic_id", "chunk_id"], "order_").withColumn("turn", F.lit(turn))
        done = own if done is None else done.unionByName(own)
        if turn < passes:
            left = left.join(own.where("status = 'ok'"), ["topic_id", "chunk_id"], "left_anti")
    return sets.pruned(done, ["topic_id", "chunk_id"])


def halving(items: list, attempt: Callable[[list], object | None], tries: int = 3):
    """The first result that is not None of: all items, the first half, a quarter, ...; None if all fail."""
    for _ in range(tries):
        if not items:
            return None
        if (got := attempt(items)) is not None:
            return got
        items = items[: max(1, len(items) // 2)]
    return None


def splitting(items: list, attempt: Callable[[list], list | None], depth: int = 2) -> list:
    """Results of all items: what fails as a whole is tried in halves, down to a depth."""
    queue, out = [(items, 0)], []
    while queue:
        part, level = queue.pop(0)
        got = attempt(part)
        if got is not None:
            out += got
        elif level < depth and len(part) > 1:
            queue += [(part[: len(part) // 2], level + 1), (part[len(part) // 2 :], level + 1)]
    return out


def ask_parts(requests: DataFrame, model: Model, render: Callable[[list[str]], str], items: str = "items", split: bool = True, depth: int = 2, tries: int = 3) -> DataFrame:
    """Rows with an array of items -> each row's columns but the items, asked (those of one prompt) and reply.

    A prompt whose reply holds no JSON is asked again with fewer items. split: in halves, both of them, down to `depth`; else
    its first half only, `tries` times in all. A row per prompt that was answered; items that never were are in none."""
    others = [c for c in requests.columns if c != items]
    schema = requests.select(*others).withColumns({"asked": F.array().cast("array<string>"), "reply": F.lit("").cast("string")}).schema

    def attempt(own: list[str]) -> list | None:
        reply, _ = answered(model, render(own), tries=1)
        return [(own, reply)] if reply and re.search(r"[\[{]", reply) else None

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for row in part.to_dict("records"):
                own = list(row.pop(items))
                found = splitting(own, attempt, depth) if split else halving(own, attempt, tries) or []
                out += [{**row, "asked": asked, "reply": reply} for asked, reply in found]
            yield pd.DataFrame(out, columns=[f.name for f in schema])

    return requests.mapInPandas(run, schema)


def rate(posts: DataFrame, model: Model, template: str = "{{POSTS_JSON}}", budget: int = 8_000, most: int = 20, depth: int = 2) -> DataFrame:
    """Ratings of topic names per post, from batches under a token budget; oversized entries are left out. A batch whose reply
    cannot be read is asked again in halves, down to `depth`."""
    entry = F.to_json(F.struct("post_id", "topic_name", "topic_description", "text"))
    rows = posts.select("post_id", entry.alias("entry")).withColumn("chars", F.length("entry") + 1)
    # What the template leaves of the budget, as characters of the list between its brackets.
    empty = max(1, -(-len(template.replace("{{POSTS_JSON}}", "[]")) // 4))
    rows = packing.packed_in_order(rows, ["post_id"], "chars", 4 * (budget - empty + 1) - 1, most)
    calls = rows.groupBy("batch").agg(F.transform(F.sort_array(F.collect_list(F.struct("post_id", "entry"))), lambda s: s["entry"]).alias("items"))
    replies = ask_parts(calls, model, lambda own: template.replace("{{POSTS_JSON}}", f"[{','.join(own)}]"), depth=depth)
    return replies.select(F.explode(F.from_json(jsontext.loose_json(F.col("reply")), f"array<struct<{RATING.replace(', ', ',').replace(' ', ':')}>>")).alias("r")).select("r.*")


def label_topic(texts: DataFrame, model: Model, template: str = "{{POSTS_JSON}}", most: int = 40, tries: int = 3) -> DataFrame:
    """topic_id, topic_name, topic_description, confidence, posts: each topic named from its first texts (topic_id, rank, text).

    A reply that cannot be read is asked for again with the first half of the texts, `tries` times in all."""
    rows = texts.where(F.col("rank") <= most).groupBy("topic_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.to_json(F.struct("topic_id", "rank", "text")).alias("j")))), lambda s: s["j"]).alias("items"))
    replies = ask_parts(rows, model, lambda own: template.replace("{{POSTS_JSON}}", f"[{','.join(own)}]"), split=False, tries=tries)
    named = F.get(F.from_json(jsontext.loose_json(F.col("reply")), "array<struct<topic_name:string,topic_description:string,confidence:double>>"), F.lit(0))
    return replies.select("topic_id", F.size("asked").alias("posts"), named.alias("n")).select("topic_id", "n.*", "posts")
