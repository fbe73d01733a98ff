"""Steps of a pipeline as functions over named tables, in the order that their inputs ask for.

With a state, a step's table is kept under a name made of its inputs' versions and of its code: a run that was cut off goes on
after its last whole table, in this session or a later one, and a step whose input files or code have changed runs again.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from agorascope.sources import store
from agorascope.sources.store import shared_dir


@dataclass(frozen=True)
class Step:
    name: str
    needs: tuple[str, ...]
    work: Callable[..., DataFrame]
    optional: bool = False
    #: What the result depends on besides its inputs and this package: options, a model's name.
    version: str = ""


def order(steps: list[Step]) -> list[str]:
    by = {s.name: s for s in steps}
    return [n for n in TopologicalSorter({s.name: [x for x in s.needs if x in by] for s in steps}).static_order() if n in by]


def written(name: str, df: DataFrame) -> DataFrame:
    """The table in the shared folder, so a step has run when it counts as done."""
    path = f"{shared_dir(df.sparkSession)}/step-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class State:
    """Whole tables of steps, by step and version, below a folder of the shared one."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/runs/{name}"

    @staticmethod
    def version(step: Step, inputs: list[str | None]) -> str | None:
        """None, so the step always runs, where an input has no version."""
        if None in inputs:
            return None
        return hashlib.sha256(json.dumps([step.name, step.version, inputs, store.code_digest()]).encode()).hexdigest()[:32]

    def find(self, step: str, version: str) -> DataFrame | None:
        held = store.read_json(self.spark, f"{self.root}/{step}-{version}.json")
        return held and self.spark.read.schema(StructType.fromJson(json.loads(held["schema"]))).parquet(held["place"])

    def keep(self, step: str, version: str, df: DataFrame) -> DataFrame:
        """Writes the table, then the file that says it is whole."""
        place = f"{self.root}/{step}-{version}-{uuid.uuid4().hex}"
        df.write.parquet(place)
        if not store.create_json(self.spark, f"{self.root}/{step}-{version}.json", {"step": step, "place": place, "schema": df.schema.json(), "made": time.time()}):
            store.delete(self.spark, place)
        return self.find(step, version)

    def sweep(self, current: dict[str, str], keep_seconds: float = store.KEEP_SECONDS) -> list[str]:
        """Deletes tables of these steps at other versions, and what runs cut off have left, once they are old enough."""
        names = store.names(self.spark, self.root)
        held = {x: store.read_json(self.spark, f"{self.root}/{x}") for x in names if x.endswith(".json")}
        now, gone = time.time(), []
        for x, y in held.items():
            if y["step"] in current and x != f"{y['step']}-{current[y['step']]}.json" and y["made"] <= now - keep_seconds:
                store.delete(self.spark, f"{self.root}/{x}")
                store.delete(self.spark, y["place"])
                gone.append(x[:-5])
        places = {y["place"].rsplit("/", 1)[1] for y in held.values()}
        for x in names:
            if not x.endswith(".json") and x not in places and store.modified(self.spark, f"{self.root}/{x}") <= now - keep_seconds:
                store.delete(self.spark, f"{self.root}/{x}")
        return gone


def run(steps: list[Step], tables: dict[str, DataFrame], dry_run: bool = False, continue_on_error: bool = False, keep: Callable[[str, DataFrame], DataFrame] = written, state: State | None = None, versions: dict[str, str] | None = None, log: list | None = None) -> tuple[dict[str, DataFrame], dict[str, Exception]]:
    """Tables by name, given and made, and the errors of steps that failed, when planned or when run; steps that need those
    are left out. keep: what makes a step's table before it counts as done.

    state: where whole tables are kept and found again; versions: those of the given tables, as store.fingerprint() gives
    them for their files. log: gets (step, "made", "found" or "failed") in turn."""
    by, made, failed = {s.name: s for s in steps}, dict(tables), {}
    at, log = {x: (versions or {}).get(x) for x in tables}, [] if log is None else log
    for name in order(steps):
        step = by[name]
        if dry_run or any(x not in made for x in step.needs):
            continue
        at[name] = State.version(step, [at[x] for x in step.needs]) if state else None
        try:
            found = state.find(name, at[name]) if at[name] else None
            if found is None:
                df = step.work(*[made[x] for x in step.needs])
                made[name] = state.keep(name, at[name], df) if at[name] else keep(name, df)
            else:
                made[name] = found
            log.append((name, "made" if found is None else "found"))
        except Exception as e:  # noqa: BLE001 the caller decides
            log.append((name, "failed"))
            if not (continue_on_error or step.optional):
                raise
            failed[name] = e
    if state and not failed and not dry_run:
        state.sweep({x: at[x] for x in by if at.get(x)})
    return made, failed


def standard_steps(model: Callable[[str], str] | None = None, templates: dict[str, str] | None = None, model_name: str = "rules") -> list[Step]:
    """From raw posts and comments to topics, terms, names of topics, ratings of these, labels, weights and distributions.

    model: from prompt to reply, for names, ratings and labels; templates: prompts by topics, ratings and labels."""
    from agorascope.operators import cluster, ctfidf, ingest, merge, sets, weights
    from agorascope.plans import labeling

    model = model or labeling.rule_model
    prompts = {"topics": "{{CHUNKS}}", "ratings": "{{POSTS_JSON}}", "labels": "{{POSTS_JSON}}"} | (templates or {})
    asked = json.dumps([model_name, prompts])

    def topics(posts: DataFrame, embedded: DataFrame) -> DataFrame:
        found = cluster.cluster_posts(embedded)
        return merge.update(posts, found.select("post_id", "topic_id", "center_distance"), "post_id", only_finite=False)

    def noise_topics(posts: DataFrame, embedded: DataFrame) -> DataFrame:
        rest = embedded.join(posts.where("topic_id = 'noise'").select("post_id"), "post_id", "left_semi")
        found = cluster.cluster_posts(rest, prefix="noise").where("label <> -1")
        return merge.update(posts, found.select("post_id", "topic_id"), "post_id")

    def terms(posts: DataFrame) -> DataFrame:
        rows = posts.select("topic_id", "post_id", F.col("topic_text").alias("text"))
        return ctfidf.top_terms(ctfidf.term_scores(rows, ctfidf.stop_words(posts.sparkSession)))

    def topic_names(posts: DataFrame, terms: DataFrame) -> DataFrame:
        lists = terms.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term")))["term"].alias("terms"))
        chunks = labeling.label_chunks(posts.select("topic_id", "post_id", F.col("center_distance").alias("distance"), F.col("topic_text").alias("text")), lists)
        return sets.best_per_topic(labeling.label_topics(chunks, model, prompts["topics"]), "chunk_id")

    def named_posts(posts: DataFrame, names: DataFrame) -> DataFrame:
        rows = merge.set_topic_labels(posts.drop("topic_name", "topic_description"), names.select("topic_id", "topic_name", "topic_description"))
        return merge.unset_noise(rows, ["topic_name", "topic_description"])

    def ratings(posts: DataFrame) -> DataFrame:
        rows = posts.where("topic_name is not null").select("post_id", "topic_name", "topic_description", F.col("topic_text").alias("text"))
        return labeling.rate(rows, model, prompts["ratings"])

    def labels(posts: DataFrame, comments: DataFrame) -> DataFrame:
        dated = comments if "created_utc" in comments.columns else comments.withColumn("created_utc", F.lit(None).cast("long"))
        requests = labeling.stance_requests(labeling.export_missing(dated, posts), prompts["labels"])
        return labeling.stance_labels(requests, model)[0].withColumnRenamed("request", "order_")

    return [
        Step("clean_posts", ("posts",), ingest.clean_posts),
        Step("clean_comments", ("comments",), ingest.clean_comments),
        Step("embedded", ("clean_posts",), lambda p: cluster.embed_texts(p.withColumn("text", F.col("topic_text")), cluster.hashing_encoder())),
        Step("topics", ("clean_posts", "embedded"), topics),
        Step("noise_topics", ("topics", "embedded"), noise_topics, optional=True),
        Step("terms", ("noise_topics",), terms),
        Step("topic_names", ("noise_topics", "terms"), topic_names, version=asked),
        Step("named_posts", ("noise_topics", "topic_names"), named_posts),
        Step("ratings", ("named_posts",), ratings, version=asked),
        Step("labels", ("clean_posts", "clean_comments"), labels, version=asked),
        Step("labelled", ("clean_comments", "labels"), merge.save_labels),
        Step("weighted", ("labelled",), weights.with_weight),
        Step("distributions", ("weighted",), weights.post_distribution),
    ]
