"""The corpus pipeline: quality rules, n-gram Jaccard join, benchmark decontamination, PII, packing.

Each stage works on all rows its predecessor kept, written as Parquet and read again. All but the last return the columns
of documents. Repeated rows and null ids go through the stages as their operators define, but for the second: each row is
a document of its own there, and one row of each group stays. Empty tables, null or very long texts and further columns go
through as well; run() deletes a stage's tables once the next one is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.llm import decontaminate, jaccard_join, packing, pii, quality
from agorascope.llm.queries import table, tokenizer
from agorascope.llm.staging import Stage, scratch


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_rows(docs)


def with_keys(stage: Stage, docs: DataFrame) -> DataFrame:
    """Adds key_, unique: the id, and for null ids and repeats of an id a number above all ids (an error if none is left)."""
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").isEmpty():
        return docs.withColumn("key_", F.col("doc_id"))
    rows = stage.table(docs.withColumn("row_", F.monotonically_increasing_id()), "rows")
    first = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("row_").alias("row_"))
    more = stage.table(rows.select("row_").join(first.select("row_"), "row_", "left_anti").withColumn("more_", F.lit(True)), "more")
    few = more.count() <= jaccard_join.BROADCAST_IDS
    top = rows.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("long").alias("top")).first()["top"]
    rows = rows.join(F.broadcast(more) if few else more, "row_", "left")
    return rows.withColumn("key_", F.when(F.col("more_"), F.col("row_") + 1 + F.lit(max(top, 0))).otherwise(F.col("doc_id"))).drop("row_", "more_")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked documents: that with the smallest id; rows without an id come last, repeats of one too."""
    stage = Stage(spark, "copies")
    # Whole rows go in one column, so theirs clash with none of those made here.
    rows = with_keys(stage, docs.select(F.struct("*").alias("whole_"), "doc_id", "text"))
    groups = jaccard_join.jaccard_components(rows, id_col="key_")
    gone = stage.table(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("key_")).distinct(), "gone")
    few = gone.count() <= jaccard_join.BROADCAST_IDS
    return rows.join(F.broadcast(gone) if few else gone, "key_", "left_anti").select("whole_.*")


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean_of(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced."""
    return pii.redacted(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens, one row per piece."""
    rows = packing.pack(docs, tokenizer("byte_bpe_50k.json"))
    return rows.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", good_documents), ("ngram_jaccard", one_of_each_group), ("decontaminate", without_benchmarks), ("pii", without_personal_data), ("pack", packed)]

#: Tokenizers and a trained model are not expressible in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir."""
    return run_on(spark, table(spark, sf_dir, "documents"), sf_dir)


def run_on(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The stages over given documents, with the benchmark of sf_dir."""
    stage, before = Stage(spark, "pipeline"), None
    for name, work in STAGES:
        with scratch():
            docs = stage.table(work(spark, docs, sf_dir), name)
        if before:
            stage.drop(before)
        before = name
    return docs
