"""Readers and writers of exchange files: CSV, JSON, JSON lines and lists of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agorascope.functions.text import strip
from agorascope.sources import schema


def read_csv(spark: SparkSession, path: str, columns: str) -> DataFrame:
    return spark.read.csv(path, schema=columns, header=True, multiLine=True, escape='"', quote='"')


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.csv(path, header=True, escape='"', quote='"', mode=mode, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_chunks(chunks: DataFrame, path: str) -> None:
    """The chunks of topics, their terms joined by bars."""
    write_csv(chunks.select("topic_id", "chunk_id", "post_count", "near_count", "far_count", "token_estimate", "cluster_token_sum", F.array_join("terms", "|").alias("ctfidf_terms")), path)


def write_chunk_posts(posts: DataFrame, path: str) -> None:
    """The posts of chunks, distances with six decimals."""
    write_csv(posts.select("topic_id", "chunk_id", "post_index", "tag", "post_id", F.format_string("%.6f", "distance").alias("distance"), "text"), path)


def write_results(results: DataFrame, path: str, append: bool = False) -> None:
    """Results of labelling; append adds files to those there, each with its header."""
    write_csv(results.select(*[c.split()[0] for c in schema.RESULTS_CSV.split(", ")]), path, "append" if append else "overwrite")


def posts_path(chunks_path: str) -> str:
    """Where the posts of chunks go: beside the chunks, by the same name with posts for chunks (or chunk), else with _posts."""
    folder, slash, name = chunks_path.rpartition("/")
    stem, dot, ending = name.rpartition(".")
    stem, dot, ending = (stem, dot, ending) if stem else (name, "", "")
    part = next((p for p in ("chunks", "chunk") if p in stem), None)
    return f"{folder}{slash}{stem.replace(part, 'posts') if part else stem + '_posts'}{dot}{ending}"


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """topic_id and its terms, blank ones dropped."""
    rows = read_csv(spark, path, schema.TERMS_CSV)
    return rows.select("topic_id", "post_count", F.filter(F.split(F.coalesce("top_terms", F.lit("")), r"\|"), lambda t: strip(t) != "").alias("terms"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Chunks with a whole number as id; of repeated keys the last row."""
    rows = read_csv(spark, path, schema.CHUNKS_CSV).withColumn("chunk_id", F.col("chunk_id").try_cast("int")).where("chunk_id is not null")
    rows = rows.withColumn("row_", F.monotonically_increasing_id())
    last = Window.partitionBy("topic_id", "chunk_id").orderBy(F.desc("row_"))
    return rows.withColumn("n_", F.row_number().over(last)).where("n_ = 1").drop("row_", "n_")


def read_chunk_posts(spark: SparkSession, path: str) -> DataFrame:
    """(topic_id, chunk_id) with its posts as an array in order of post_index."""
    rows = read_csv(spark, path, schema.CHUNK_POSTS_CSV).withColumn("chunk_id", F.col("chunk_id").try_cast("int")).where("chunk_id is not null")
    return rows.groupBy("topic_id", "chunk_id").agg(F.sort_array(F.collect_list(F.struct("post_index", "tag", "post_id", "distance", "text"))).alias("posts"))


def chunk_items(chunks: DataFrame, posts: DataFrame) -> DataFrame:
    """Chunks with their posts; chunks without posts, and posts without a chunk, are left out."""
    return chunks.join(posts.select("topic_id", "chunk_id", "posts"), ["topic_id", "chunk_id"])


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schema.RESULTS_CSV)


def max_batch_id(results: DataFrame) -> DataFrame:
    return results.agg(F.coalesce(F.max(F.col("batch_id").try_cast("int")), F.lit(0)).alias("max_batch_id"))


def read_json_lines(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """JSON lines, those that are no JSON skipped."""
    return spark.read.schema(columns).option("mode", "DROPMALFORMED").json(path)


def read_items(spark: SparkSession, path: str, item: str) -> DataFrame:
    """Records of one JSON document: a list, or an object that has them under items."""
    from agorascope.functions.jsontext import rows_of

    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(rows_of(F.col("value"), f"struct<{item}>")).alias("r")).select("r.*")


def read_batches(spark: SparkSession, folder: str, columns: str) -> DataFrame:
    """Replayed batch_N_input.json files with their number, in its order; broken files are skipped."""
    rows = spark.read.schema(columns).option("mode", "DROPMALFORMED").option("multiLine", True).option("pathGlobFilter", "batch_*_input.json").json(folder)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"batch_(\d+)_input", 1).try_cast("int")
    return rows.withColumn("batch_number", number).orderBy("batch_number")


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.json(path, mode=mode, ignoreNullFields=False)


def write_lines(df: DataFrame, path: str) -> None:
    """One text column as lines."""
    df.write.text(path)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Lower-cased words of a list, blank lines and comments left out."""
    word = F.lower(strip(F.col("value")))
    return spark.read.text(path).select(word.alias("word")).where("word <> '' and not startswith(word, '#')")


def read_sources(spark: SparkSession, path: str, category: str = "general") -> DataFrame:
    """`name (category)` lines; comments are cut off, lines of another form skipped; the first of equal names stays."""
    lines = spark.read.text(path).select(strip(F.regexp_replace("value", "#.*$", "")).alias("line"), F.monotonically_increasing_id().alias("row"))
    form = r"^(?:r/)?([A-Za-z0-9_]+)\s*(?:\(([^)]*)\))?$"
    rows = lines.where(F.col("line").rlike(form)).select("row", F.regexp_extract("line", form, 1).alias("name"), F.coalesce(F.nullif(strip(F.regexp_extract("line", form, 2)), F.lit("")), F.lit(category)).alias("category"))
    first = Window.partitionBy(F.lower("name")).orderBy("row")
    return rows.withColumn("n", F.row_number().over(first)).where("n = 1").select("name", "category")


def read_document(spark: SparkSession, path: str) -> str | None:
    """A whole JSON document as text; null if there is none, or it is broken."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.text(path, wholetext=True).where(F.try_parse_json("value").isNotNull()).limit(1).collect()
    except AnalysisException:
        return None
    return rows[0]["value"] if rows else None
