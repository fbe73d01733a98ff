"""The operators over their tables with production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.llm import chat, decontaminate, filter_audit, fst_count, html_extract, jaccard_join, packing, pii, quality, rans_store, simhash_ball, vector_codes, warc
from agorascope.llm.staging import Stage


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digest(chat.format_chat(rows.unionByName(more)))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op8_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = rans_store.write_shards(table(spark, sf_dir, "documents"), Stage(spark, "tokens"), tokenizer("word_bpe_49k.json"), end_id=2)
    return rans_store.read_shards(shards)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), Stage(spark, "warc"))
    return warc.pages(warc.read_chunks(manifest, with_data=False))


def op11_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_ball.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality, op2_chat, op3_pack, op4_decontaminate, op5_html, op6_ngram_jaccard, op7_pii, op8_token_count, op9_token_store, op10_warc, op11_simhash_ball, op12_filter_audit, op13_vector_codes)}

ORACLES: dict[str, str] = {
    "op2_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, role || text AS own FROM t
), n AS (
  SELECT *, length(own) + (length(own) - length(replace(own, chr(92), '')))
    + (length(own) - length(replace(own, '<|', ''))) // 2
    + (length(own) - length(replace(own, '<s>', ''))) // 3
    + (length(own) - length(replace(own, '</s>', ''))) // 4
    + (length(own) - length(replace(own, '[INST]', ''))) // 6
    + (length(own) - length(replace(own, '[/INST]', ''))) // 7 + 23 AS chars
  FROM e
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id
""",
    "op12_filter_audit": filter_audit.SQL,
    "op13_vector_codes": vector_codes.sql(),
}
