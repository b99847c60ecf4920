"""The opN_ queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlens.llm import sql
from roadlens.session import table


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.embed_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.quotes import format_chats

    return format_chats(table(spark, sf_dir, "conversations"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.token_scan import document_token_counts

    counts = document_token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), eod_id=50256)
    return counts.select("doc_id", "n_tokens")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.langid import identify

    return identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "ambiguous", "lang_second")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.sharding import shard_by_size

    placed = shard_by_size(table(spark, sf_dir, "documents"), n_shards=16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.packing import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.html_blocks import extract

    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.mixing import mix_sources

    return mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.minhash import near_groups

    return near_groups(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.filter_audit import audit

    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.hard_negatives import hard_negatives, quantised

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(quantised(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 50 == 0)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from roadlens.llm.line_dedup import drop_common_lines

    return drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def llm_queries() -> dict:
    ops = (op1_embedding_dedup, op2_exact_dedup, op3_chat_formatting, op4_token_counts, op5_language_id, op6_sharding, op7_packing, op8_html_extraction, op9_mixing, op10_near_dedup)
    return {f.__name__: f for f in (*ops, op11_filter_audit, op12_hard_negatives, op13_line_dedup)}


def llm_oracles() -> dict[str, str]:
    first = {"op1_embedding_dedup": sql.OP1, "op2_exact_dedup": sql.OP2, "op3_chat_formatting": sql.OP3, "op8_html_extraction": sql.OP8, "op9_mixing": sql.OP9}
    return first | {"op11_filter_audit": sql.OP11, "op12_hard_negatives": sql.OP12, "op13_line_dedup": sql.OP13}
