"""The operators bound to the tables: one query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.llm import chat_format, decontaminate, jaccard, knn, line_dedup, lm_score, pack, phrases, quality, sharding, token_count, toxicity, vector_codes


def tokenizer_path(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of every row of ``embeddings`` for each whose id is divisible by 50."""
    vectors = knn.quantize(_read(spark, sf_dir, "embeddings"))
    return knn.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_count.token_counts(_read(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 10-word windows of the benchmark."""
    found = decontaminate.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents and each one's number of links."""
    return jaccard.near_duplicates(_read(spark, sf_dir, "documents"))


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return pack.pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by two co-trained views."""
    return quality.quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, restored from its disguises."""
    return toxicity.toxicity_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document; a seventh is held out from training."""
    docs = _read(spark, sf_dir, "documents")
    held = toxicity.held_out("doc_id", 7)
    scored = lm_score.lm_scores(docs, ~held).withColumn("held_out", held)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many share."""
    return line_dedup.dedup_lines(_read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and conversation -7 of control strings, formatted and read back."""
    says = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text")
    )
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat_format.digest(chat_format.format_conversations(turns))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of all documents."""
    return phrases.mine_phrases(_read(spark, sf_dir, "documents"), longest=4, least=30, top=2000)


def op12_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards whose numbers of rows are at most one apart."""
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), shards=16, law="rows")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings: four parts of 256 entries, four rounds."""
    coded = vector_codes.compress(_read(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_top_k, op2_token_counts, op3_decontaminate, op4_jaccard_join, op5_pack, op6_quality, op7_toxicity, op8_lm_score, op9_line_dedup, op10_chat_format, op11_phrases, op12_ring_shards, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {"op1_top_k": knn.ORACLE, "op3_decontaminate": decontaminate.ORACLE, "op9_line_dedup": line_dedup.ORACLE, "op10_chat_format": chat_format.ORACLE, "op11_phrases": phrases.ORACLE, "op13_vector_codes": vector_codes.oracle()}
