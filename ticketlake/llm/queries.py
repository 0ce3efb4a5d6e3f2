"""The corpus queries: each applies one operator to its whole table and derives the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm import (
    alignment,
    bpe,
    conversations,
    exact,
    hnsw,
    language,
    lines,
    packing,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    vector_graph,
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


N_SHARDS = 24


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_documents(spark, sf_dir), N_SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


COSINE = 0.95


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    linked = vector_graph.linked_vectors(vectors, threshold=COSINE)
    return linked.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


# The contract's shingle length and greatest distance in bits.
SHINGLE, DISTANCE = 3, 3


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(_documents(spark, sf_dir), SHINGLE, DISTANCE)
    return groups.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


# Folds by crc32 of the document id as text: this remainder is held out.
LANGUAGE_FOLDS, LANGUAGE_HELD_OUT = 3, 1


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(_held_out(LANGUAGE_FOLDS, LANGUAGE_HELD_OUT), F.lit(False))
    docs = _documents(spark, sf_dir)
    model = language.fit(docs.where(~held_out).select("text", "lang"))
    return language.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


# Bytes of a repeated string.
REPEAT_BYTES = 100


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return suffix_dedup.repeated_bytes(docs, length=REPEAT_BYTES).select(
        "row.doc_id",
        "n_bytes",
        F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# Folds by crc32 of the document id as text: this remainder is held out.
QUALITY_FOLDS, QUALITY_HELD_OUT, QUALITY_THRESHOLD = 5, 0, 0.3


def _held_out(folds: int, remainder: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == remainder


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Learnt from the labels outside the held-out fold, with term statistics of all documents."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~_held_out(QUALITY_FOLDS, QUALITY_HELD_OUT))
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    return quality.fit(docs, labels)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return quality.score(docs, quality_model(spark, sf_dir)).select(
        "doc_id",
        F.coalesce(_held_out(QUALITY_FOLDS, QUALITY_HELD_OUT), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact.duplicate_groups(_documents(spark, sf_dir))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def _sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


TOKENIZER = "byte_bpe_50k.json"


def op9_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """path: the tokenizer file; by default TOKENIZER of the installed public ones."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    shared = bpe.tables(spark, path)
    ids = bpe.encode(_documents(spark, sf_dir).select("doc_id", "text"), shared)
    ids = ids.withColumns({"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids_sha256": F.sha2("ids", 256)})
    return bpe.decode(ids, shared, text_col="decoded").select(
        "doc_id", "n_tokens", "ids_sha256", _sha256("decoded").alias("decoded_sha256")
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.drop_repeated_lines(_documents(spark, sf_dir))
    return rows.select("doc_id", "n_lines", "n_dropped", _sha256("text").alias("kept_sha256"))


PIECES = "piece_bpe_32k.model"


def op11_alignment(spark: SparkSession, sf_dir: str, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """a_path, b_path: the tokenizer files; by default TOKENIZER and PIECES of the installed public ones."""
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path, b_path = a_path or public_tokenizers.path(TOKENIZER), b_path or public_tokenizers.path(PIECES)
    shared = alignment.vocabularies(spark, a_path, b_path)
    return alignment.align(_documents(spark, sf_dir).select("doc_id", "text"), shared)


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return conversations.repair(conversations.damaged(rows))


# Every row whose id is divisible by this is a query.
ASK_EVERY, NEAREST = 20, 20


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return hnsw.nearest(vectors, vectors.where(F.col("vec_id") % ASK_EVERY == 0), NEAREST)


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_simhash_dedup": op3_simhash_dedup,
    "op4_language_id": op4_language_id,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_bpe": op9_bpe,
    "op10_line_dedup": op10_line_dedup,
    "op11_alignment": op11_alignment,
    "op12_repair": op12_repair,
    "op13_nearest": op13_nearest,
}
