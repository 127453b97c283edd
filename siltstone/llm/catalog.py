"""The queries of this folder's operators over the given tables, and their SQL where it can be written."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.llm import (
    bpe,
    chat,
    decontaminate,
    lines,
    neardup,
    negatives,
    pii,
    quality,
    runs,
    shards,
    token_counts,
    token_files,
    warc,
)
from siltstone.llm.common import strings
from siltstone.session import shared_folder

SHARDS = 24


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def encoded(docs: DataFrame) -> DataFrame:
    """Per document the number of tokens and digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = bpe.Tokenizer(docs.sparkSession, path, public_tokenizers.PATTERN)
    rows = tokenizer.decode(tokenizer.encode(docs.select("doc_id", "text")))
    return rows.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"))


def op2_arc_to_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    records = warc.archive_pages(table(spark, folder, "pages"), path)
    return records.select(
        F.col("record_key").cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op3_weak_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, folder, "documents"), path)


def op5_hyperminhash(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, folder, "documents"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    cleaned = lines.LineIndex(spark).insert(docs).clean(docs)
    return cleaned.select(
        "row.doc_id", "result.n_lines", "result.n_dropped", F.sha2("result.text", 256).alias("kept_sha256")
    )


def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    rows = found.select(
        "doc_id",
        "n_words",
        decontaminate.hit_words(F.col("runs")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


def op8_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"))


def op9_rendezvous(spark: SparkSession, folder: str) -> DataFrame:
    rows = shards.assign(table(spark, folder, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    # One conversation that looks like a template itself.
    more = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    chats = chat.format_chats(given.unionByName(more))
    read = chats.select(
        "conv_id",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("segments")).alias("loss"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
    written_out = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(written_out, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


@F.arrow_udf(T.StringType())
def with_planted_runs(keys: pa.Array, texts: pa.Array) -> pa.Array:
    """In one text of ten, chosen by the key's checksum, the words repeat themselves from some place on."""
    out = []
    for key, text in zip(keys.to_pylist(), strings(texts), strict=True):
        g, chosen = divmod(zlib.crc32(str(key).encode()), 10)
        words = runs.words_of(text) if chosen == 0 and key is not None else []
        if words:
            n = len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words[a:] = [words[a + i % p] for i in range(n - a)]
            text = b" ".join(words).decode("utf-8", "surrogatepass")
        out.append(text)
    return pa.array(out, pa.string())


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", with_planted_runs("doc_id", "text").alias("text"))
    rows = runs.find(docs).select("doc_id", "found.*", runs.densest(F.col("found.runs")).alias("best"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        runs.digest(F.col("runs")).alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = negatives.mine(given.withColumn("label", label), F.col("vec_id") % 100 == 0)
    return rows.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    files = token_files.write_tokens(table(spark, folder, "documents"), path, tokenizer, end=0)
    rows = files.read()
    return rows.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_byte_bpe,
        op2_arc_to_warc,
        op3_weak_pii,
        op4_token_counts,
        op5_hyperminhash,
        op6_line_dedup,
        op7_decontaminate,
        op8_repetition,
        op9_rendezvous,
        op10_chat_format,
        op11_periodic_runs,
        op12_hard_negatives,
        op13_token_files,
        pipeline,
    )
    return {f.__name__: f for f in own}


def oracle_queries() -> dict[str, str]:
    from siltstone.llm.oracle import SQL

    return dict(SQL)
