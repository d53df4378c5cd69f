"""The operators applied with production parameters to their whole tables: name -> f(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paymart.llm import caps, chat, lattice, line_crf, merkle, minhash, packing, pii, rans, repeats, secrets, shards, spelling
from paymart.llm.common import table


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(chat.injected(spark))
    return chat.read_back(chat.format_turns(rows.withColumn("parts", chat.text_parts(F.col("text")))))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op5_rans_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = rans.encoded_path(spark)
    rans.write_ids(table(spark, sf_dir, "documents"), path)
    return rans.read_ids(spark, path, digest=True)


def op6_cap_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(table(spark, sf_dir, "documents"))


def op8_uniform_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return shards.uniform_shards(rows, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.sample_segmentations(table(spark, sf_dir, "documents"), digest=True)


def op10_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_level_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(repeats.remove_repeats(table(spark, sf_dir, "documents")))


def op12_spelling_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.corpus_words(table(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": op1_minhash_near_dedup,
    "op2_line_quality": op2_line_quality,
    "op3_chat_formatting": op3_chat_formatting,
    "op4_secret_scan": op4_secret_scan,
    "op5_rans_token_ids": op5_rans_token_ids,
    "op6_cap_near_vectors": op6_cap_near_vectors,
    "op7_feistel_pseudonyms": op7_feistel_pseudonyms,
    "op8_uniform_shards": op8_uniform_shards,
    "op9_gumbel_segmentations": op9_gumbel_segmentations,
    "op10_hierarchical_packing": op10_hierarchical_packing,
    "op11_level_doubling": op11_level_doubling,
    "op12_spelling_tiles": op12_spelling_tiles,
    "op13_merkle_manifest": op13_merkle_manifest,
}
