"""The thin queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import (
    ann,
    bpe,
    langid,
    mixing,
    packing,
    prefix_trie,
    quality,
    radix_dedup,
    recompression,
    simhash,
    suffix_dedup,
    url_filter,
    vector_codes,
)
from stationlake.llm.common import read_table


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"), url_filter.rules_frame(spark))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)
    return out.select("doc_id", "fingerprint", "component_id")


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(read_table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "domain", "lang", "source", "n_tokens", "epoch", "take_tokens")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_bytes(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratings = quality.grades_from_labels(read_table(spark, sf_dir, "labels"))
    return quality.classify(read_table(spark, sf_dir, "documents"), ratings)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = radix_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = recompression.remove_repeated_words(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(read_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    trie = prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))
    no_ends = F.sha2(F.lit("").cast("binary"), 256)
    return trie.nodes.join(prefix_trie.end_digests(trie.ends), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", no_ends).alias("ends_sha256"),
    )


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.decode(bpe.encode(read_table(spark, sf_dir, "documents")))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, _ = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    return codes


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_simhash": op2_simhash,
    "op3_langid": op3_langid,
    "op4_mixing": op4_mixing,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_quality": op6_quality,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_ann": op8_ann,
    "op9_recompression": op9_recompression,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe": op12_bpe,
    "op13_vector_codes": op13_vector_codes,
}
