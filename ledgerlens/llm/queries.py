"""Queries of the driver contract for the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    crf_langid, curriculum_mix, hash_tree, html_main_text, merkle_manifest, mph_dedup, quality_rules, sp_chunks,
    token_alignment, token_files, token_rollup, trie_join, warc_chunks,
)

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_main_text.extracted(pages, html_main_text.learned(pages))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chunks.round_trip(table(spark, sf_dir, "pages"))


def op4_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.whole_totals(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)


def op5_sp_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_chunks.encoded(table(spark, sf_dir, "documents"), sp_chunks.model_bytes(PIECE_MODEL))


def op6_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    join = trie_join.TrieJoin(shingle=4, similarity=trie_join.Similarity(85))
    return trie_join.similar(table(spark, sf_dir, "documents"), join)


def op7_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum_mix.mixed(table(spark, sf_dir, "documents"))


def op8_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.sharded(table(spark, sf_dir, "documents"))


def op9_crf_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return crf_langid.identified(docs, crf_langid.learned(docs))


def op10_mph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mph_dedup.dedup(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(table(spark, sf_dir, "documents"), token_files.vocabulary(BPE_JSON),
                                   sp_chunks.model_bytes(PIECE_MODEL))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), token_files.vocabulary(BPE_JSON), end=2)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_main_text": op1_html_main_text,
    "op2_quality_rules": op2_quality_rules,
    "op3_warc_chunks": op3_warc_chunks,
    "op4_token_rollup": op4_token_rollup,
    "op5_sp_chunks": op5_sp_chunks,
    "op6_trie_join": op6_trie_join,
    "op7_curriculum_mix": op7_curriculum_mix,
    "op8_hash_tree": op8_hash_tree,
    "op9_crf_langid": op9_crf_langid,
    "op10_mph_dedup": op10_mph_dedup,
    "op11_token_alignment": op11_token_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_files": op13_token_files,
}
