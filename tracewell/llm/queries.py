"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe_automaton, byte_bpe, language, merkle, packing, pii, prefix_trie, quality, rules, simhash, suffix_dedup, token_files, topk
from .common import new_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pieces(table(spark, sf_dir, "documents")))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.every_twentieth(table(spark, sf_dir, "embeddings"))


def op5_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.digest(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.digest(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rules.judged(docs, rules.fit(docs, table(spark, sf_dir, "labels")))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    return token_files.digest(token_files.read_token_files(spark, folder))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digest(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_packing": op2_packing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_top_k": op4_top_k,
    "op5_bpe_automaton": op5_bpe_automaton,
    "op6_language": op6_language,
    "op7_quality": op7_quality,
    "op8_simhash": op8_simhash,
    "op9_rules": op9_rules,
    "op10_token_files": op10_token_files,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_merkle_manifest": op13_merkle_manifest,
}
CHECKS: dict[str, str] = {"op4_top_k": topk.CHECK, "op11_prefix_trie": prefix_trie.CHECK, "op13_merkle_manifest": merkle.CHECK}
