"""The operators as registered queries: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from comarca.llm import (bit_sliced, bpe, chat, chat_repair, exact_dedup, filter_audit, html_text, minhash, nn_descent,
                         packing, quality, substring_dedup, url_rules)
from comarca.llm.common import table


def op1_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_chat_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns, copies, rendered."""
    return chat.render_chats(table(spark, sf_dir, "conversations"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op4_bpe_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def op5_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


def op7_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_host_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"))


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"))\
        .select("page_id", "host", "path", "rule", "verdict")


def op11_audit_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_scores(table(spark, sf_dir, "embeddings"))


def op13_filter_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_rule_ensemble": op1_rule_ensemble,
    "op2_chat_snapshots": op2_chat_snapshots,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_bpe_merge_replay": op4_bpe_merge_replay,
    "op5_circulant_minhash": op5_circulant_minhash,
    "op6_suffix_arrays": op6_suffix_arrays,
    "op7_bm25_packing": op7_bm25_packing,
    "op8_host_consensus": op8_host_consensus,
    "op9_nn_descent": op9_nn_descent,
    "op10_url_rules": op10_url_rules,
    "op11_audit_paths": op11_audit_paths,
    "op12_bit_sliced": op12_bit_sliced,
    "op13_filter_lattice": op13_filter_lattice,
}
