"""The contract queries of the subpackage and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, html_text, licenses, link_trust, mixing, oracles, periodic, prefix_trie, quality,
               sentencepiece_codec, simhash, token_store, topk, warc)
from .common import read, shared_path


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_table(read(spark, sf_dir, "documents"),
                                            public_tokenizers.path("piece_bpe_32k.model"), verify=True)


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    path = shared_path(spark, "token-store")
    token_store.write_store(read(spark, sf_dir, "documents"), path,
                            lambda: token_store.word_encoder(vocabulary), end_id=1)
    return token_store.read_digests(spark, path)


#: Shares of the tokens that the mixture shall have.
TARGET_WEIGHTS = {"clean": 0.90, "junk": 0.08, "toxic": 0.02}


def op3_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), mixing.quality_domain(),
                          mixing.Mix(TARGET_WEIGHTS))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(read(spark, sf_dir, "pages"))


def op5_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_order(read(spark, sf_dir, "conversations"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integer_vectors(read(spark, sf_dir, "embeddings"), scale=1024.0)
    return topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=10)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents")).drop("blocks", "windows")


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc.responses_of_pages(read(spark, sf_dir, "pages"), date="2026-01-01T00:00:00Z")
    return warc.derivatives(responses, "page_id").drop("record")


def op10_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return groups.select("doc_id", simhash.fingerprint_hex("fp").alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.numbered_turns(read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.branched(turns, group=5, most=8))


URL_RULES = [link_trust.Rule("block", "net"), link_trust.Rule("allow", "example.net", "/en/"),
             link_trust.Rule("block", "example.com", "/de/"), link_trust.Rule("allow", "org", "/fr/")]


def op12_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(periodic.repeat_tails(read(spark, sf_dir, "documents")), min_length=24, min_repeats=3)
    best = found.withColumn("best", periodic.strongest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform("runs", line)), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sentencepiece, op2_token_store, op3_soft_mixing, op4_html_text, op5_chat_threads,
                            op6_exact_topk, op7_quality_rules, op8_license_scan, op9_warc_derivatives,
                            op10_simhash_golay, op11_prefix_trie, op12_link_trust, op13_periodic_runs)}

ORACLES: dict[str, str] = {
    "op6_exact_topk": oracles.TOP_K,
    "op7_quality_rules": oracles.quality_rules(),
    "op8_license_scan": oracles.license_scan(),
    "op12_link_trust": oracles.link_trust_verdicts(URL_RULES),
}
