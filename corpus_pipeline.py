"""Corpus pipeline: quality rules, near-duplicate removal, source mixing, tokenising.

Each stage calls one operator of ``lakeloom.llm`` on everything that its predecessor kept.
Rows of a stage's input may hold nulls, repeat each other or be missing altogether; the
operators' docstrings define what becomes of them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lakeloom.llm import mixing, quality, sentencepiece_codec, simhash
from lakeloom.llm.common import discard, read, working_tables, written

#: The mixture is to hold the tokens expected of the clean domain and no others, no document
#: twice: rates of clean documents stay 1 or nearly so, those of toxic and junk documents fall to 0.
MIX = mixing.Mix({"clean": 1.0, "junk": 0.0, "toxic": 0.0}, total="clean", max_rate=1.0)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_used: list[str] = []  # working tables of the stage before


def _clears(stage: Stage) -> Stage:
    """Delete the working tables of the stage before: its result has been written, as ``docs`` is read
    from files. Where ``docs`` still reads one of them, they stay."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {path.rsplit("/", 1)[1] for path in _used}
        if not any(f"/{name}/" in file for name in names for file in docs.inputFiles()):
            discard(spark, _used)
            _used.clear()
        with working_tables() as tables:
            out = stage(spark, docs, sf_dir)
        _used.extend(tables)
        return out

    return run_stage


@_clears
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cutoffs calibrated on the labelled ones."""
    return quality.quality_filter(docs, read(spark, sf_dir, "labels"))


@_clears
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 4 bits of 64, over 4-word shingles."""
    place = simhash.FILE_PLACE if docs.inputFiles() else None  # None: rows that are no table's
    return simhash.drop_near_duplicates(docs, shingle=4, max_bits=4, place=place)


@_clears
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that make the mixture clean; none is repeated."""
    return mixing.mix_rows(docs, read(spark, sf_dir, "labels"), mixing.quality_domain(), MIX)


@_clears
def sentencepiece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every document left."""
    return sentencepiece_codec.encode_table(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("sentencepiece_ids", sentencepiece_ids),
]

#: The stages count binomial tails, hash shingles, train a classifier and run Viterbi: not SQL.
#: tests/llm/test_pipeline.py checks the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
    return docs
