"""The corpus pipeline: quality filter, near-duplicate removal, source mix, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from finlake.llm import mixing, near_text, quality, sentencepiece
from finlake.llm.shared import stored, table

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of those not held out, predicts to be good."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_text.one_of_each_group(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their whole texts."""
    return sentencepiece.encoded(docs, PIECES)


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_per_group),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding", token_ids),
]

#: Neither the classifier nor SentencePiece can be said in SQL; tests/llm/test_brute_force.py holds every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
