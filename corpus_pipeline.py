"""The corpus pipeline: quality rules, near-dedup, PII, mixing sources, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from panelscope.llm import bpe, mixing, neardup, pii, quality
from panelscope.llm.queries import BPE_FILE, TOKENIZER_DIR
from panelscope.llm.stash import stash
from panelscope.llm.text import read


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines above the limits go from the others. The share of a host guards only lines of less than five words."""
    return quality.filter_documents(docs, limits=quality.Limits(alone_words=5))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, similarity of 0.8 or more): the one with the smallest id."""
    return neardup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to tags."""
    return pii.mask_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stand as often as the mix takes them."""
    return mixing.mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives the text back: doc_id, source, n_tokens, tokens, round_trip."""
    return bpe.encode_documents(docs, os.path.join(TOKENIZER_DIR, BPE_FILE))


STAGES = [("quality rules", quality_rules), ("minhash near-dedup", near_dedup), ("pii", personal_data),
          ("mixing sources to target weights", mix_sources), ("bpe encoding and decoding", tokens)]

#: SQL has no byte-pair encoding nor expectation-maximisation; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read by the next."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
