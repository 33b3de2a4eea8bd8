"""From raw documents to token ids: five stages, each written and read again."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402
from pyspark import cloudpickle  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import docloom  # noqa: E402
from docloom.llm import bpe, line_crf, lsh_forest, mixing, suffix_dedup  # noqa: E402
from docloom.llm.common import stage, table  # noqa: E402
from docloom.llm.queries import RANKS  # noqa: E402

# The workers need no copy of the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(docloom)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(line_crf.score_of("text", model) >= line_crf.THRESHOLD)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return lsh_forest.without_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that start earlier in the corpus, too."""
    return suffix_dedup.without_repeats(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    return bpe.encode(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", good_documents),
    ("near-duplicates", without_near_copies),
    ("repeated passages", without_repeats),
    ("source mix", mixed_sources),
    ("token ids", token_ids),
]

#: None: a learnt classifier and a pseudorandom mix have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
