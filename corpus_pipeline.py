"""The corpus pipeline: stages over documents, each by one operator of grainmart.llm."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from grainmart.llm.byte_bpe import round_trip
from grainmart.llm.common import table, written
from grainmart.llm.exact_dedup import drop_exact_copies
from grainmart.llm.mix_sources import mixed
from grainmart.llm.ngram_join import drop_near_copies
from grainmart.llm.toxicity import without_toxic


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier, learned on the labels of table labels, does not reject.

    A row goes by its own text only, whatever rows share its id; null and empty texts are scored as empty.
    """
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is identical but for white space; null and empty texts are one group."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity of 0.8 or more; texts without words all stay."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for every copy that a document gets; a null source is a source."""
    return mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded bytes of every row of the mix; null has no tokens."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", not_toxic), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mix_sources", mix), ("byte_bpe", encode)]

# The classifier, the draws of the mix and the encoder are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from table documents on; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
