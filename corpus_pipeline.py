"""The corpus pipeline: five operators of ``martflow.llm``, one after the other.

Each stage gets the documents that its predecessor kept, written as Parquet and
read again.  The first four return documents; the last returns packed rows of
token ids, with ``batch`` for their order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martflow.llm.common import materialize, table
from martflow.llm.golay_dedup import keep_one
from martflow.llm.packing import packed
from martflow.llm.pfair_mix import mixed
from martflow.llm.quality_rules import keep_good
from martflow.llm.string_tiling import clean


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble scores at 0.5 or more."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return keep_one(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids, in numbered batches that follow the mix: files
    are read in any order, so the documents take their places again."""
    return packed(mixed(docs), numbered=True)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", tokens),
]
#: Tree fitting, Golay decoding, tiling and byte-pair encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
