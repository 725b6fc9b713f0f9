"""The corpus pipeline: five stages, each one operator of ``tabflow.llm`` over all its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``. Stages 1 to 4 return the columns of
``documents``; the last adds ``copies`` and ``taken``. Extra columns are carried along, null
texts count as empty, an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabflow.llm import decontam, mixing, quality, secret_scan, simhash
from tabflow.llm.common import stored, table
from tabflow.session import configure


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level classifier does not reject; learnt from the labels outside fold 0."""
    configure(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: the one with the smallest id."""
    configure(spark)
    return simhash.deduplicate(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    configure(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets that the blob ledger finds masked in their texts."""
    configure(spark)
    return secret_scan.redact(docs, secret_scan.Ledger(spark), length_col="n_chars")


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mixture takes, with the number of copies and the words taken."""
    configure(spark)
    return mixing.take(docs)


STAGES = [("quality", good_quality), ("simhash", near_dedup), ("decontamination", decontaminated),
          ("secrets", without_secrets), ("mixing", mixture)]

# a trained network, fingerprints and random rounding: not expressible in SQL (tests compare with brute force)
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
