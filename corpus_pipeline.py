"""From documents to packed training sequences: filter, deduplicate, redact, mix, pack.

Every stage takes (spark, docs, sf_dir), works on all documents its predecessor kept, and returns
a DataFrame, which is written as Parquet and read back before the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import mixing, packing, secret_scan, simhash, weak_labels
from orderloom.llm.common import ship_package, staged
from orderloom.llm.queries import tokenizer_path
from orderloom.session import configure


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on these documents, does not reject."""
    ship_package(spark)
    return weak_labels.keep(docs, weak_labels.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link."""
    ship_package(spark)
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.redact(docs, path_column="source")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, cut or left out so that the sources meet their target weights."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents at their places in sequences of 2048 ids."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality classifier", classify_quality),
    ("simhash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: The classifier, fingerprints and tokenizer cannot be expressed in SQL; tests/llm/test_pipeline.py has the plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
