"""The operators as queries on the test tables, and the SQL they must agree with where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import configure, shared_dir

from . import centroid_clustering, fill_in_middle, license_scan, minhash, mixing, oracles, packing, quality_rules, secret_scan, simhash, suffix_dedup, url_rules, warc_packages, weak_labels
from .common import ship_package

URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return planned.selectExpr(
        "row.doc_id", "size", "source_size", "target", "epochs * size + extra AS taken", "epochs", "extra"
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), url_rules.rules_frame(spark, URL_RULES))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return weak_labels.judge(docs, weak_labels.fit(docs, _table(spark, sf_dir, "labels")))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"), path_column="source").drop("row_key")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge_quality(_table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return license_scan.scan(docs.select("doc_id", "text", F.concat_ws("/", "source", "lang", F.concat("doc_id", F.lit(".txt"))).alias("path")))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clustering.cluster(_table(spark, sf_dir, "embeddings")).drop("compared")


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle.transform(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_in_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    records = warc_packages.read_packages(warc_packages.write_packages(pages, shared_dir(spark, "warc")))
    number = lambda c: F.when(F.col(c) != "", F.col(c)).cast(pages.schema["page_id"].dataType)
    return records.select(number("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_packing,
        op2_mix_sources,
        op3_fingerprints,
        op4_url_filter,
        op5_quality_classifier,
        op6_suffix_dedup,
        op7_secret_scan,
        op8_quality_rules,
        op9_license_scan,
        op10_simhash_near_dedup,
        op11_centroid_clusters,
        op12_fill_in_middle,
        op13_warc_packages,
    )
}

#: Tokenizers, MinHash, XXH64, trained models and the licence search's weights are tested against plain versions instead.
ORACLES: dict[str, str] = {
    "op2_mix_sources": oracles.MIX,
    "op4_url_filter": oracles.url_filter(URL_RULES),
    "op6_suffix_dedup": oracles.REPEATS,
    "op8_quality_rules": oracles.QUALITY,
    "op11_centroid_clusters": oracles.CLUSTERS,
    "op12_fill_in_middle": oracles.MIDDLES,
    "op13_warc_packages": oracles.REVISITS,
}
