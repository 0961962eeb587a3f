"""One query for each operator, with production parameters, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    ann, clustering, decontam, jaccard, language, licenses, middle, oracles, packing, pii, secret_scan, simhash, urls, warc,
)
from tidemark.session import tune

QUERIES: list[tuple] = []

# The rules of the URL query.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def query(name: str, statement: str | None = None):
    def register(fn):
        QUERIES.append((name, fn, statement))
        return fn

    return register


# Texts reach Python in batches of bounded size.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def settings(spark: SparkSession) -> SparkSession:
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


@query("op2_license_scan", oracles.license_report())
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(licenses.scan_licenses(table(spark, sf_dir, "documents")))


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query("op9_pii", oracles.personal_data())
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.pii_spans(table(spark, sf_dir, "documents")))


@query("op10_url_filter", oracles.url_filter(URL_RULES))
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op8_jaccard_join", oracles.jaccard_components())
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query("op4_warc_chain", oracles.warc())
def op4_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@query("op5_decontaminate", oracles.contained_items())
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op6_learned_partitions")
def op6_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


@query("op7_best_fit_packing")
def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), packing.default_vocabulary())
    return packing.pack(pieces).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op11_fill_in_middle", oracles.fill_in_middle())
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return middle.middle_digest(middle.fill_in_middle(table(spark, sf_dir, "documents")))


@query("op12_simhash_dedup")
def op12_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query("op13_centroid_clustering", oracles.centroid_clusters())
def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings")).drop("centroid")
