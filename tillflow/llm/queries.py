"""The operators of this package as queries over the whole given tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import (
    decontamination, divergence, fingerprints, language_id, license_scan, line_dedup, merkle, near_dedup, packing,
    quality_classifier, quality_rules, url_filter, warc,
)
from tillflow.llm.common import new_path, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_line_dedup(spark, sf_dir):
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query
def op2_license_scan(spark, sf_dir):
    return license_scan.scan(_table(spark, sf_dir, "documents"), license_scan.notices(spark))


@query
def op3_decontamination(spark, sf_dir):
    return decontamination.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op4_quality_rules(spark, sf_dir):
    measured = quality_rules.add_features(_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return quality_rules.judge(staged(measured.drop("text"), "features")).drop("source")


@query
def op5_url_filter(spark, sf_dir):
    labelled = spark.createDataFrame(url_filter.labelled_urls(), "url string, label int")
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, url_filter.train(labelled)).drop("url")


@query
def op6_warc(spark, sf_dir):
    path = new_path(spark, "warc")
    warc.write_warc(warc.page_records(_table(spark, sf_dir, "pages")), path)
    records = warc.read_warc(spark, path, payload=True)
    is_response = F.col("record_type") == "response"
    return records.select(
        warc.page_id("record_id").alias("page_id"),
        F.when(is_response, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(is_response, warc.base32(F.unhex(F.sha1("payload")))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        warc.page_id("refers_to").alias("refers_to"),
    )


@query
def op7_quality_classifier(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_classifier.classify(docs, quality_classifier.train(docs)).drop("text")


@query
def op8_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=3, share_percent=85)


@query
def op9_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), packing.tokenizer_path())


@query
def op10_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.train(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@query
def op11_source_divergence(spark, sf_dir):
    return divergence.audit(_table(spark, sf_dir, "documents"))


@query
def op12_merkle_manifest(spark, sf_dir):
    return merkle.verify(merkle.manifest(_table(spark, sf_dir, "documents"), tampered={"text": merkle.dropped_breaks()}))


@query
def op13_fingerprints(spark, sf_dir):
    return fingerprints.compare_edits(_table(spark, sf_dir, "documents"))
