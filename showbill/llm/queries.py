"""The registered corpus queries: thin calls of the operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from showbill.llm import bpe, exact_dedup, filter_audit, langid, license_scan, mixing, near_dedup, packing, pii, ppm, quality, source_audit, toxicity
from showbill.llm.common import documents


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.report(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.report(documents(spark, sf_dir))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(documents(spark, sf_dir))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.report(documents(spark, sf_dir))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(documents(spark, sf_dir))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(documents(spark, sf_dir))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.report(documents(spark, sf_dir))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(documents(spark, sf_dir))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key comes from the session; the fallback is for invented test tables, which hold nobody's data."""
    return pii.report(documents(spark, sf_dir), spark.conf.get("spark.showbill.pii.key", "invented tables only"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.report(documents(spark, sf_dir))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(documents(spark, sf_dir))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_bpe": op4_bpe,
    "op5_mixing": op5_mixing,
    "op6_language": op6_language,
    "op7_lm_score": op7_lm_score,
    "op8_licenses": op8_licenses,
    "op9_pii": op9_pii,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_source_audit": op12_source_audit,
    "op13_packing": op13_packing,
}
ORACLES = {
    "op2_exact_dedup": exact_dedup.ORACLE,
    "op5_mixing": mixing.ORACLE,
    "op8_licenses": license_scan.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_source_audit": source_audit.ORACLE,
}
