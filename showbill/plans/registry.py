"""All registered queries of the library itself, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from showbill.plans import whole  # noqa: F401  (registers its queries)
from showbill.plans.catalogue import ORACLES, QUERIES


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["listing_filtered_topk"](spark, sf_dir)


__all__ = ["ORACLES", "QUERIES", "flagship"]
