"""Session settings that the library's queries assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC keeps date arithmetic free of a machine's zone; AQE splits skewed joins and merges small partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str = "local[*]", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    """A session with the library's settings; on a cluster pass the cluster's master and a partition count to match."""
    builder = SparkSession.builder.master(master).appName("showbill")
    for k, v in (SETTINGS | {"spark.sql.shuffle.partitions": str(shuffle_partitions)} | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
