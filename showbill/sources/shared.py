"""Intermediate tables in the folder that all machines share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one in local mode only, where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = f"file://{tempfile.mkdtemp(prefix='showbill-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: a loop's next step starts from its files and not from all steps before, and lost executors repeat one step."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/showbill/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt over all cores by a key, some tasks each: rows of a few small files that large expressions are to run over. A number that is given isn't merged by adaptive execution."""
    spark = df.sparkSession
    return df.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *by)
