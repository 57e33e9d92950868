"""A published snapshot: whole versions side by side, and a pointer to the one that readers see.

    {base}/versions/{name}/events    the records, Parquet
    {base}/versions/{name}/stats     one JSON row: when, and the counts
    {base}/current                   the name of the version that is read

A version is written under a name of its own and counts only once the pointer names it. The pointer is replaced by a rename, which file systems
do in one step; until then, and after a failure, readers see the version before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showbill.functions import urls


def _system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop, at.getFileSystem(spark._jsc.hadoopConfiguration())


def stats(events: DataFrame, updated: str) -> DataFrame:
    """One row: updatedAt and the counts and shares that are published with the records; shares of nothing are 0."""
    held = events.select(
        (urls.normalize_url("image") != "").alias("i"), (F.size("images") > 1).alias("m"), (F.col("lat").isNotNull() & F.col("lon").isNotNull()).alias("p"),
        F.filter(F.when(F.size("categories") > 0, F.col("categories")).otherwise(F.array("category")), lambda c: F.coalesce(c, F.lit("")) != "").alias("c"),
    )
    labels = held.select(F.explode("c").alias("c")).groupBy("c").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n")))).alias("categoryCounts"))
    share = lambda c: F.round(F.coalesce(F.try_divide(F.count_if(c), F.count("*")), F.lit(0.0)), 4)
    whole = held.agg(F.count("*").alias("eventCount"), F.count_if("i").alias("imageCount"), F.count_if("m").alias("multiImageCount"), F.count_if("p").alias("coordinateCount"), share("i").alias("imageCoverage"), share("p").alias("coordinateCoverage"))
    return whole.select(F.lit(updated).alias("updatedAt"), "*", labels.scalar().alias("categoryCounts"))


def _point(spark: SparkSession, base: str, name: str) -> None:
    """Points readers to a version: a file beside the pointer takes its place in one step."""
    hadoop, system = _system(spark, base)
    staged = hadoop.Path(f"{base}/.current-{name}")
    out = system.create(staged, True)
    try:
        out.writeBytes(name)
    finally:
        out.close()
    context = hadoop.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    overwrite = spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
    options = spark._jvm.java.lang.reflect.Array.newInstance(overwrite, 1)
    options[0] = spark._jvm.java.lang.Enum.valueOf(overwrite, "OVERWRITE")
    context.rename(system.makeQualified(staged), system.makeQualified(hadoop.Path(f"{base}/current")), options)


def publish(events: DataFrame, base: str, updated: str, **beside: DataFrame) -> str:
    """Writes a version with its stats, and any tables beside them, and then points readers to it; the version's name. Stats are counted from what was written.

    If anything fails before the pointer is replaced, readers keep the version before. Of two writers at a time, the later pointer holds; both
    versions are whole. Versions that nothing points to stay until prune() is called.
    """
    spark, name = events.sparkSession, uuid.uuid4().hex
    folder = f"{base}/versions/{name}"
    events.write.parquet(f"{folder}/events")
    stats(spark.read.parquet(f"{folder}/events"), updated).coalesce(1).write.json(f"{folder}/stats")
    for part, df in beside.items():
        df.write.parquet(f"{folder}/{part}")
    _point(spark, base, name)
    return name


def put(df: DataFrame, base: str) -> str:
    """A table of any columns as a version of its own; read it as part `table`."""
    name = uuid.uuid4().hex
    df.write.parquet(f"{base}/versions/{name}/table")
    _point(df.sparkSession, base, name)
    return name


def current(spark: SparkSession, base: str) -> str | None:
    """The name of the version that readers see; null before the first."""
    hadoop, system = _system(spark, base)
    pointer = hadoop.Path(f"{base}/current")
    if not system.exists(pointer):
        return None
    stream = system.open(pointer)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def read(spark: SparkSession, base: str, part: str = "events") -> DataFrame:
    """The records, or another part, of the version that is current now; a frame stays with its version when another is published."""
    name = current(spark, base)
    if name is None:
        raise ValueError(f"nothing is published under {base}")
    return spark.read.parquet(f"{base}/versions/{name}/{part}")


def read_stats(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.json(f"{base}/versions/{current(spark, base)}/stats")


def prune(spark: SparkSession, base: str) -> list[str]:
    """Deletes all versions but the current one; call it when no reader holds an older one. The names that went."""
    hadoop, system = _system(spark, base)
    name, gone = current(spark, base), []
    for status in system.listStatus(hadoop.Path(f"{base}/versions")):
        if status.getPath().getName() != name:
            system.delete(status.getPath(), True)
            gone.append(status.getPath().getName())
    return gone
