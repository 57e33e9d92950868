"""What several corpus operators share: words, tables in the shared folder, and skew-safe lookups and sums."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: White space and words as the operators' contracts define them (Java and RE2 syntax alike).
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"
#: The same six bytes, for Python's bytes methods; bytes.split() splits at exactly these.
SPACE_BYTES = b" \t\n\x0b\x0c\r"


_kept: dict = {}


def kept(key, make):
    """What make() builds in a Python worker, kept between its tasks; only the last operator's, as workers outlive stages."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most `rows` rows, so that a Python worker holds few texts as objects at a time."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only in local mode where the session names none, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = f"file://{tempfile.mkdtemp(prefix='showbill-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back.

    Cuts the lineage, survives lost executors, tells the planner the size, and leaves a plain scan under later
    joins, so that adaptive execution can split their skewed partitions.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/showbill/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def heavy_light_lookup(rows: DataFrame, table: DataFrame, on: str, size: str, total: DataFrame, share: int = 1000) -> DataFrame:
    """Inner join of rows with a table that has one row per key and the number of rows of that key in `size`.

    Keys that hold over 1/share of all rows are fewer than `share`, whatever the data: their part of the table is
    broadcast. The rest is joined by a shuffle, where no key holds more than 1/share of the rows. total: a
    one-row, one-column frame with the number of rows.
    """
    bar = F.col("_total") / share
    marked = table.withColumn("_total", total.scalar())
    heavy = marked.where(F.col(size) > bar).drop("_total")
    light = marked.where(F.col(size) <= bar).drop("_total")
    hot = rows.join(F.broadcast(heavy), on)
    rest = rows.join(F.broadcast(heavy.select(on)), on, "left_anti")
    return hot.unionByName(rest.join(light, on))


def running_sum(df: DataFrame, key: str, bucket: Column, order: Sequence[Column], value: Column, out: str) -> DataFrame:
    """Adds the sum of `value` over the rows of a key that come earlier in (bucket, *order).

    The sum is taken in two levels: sums by (key, bucket), then rows within a bucket; so a key of any size is
    spread over as many tasks as it has buckets. df is read twice and must give the same rows both times.
    """
    marked = df.withColumn("_bucket", bucket).withColumn("_value", value.cast("long"))
    sums = marked.groupBy(key, "_bucket").agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(key, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = marked.withColumn("_local", F.coalesce(F.sum("_value").over(within), F.lit(0)))
    joined = local.join(offsets, [key, "_bucket"])
    return joined.withColumn(out, F.col("_offset") + F.col("_local")).drop("_bucket", "_value", "_local", "_offset")
