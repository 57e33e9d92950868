"""The snapshot kept up to date from a stream, a batch at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from showbill.operators.resolve import upsert


def keep_snapshot(incoming: DataFrame, base: str, checkpoint: str, key: str, columns: list[str], order: str) -> StreamingQuery:
    """Starts a query that merges each batch into a snapshot under `base`.

    Every batch writes a version of its own, named by the batch's number, and reads the one before. So a batch that runs
    again after a failure writes the same version, and readers of a finished version aren't disturbed.
    incoming: key, columns and `order`, by which the last record of a key wins.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.select(key, *columns, F.col(order).cast("long").alias("ord"))
        now = F.lit(number).cast("long")
        if number == 0:
            old = rows.limit(0).select(key, *columns, now.alias("first_seen"), now.alias("last_seen"))
        else:
            old = spark.read.parquet(version(base, number - 1))
        upsert(old, rows, key, columns, now).write.mode("overwrite").parquet(version(base, number))

    return incoming.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def version(base: str, number: int) -> str:
    return f"{base}/version={number:010d}"


def windowed_counts(events: DataFrame, late: str = "1 day", window: str = "1 hour") -> DataFrame:
    """Counts and sums per event type and window of event time; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")
