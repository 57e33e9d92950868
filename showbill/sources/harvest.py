"""Feeds as a Spark data source: a partition per feed, so that feeds are fetched side by side, each with its retries.

    register(spark, fetch)
    spark.read.format("showbill_feeds").option("feeds", "all,1,2").load()

fetch(method, feed) returns a response's text or raises; it runs in the tasks and must be picklable. `recorded(folder)` is one
that reads responses kept as files, {folder}/{method}/{feed}.json, from any file system that pyarrow knows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: The methods by which a feed is asked, in order (fixed values of the service).
METHODS = ("doFindTypeJ", "doFindTypeJOpenApi")
ENVELOPES = ("events", "data", "result")
SCHEMA = "feed string, feed_ord int, at int, record string, error string"


class FeedPartition(InputPartition):
    def __init__(self, number: int, feed: str):
        super().__init__(number)
        self.number, self.feed = number, feed


def records_of(response: str) -> list[dict]:
    """The records of a response: an array, or one named events, data or result. A response without any is an error, so that the next method is asked."""
    payload = json.loads(response)
    if isinstance(payload, dict):
        payload = next((payload[n] for n in ENVELOPES if payload.get(n)), [])
    if not isinstance(payload, list):
        raise ValueError("the response is not an array")
    found = [r for r in payload if isinstance(r, dict)]
    if not found:
        raise ValueError("the response has no records")
    return found


def source(fetch: Callable[[str, str], str], name: str = "showbill_feeds") -> type[DataSource]:
    """The data source that gets its responses from fetch(method, feed)."""

    class Feeds(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.feeds = [f for f in options.get("feeds", "all").split(",") if f]
            self.retries = int(options.get("retries", "3"))

        def partitions(self) -> list[FeedPartition]:
            return [FeedPartition(i, f) for i, f in enumerate(self.feeds)]

        def read(self, partition: FeedPartition) -> Iterator[tuple]:
            """The feed's records, or one row without a record that tells its last errors."""
            errors = []
            for method in METHODS:
                for attempt in range(1, self.retries + 1):
                    try:
                        found = records_of(fetch(method, partition.feed))
                    except Exception as e:  # any failure of one request is told, and the next is made
                        errors.append(f"{method} attempt {attempt}/{self.retries}: {e}")
                        continue
                    for at, record in enumerate(found):
                        record.setdefault("_feedCategory", partition.feed)
                        yield partition.feed, partition.number, at, json.dumps(record, ensure_ascii=False), None
                    return
            yield partition.feed, partition.number, None, None, " | ".join(errors[-3:])

    return Feeds


def recorded(folder: str) -> Callable[[str, str], str]:
    """Responses kept as files under a URI."""

    def fetch(method: str, feed: str) -> str:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(f"{folder}/{method}/{feed}.json")
        with system.open_input_stream(path) as f:
            return f.read().decode("utf-8")

    return fetch


def register(spark: SparkSession, fetch: Callable[[str, str], str], name: str = "showbill_feeds") -> None:
    spark.dataSource.register(source(fetch, name))


def harvested(spark: SparkSession, feeds: list[str], retries: int = 3, name: str = "showbill_feeds") -> tuple[DataFrame, DataFrame]:
    """(records, failures): raw (VARIANT), file (the feed) and ord, by feed and place, as records.typed() takes them; feed and error of feeds that gave none.

    All feeds are fetched once and written, so that both frames and all that follows read one and the same harvest.
    """
    from showbill.sources.shared import written

    rows = written(spark.read.format(name).option("feeds", ",".join(feeds)).option("retries", str(retries)).load())
    got = rows.where("record is not null").select(F.parse_json("record").alias("raw"), F.col("feed").alias("file"), (F.col("feed_ord").cast("long") * (1 << 32) + F.col("at")).alias("ord"))
    return got, rows.where("error is not null").select("feed", "error")
