"""Entity resolution: records of one key merged by a rule per column, as ordered aggregates.

Records arrive in the order of `ord`. Folding them left to right by the rules below equals, column by column, an
aggregate with partial results on the map side, so a key with many records is no single task's load.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showbill.functions.text import compact_title

# Texts that stand for a missing value.
PLACEHOLDERS = ("地點待確認", "時間待確認", "詳見活動頁面", "請見活動頁面")


def newest(c: str, order: str = "ord") -> Column:
    """The latest value that isn't null or empty."""
    return F.max_by(F.when(F.col(c).cast("string") != "", F.col(c)), F.when(F.col(c).cast("string") != "", F.col(order)))


def oldest(c: str, order: str = "ord") -> Column:
    return F.min_by(F.when(F.col(c).cast("string") != "", F.col(c)), F.when(F.col(c).cast("string") != "", F.col(order)))


def newest_known(c: str, order: str = "ord", placeholders: tuple[str, ...] = PLACEHOLDERS) -> Column:
    """The latest real value; failing that, the first placeholder."""
    real = (F.col(c) != "") & ~F.col(c).isin(*placeholders)
    stub = F.col(c).isin(*placeholders)
    return F.coalesce(F.max_by(F.when(real, F.col(c)), F.when(real, F.col(order))), F.min_by(F.when(stub, F.col(c)), F.when(stub, F.col(order))))


def longest(c: str, order: str = "ord") -> Column:
    """The longest value, the later of equals."""
    kept = F.when(F.col(c) != "", F.struct(F.length(c).alias("n"), F.col(order).alias("o")))
    return F.max_by(F.col(c), kept)


def best_venue(c: str, poor: Column, order: str = "ord", placeholders: tuple[str, ...] = PLACEHOLDERS) -> Column:
    """The latest venue that is neither a placeholder nor poor; then a first placeholder that isn't poor; then the latest real one; then the first."""
    filled, stub = F.col(c) != "", F.col(c).isin(*placeholders)
    last = lambda ok: F.max_by(F.when(ok, F.col(c)), F.when(ok, F.col(order)))
    first = F.min_by(F.when(filled, F.struct(F.col(c).alias("v"), stub.alias("stub"), poor.alias("poor"))), F.when(filled, F.col(order)))
    return F.coalesce(last(filled & ~stub & ~poor), F.when(first["stub"] & ~first["poor"], first["v"]), last(filled & ~stub), first["v"])


def best_source(fields: list[str], quality: Column, usable: Column, order: str = "ord") -> Column:
    """A struct of the fields of the record of highest quality among the usable; the older of equals."""
    return F.max_by(F.struct(*fields), F.when(usable, F.struct(quality.alias("q"), (-F.col(order)).alias("o"))))


def ordered_distinct(c: str, order: str = "ord", descending: bool = False, most: int | None = None) -> Column:
    """The elements of array column c over all records in order, each once at its first place.

    All arrays of a key meet in one task: for keys with few records. records.first_places combines elements first.
    """
    rows = F.array_sort(F.collect_list(F.struct((-F.col(order) if descending else F.col(order)).alias("o"), F.col(c).alias("v"))))
    out = F.array_distinct(F.flatten(F.transform(rows, lambda r: F.coalesce(r["v"], F.array()))))
    return F.slice(out, 1, most) if most else out


def merge_records(records: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """One row per key by the rules; rows whose key is null or empty stay single."""
    alone = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    keyed = records.withColumn("_key", F.when(alone, F.concat(F.lit("row:"), F.col("ord").cast("string"))).otherwise(F.concat(F.lit("key:"), F.col(key).cast("string"))))
    return keyed.groupBy("_key").agg(*[c.alias(n) for n, c in rules.items()]).drop("_key")


def union_ordered(*frames: DataFrame) -> DataFrame:
    """The union of feeds, with an `ord` that puts earlier feeds first; each frame has an `ord` of its own."""
    placed = [f.withColumn("ord", F.lit(i * (1 << 40)).cast("long") + F.col("ord")) for i, f in enumerate(frames)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), placed)


def semantic_key(title: str, start: str, end: str) -> Column:
    """Compact title and dates, a missing end being the start; null without title or start."""
    t = compact_title(title)
    return F.when((t != "") & F.col(start).isNotNull(), F.concat_ws("|", t, F.col(start).cast("string"), F.coalesce(F.col(end), F.col(start)).cast("string")))


def upsert(existing: DataFrame, incoming: DataFrame, key: str, columns: list[str], now: Column) -> DataFrame:
    """The snapshot after an update: newest values, the earliest first_seen, and last_seen set for keys that came in.

    existing: key, columns, first_seen, last_seen; incoming: key, columns, ord. One shuffle for both sides.
    """
    old = existing.select(key, *columns, "first_seen", "last_seen", F.lit(-1).cast("long").alias("ord"))
    new = incoming.select(key, *columns, now.alias("first_seen"), now.alias("last_seen"), F.col("ord").cast("long").alias("ord"))
    return old.unionByName(new).groupBy(key).agg(*[newest(c).alias(c) for c in columns], F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"))
