"""Counts for facets, snapshots and calendars."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def label_counts(events: DataFrame) -> DataFrame:
    """category and n over all labels; an event without labels counts for its one category."""
    labels = F.when(F.size("categories") > 0, F.col("categories")).otherwise(F.array("category"))
    return events.select(F.explode(labels).alias("category")).where("category <> ''").groupBy("category").agg(F.count("*").alias("n"))


def top_counts(events: DataFrame, by: str, k: int) -> DataFrame:
    return events.where(F.col(by).isNotNull() & (F.col(by) != "")).groupBy(by).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by).limit(k)


def region_venues(events: DataFrame) -> DataFrame:
    """Totals by region, and by region and venue, from one scan; the venue of a total is null."""
    return events.groupingSets([["region"], ["region", "venue"]], "region", "venue").agg(F.count("*").alias("n"))


def enumerated(column: Column | str, order: Sequence[str], otherwise: int = 99) -> Column:
    """A value's place in a fixed enumeration, for sorting; values that aren't in it come last."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(column) if isinstance(column, str) else column)
    return F.when(at > 0, at - 1).otherwise(otherwise)


def category_strip(events: DataFrame, order: Sequence[str], k: int = 12) -> DataFrame:
    """place, category and n of the first k categories that occur, in the order of the enumeration; others come after it, by name."""
    rank = enumerated("category", order)
    top = label_counts(events).withColumn("_rank", rank).orderBy("_rank", "category").limit(k)
    return top.select(F.row_number().over(Window.orderBy("_rank", "category")).alias("place"), "category", "n")


def region_facets(events: DataFrame, regions: Sequence[str], collation: str = "zh_Hant") -> DataFrame:
    """region, venue, n, region_place and venue_place: every enumerated region that has events, with its total (venue null, place 0), and its venues by number
    and then by name as readers of `collation` order names. One scan for both levels; sums are few rows, and only those are ordered. Venues without a name are counted for the region alone."""
    counts = events.where(F.col("region").isin(*regions)).groupingSets([["region"], ["region", "venue"]], "region", "venue").agg(F.count("*").alias("n"), F.grouping("venue").alias("_total"))
    named = counts.where((F.col("_total") == 1) | (F.coalesce("venue", F.lit("")) != ""))
    of_region = Window.partitionBy("region").orderBy(F.desc("_total"), F.desc("n"), F.collate("venue", collation), "venue")
    return named.select("region", F.when(F.col("_total") == 0, F.col("venue")).alias("venue"), "n", enumerated("region", regions).alias("region_place"), (F.row_number().over(of_region) - 1).alias("venue_place"))


def snapshot(events: DataFrame) -> DataFrame:
    """One row of counts and shares; a share of nothing is 0."""
    share = lambda c: F.coalesce(F.bround(F.try_divide(F.count_if(c).cast("double"), F.count("*").cast("double")), 4), F.lit(0.0))
    image, place = F.coalesce(F.col("image"), F.lit("")) != "", F.col("lat").isNotNull() & F.col("lon").isNotNull()
    return events.agg(F.count("*").alias("event_count"), F.count_if(image).alias("image_count"), F.count_if(place).alias("coordinate_count"), share(image).alias("image_coverage"), share(place).alias("coordinate_coverage"))


def calendar(events: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """day and n for every day from first to last, days without events included.

    An interval adds 1 on its first day and -1 after its last; running totals over the days, of which there are few,
    give the counts. So no event is multiplied by its length.
    """
    spark = events.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    lo = F.greatest(F.coalesce("start", "end"), F.lit(first))
    hi = F.least(F.coalesce("end", "start"), F.lit(last))
    held = events.select(lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    steps = held.groupBy("lo", "hi").agg(F.count("*").alias("n"))
    change = steps.select(F.explode(F.array(F.struct(F.col("lo").alias("day"), F.col("n").alias("step")), F.struct(F.date_add("hi", 1).alias("day"), (-F.col("n")).alias("step")))).alias("s")).groupBy("s.day").agg(F.sum("s.step").alias("step"))
    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.join(F.broadcast(change), "day", "left").select("day", F.sum(F.coalesce("step", F.lit(0))).over(running).alias("n"))
