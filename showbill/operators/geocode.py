"""Missing coordinates from a cache and from a geocoder's answers, of which an update may ask for a fixed number.

The geocoder's answers are a table here; which of them an update gets to ask for, what it fills with them and what it
remembers, are the rules of this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showbill.functions.text import clean_text
from showbill.operators import records
from showbill.operators.enrich import in_region
from showbill.sources.shared import written

# Where coordinates come from.
FROM_CACHE, FROM_GEOCODER = "geocode_cache", "nominatim"


def positions(df: DataFrame, *order: Column) -> DataFrame:
    """df with position (from 1) in a global order, which must tell rows apart. In two levels: rows are sorted within ranges of
    the order, and a range's rows are counted from the sum of those before; only the ranges' sizes meet in one task."""
    high, low = 1 << 33, (1 << 33) - 1
    at = written(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    sizes = at.groupBy(F.expr(f"_at div {high}").alias("_range")).agg(F.count("*").alias("_n"))
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    joined = at.withColumn("_range", F.expr(f"_at div {high}")).join(F.broadcast(before), "_range")
    return joined.withColumn("position", F.col("_before") + F.col("_at").bitwiseAND(low) + 1).drop("_at", "_range", "_before")


def candidates(events: DataFrame) -> DataFrame:
    """id, asked (what a geocoder is asked), region, hits and ord of events without coordinates that have a place to ask for."""
    asked = records.geocode_key()
    return events.where(F.col("lat").isNull() & F.col("lon").isNull() & (F.coalesce("venue", F.lit("")) != records.UNKNOWN_VENUE)).select(
        "id", asked.alias("asked"), clean_text("region").alias("region"), F.coalesce(F.col("hits"), F.lit(0)).cast("long").alias("hits"), "ord"
    ).where("asked <> ''")


def geocoded(wanted: DataFrame, cache: DataFrame, answers: DataFrame, most: int = 25) -> tuple[DataFrame, DataFrame]:
    """What an update fills and what it remembers: (id, lat, lon, place_source) and the new cache (asked, lat, lon; nulls where nothing was found).

    wanted: see candidates(), ord tells rows apart; cache: asked, lat, lon, one row per text; answers: asked, lat, lon, failed: what the geocoder says, lat and lon
    null if it found nothing. A text without an answer failed.

    Rows are taken by hits, then ord. A text in the cache costs nothing; any other is asked once, and again by each later row if
    it failed, since failures aren't remembered. At the first row that would need one request more than `most`, the update ends, also for later
    rows that the cache could fill. A text's first row decides whether its answer fits the region and is remembered or is
    remembered as not found. So the end is the place of request number `most` + 1, found by a running count over requests alone.
    """
    order = F.struct((-F.col("hits")).alias("h"), F.col("ord").alias("o"))
    known = cache.select("asked", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    rows = written(wanted.withColumn("_order", order))
    new = rows.join(known.select("asked"), "asked", "left_anti")
    told = answers.select("asked", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.coalesce("failed", F.lit(False)).alias("_failed"))
    of = new.join(told, "asked", "left").withColumn("_failed", F.coalesce("_failed", F.lit(True)))
    # A text that is answered costs its first row one request; one that fails costs every row one.
    answered = of.where("not _failed").groupBy("asked", "_lat", "_lon").agg(F.min(F.struct("_order", "id", "region")).alias("_f")).select("asked", "_lat", "_lon", "_f._order", "_f.id", "_f.region")
    first = written(answered)
    requests = first.select("_order").unionByName(of.where("_failed").select("_order"))
    ends = positions(requests, F.col("_order")).where(F.col("position") == most + 1).select("_order")
    end = ends.agg(F.min("_order")).scalar()
    before = lambda df: df.where(end.isNull() | (F.col("_order") < end))
    fits = in_region("region", "_lat", "_lon")
    asked = written(before(first).withColumn("_fits", fits))
    remembered = asked.select("asked", F.when(F.col("_fits"), F.col("_lat")).alias("_lat"), F.when(F.col("_fits"), F.col("_lon")).alias("_lon"))
    whole = known.unionByName(remembered)
    filled = before(rows).join(whole, "asked").where(F.col("_lat").isNotNull() & fits).join(asked.select("_order", F.lit(True).alias("_own")), "_order", "left")
    out = filled.select("id", F.col("_lat").alias("lat"), F.col("_lon").alias("lon"), F.when(F.col("_own"), FROM_GEOCODER).otherwise(FROM_CACHE).alias("place_source"))
    return out, whole.select("asked", F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))


def with_geocodes(events: DataFrame, cache: DataFrame, answers: DataFrame, most: int = 25) -> tuple[DataFrame, DataFrame]:
    """events (whole records) with coordinates filled, and the new cache."""
    found, remembered = geocoded(candidates(events), cache, answers, most)
    extra = found.select("id", *[F.col(c).alias(f"_{c}") for c in ("lat", "lon", "place_source")])
    joined = events.join(extra, "id", "left")
    got = F.col("_lat").isNotNull()
    return joined.withColumns({c: F.when(got, F.col(f"_{c}")).otherwise(F.col(c)) for c in ("lat", "lon", "place_source")}).select(events.columns), remembered
