"""The whole update of a published catalogue, as one chain of the library's operators.

    python -m showbill.update --output DIR --input-file FEED.json --pages PAGES.parquet --today 2026-03-10

Feeds or files are typed, merged over the records that are published, corrected by hand, enriched with details and pages, located, cleaned and published
as a new version. What a crawler fetched (details, pages, probes, a geocoder's answers) comes as tables; a step whose
table isn't given is left out. Each step's records are written once, so that a step reads files and not all steps before.
"""

from __future__ import annotations

import argparse
import datetime
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showbill.functions import dates
from showbill.operators import enrich, geocode, overlay, records, rules
from showbill.sources import feeds, harvest, published
from showbill.sources.shared import written


@dataclass(frozen=True)
class Config:
    """Where an update reads and writes, and its budgets (the defaults are those of a daily run)."""

    output: str
    input_files: tuple[str, ...] = ()
    feeds: tuple[str, ...] = ()
    feed_source: str = "showbill_feeds"
    recorded: str | None = None
    retries: int = 3
    preserve: bool = True
    details: str | None = None
    pages: str | None = None
    probes: str | None = None
    answers: str | None = None
    overrides: str | None = None
    profiles: str | None = None
    venue_images: str | None = None
    geocode_cache: str | None = None
    max_details: int = 250
    max_pages: int = 450
    max_geocodes: int = 25
    today: datetime.date = field(default_factory=datetime.date.today)
    now: str = field(default_factory=lambda: datetime.datetime.now(datetime.timezone.utc).isoformat(timespec="seconds"))


def incoming(spark: SparkSession, config: Config) -> DataFrame:
    """raw, file and ord of the records that come in: from files, else from the feeds. Feeds that all fail give none, which is an error only where nothing is published."""
    if config.input_files:
        return records.read_variants(spark, *config.input_files)
    got, failed = harvest.harvested(spark, list(config.feeds), config.retries, config.feed_source)
    if got.isEmpty() and (not config.preserve or published.current(spark, config.output) is None):
        raise RuntimeError(f"no feed gave records: {[tuple(r) for r in failed.limit(20).collect()]}")
    return got


def existing(spark: SparkSession, config: Config, like: DataFrame) -> DataFrame:
    """The published records, with the columns of `like`; none where nothing is published or they aren't to be kept."""
    if not config.preserve or published.current(spark, config.output) is None:
        return like.limit(0)
    old = published.read(spark, config.output)
    return old.select(*[F.col(c) if c in old.columns else F.lit(None).cast(t).alias(c) for c, t in like.dtypes])


def named(events: DataFrame, spark: SparkSession, config: Config) -> DataFrame:
    """Venues by the table of profiles, looked for in what the feed called the venue."""
    if config.profiles is None:
        return events.drop("raw_venue")
    return overlay.venue_names(events, feeds.read_profiles(spark, config.profiles), read="raw_venue").drop("raw_venue")


def corrected(events: DataFrame, spark: SparkSession, config: Config) -> DataFrame:
    """Curated corrections by title and dates."""
    if config.overrides is None:
        return events
    table = feeds.read_overrides(spark, config.overrides)
    columns = list(feeds.OVERRIDDEN.values())
    keyed = events.withColumns({"key": F.col("ord"), "start": dates.date_or_text("start_date"), "end": dates.date_or_text("end_date")})
    return overlay.override(keyed, table, columns).select(events.columns)


def placed(events: DataFrame) -> DataFrame:
    """Missing coordinates from records with the same address, else the same venue, where those lie at one place."""
    keyed = events.withColumns({"_address": records.place_key("address"), "_venue": records.place_key("venue"), "_source": F.col("place_source")})
    out = overlay.inherit_places(keyed, ["_address", "_venue"])
    source = F.when(F.col("place_source").isin("_address", "_venue"), "matched_place").otherwise(F.col("_source"))
    return out.withColumn("place_source", source).select(events.columns)


def updated(spark: SparkSession, config: Config) -> tuple[DataFrame, DataFrame | None]:
    """(records to publish, the geocode cache to keep or None)."""
    today, now = F.lit(config.today), F.lit(config.now)
    table = lambda path: spark.read.parquet(path)
    new = written(named(records.typed(incoming(spark, config), raw_venue=True), spark, config))
    events = written(records.catalogue(new, existing(spark, config, new), today, now))
    events = corrected(events, spark, config)
    if config.details and config.max_details:
        events = written(enrich.with_details(written(events), table(config.details), config.max_details))
    if config.pages and config.max_pages:
        probes = table(config.probes) if config.probes else None
        events = written(enrich.with_pages(written(events), table(config.pages), today, now, most=config.max_pages, probes=probes))
    if (config.details and config.max_details) or (config.pages and config.max_pages):
        events = corrected(events, spark, config)  # corrections win over what pages say
    events = written(placed(written(enrich.checked_places(events).drop("place_rejected"))))
    cache = None
    if config.answers and config.max_geocodes:
        held = published.read(spark, config.geocode_cache, "table") if config.geocode_cache and published.current(spark, config.geocode_cache) else spark.createDataFrame([], "asked string, lat double, lon double")
        events, cache = geocode.with_geocodes(events, held, table(config.answers), config.max_geocodes)
        events = written(events)
    events = enrich.checked_places(events).drop("place_rejected")
    wanted = ~rules.excluded(F.col("title"), F.col("organiser"), F.concat_ws("、", "categories"), F.col("source_url"))
    events = records.without_social(events.where(wanted))
    labels = rules.editorial_labels("categories", "title", "description")
    return events.withColumn("categories", labels).withColumn("category", F.get("categories", F.lit(0))), cache


def run(spark: SparkSession, config: Config) -> str:
    """Makes and publishes a version; its name. The geocode cache is replaced once the version is out, and a picture per venue is kept beside the records."""
    events, cache = updated(spark, config)
    events = written(events)
    official = feeds.read_venue_images(spark, config.venue_images) if config.venue_images else spark.createDataFrame([], "venue string, image string")
    pictures = enrich.venue_images(events, official, F.lit(config.today))
    name = published.publish(events, config.output, config.now, venues=pictures)
    if cache is not None and config.geocode_cache:
        published.put(cache, config.geocode_cache)
    return name


def config_of(arguments: list[str] | None = None) -> Config:
    """The configuration from a command line; budgets also from the environment."""
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--output", required=True)
    p.add_argument("--input-file", action="append", default=[])
    p.add_argument("--feeds", default="")
    p.add_argument("--recorded", help="a folder of recorded responses, from which feeds are read")
    p.add_argument("--no-preserve-existing", action="store_true")
    for name in ("details", "pages", "probes", "answers", "overrides", "profiles", "venue-images", "geocode-cache"):
        p.add_argument(f"--{name}")
    for name, most in (("max-details", 250), ("max-pages", 450), ("max-geocodes", 25)):
        p.add_argument(f"--{name}", type=int, default=int(os.environ.get(name.replace("-", "_").upper(), most)))
    p.add_argument("--today", type=datetime.date.fromisoformat, default=datetime.date.today())
    a = p.parse_args(arguments)
    if not a.input_file and not a.feeds:
        p.error("give --input-file or --feeds")
    return Config(
        a.output, tuple(a.input_file), tuple(f for f in a.feeds.split(",") if f), "recorded_feeds" if a.recorded else "showbill_feeds", a.recorded, preserve=not a.no_preserve_existing, details=a.details, pages=a.pages, probes=a.probes, answers=a.answers,
        overrides=a.overrides, profiles=a.profiles, venue_images=a.venue_images, geocode_cache=a.geocode_cache, max_details=a.max_details, max_pages=a.max_pages, max_geocodes=a.max_geocodes, today=a.today,
    )


def main(arguments: list[str] | None = None) -> None:
    from showbill.session import session

    config = config_of(arguments)
    spark = session()
    if config.recorded:
        harvest.register(spark, harvest.recorded(config.recorded), config.feed_source)
    run(spark, config)
    print(published.read_stats(spark, config.output).first().asDict())


if __name__ == "__main__":
    main()
