"""What the pages of a catalogue show, each section a small frame: home, filtered home, an event's page, hero tickets, links."""

from __future__ import annotations

import dataclasses
import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showbill.functions import dates, urls
from showbill.operators import facets, listing, recommend
from showbill.operators.listing import ListingQuery

#: The category of venues whose events have none (a fixed value).
UNLABELLED = "美術"


def event_link(key: Column | str) -> Column:
    return F.concat(F.lit("?event="), urls.encode(key))


def facet_link(name: str, value: Column | str) -> Column:
    """The listing of one category, region or venue."""
    return F.concat(F.lit(f"?view=all&{name}="), urls.encode(value))


def directions_query(venue: Column | str, address: Column | str) -> Column:
    """What a map is asked for: venue and address, without what both say."""
    v, a = (F.trim(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))) for c in (venue, address))
    return F.trim(F.when(F.contains(a, v), a).otherwise(F.concat_ws(" ", v, a)))


def map_link(lat: Column | str, lon: Column | str, venue: Column | str, address: Column | str) -> Column:
    """The destination of a route: coordinates where they are known, else the place's name."""
    at = F.concat_ws(",", lat, lon)
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull() if isinstance(lat, str) else lat.isNotNull() & lon.isNotNull()
    return F.concat(F.lit("https://www.google.com/maps/dir/?api=1&destination="), urls.encode(F.when(known, at).otherwise(directions_query(venue, address))))


def redirected(q: ListingQuery, venues: frozenset[str], regions: frozenset[str], categories: frozenset[str]) -> ListingQuery:
    """A text that is all there is to a query and that names a category, region or venue asks for that facet."""
    if not q.text or q.categories or q.region or q.venue or q.status or q.date:
        return q
    for name, values in (("categories", categories), ("region", regions), ("venue", venues)):
        if q.text in values:
            return dataclasses.replace(q, text="", view="all", **{name: frozenset({q.text}) if name == "categories" else q.text})
    return q


def soonest(events: DataFrame, status: str, today: datetime.date, k: int = 4) -> DataFrame:
    """The next k to open, or the next k to end within 30 days."""
    by = {"upcoming": "start", "ending": "end"}[status]
    return events.where(listing.status_is(status, F.lit(today))).orderBy(F.col(by).asc_nulls_last(), "key").limit(k)


def home(events: DataFrame, today: datetime.date) -> dict[str, DataFrame]:
    """counts (one row), featured (9, those that are on if there are any), upcoming and ending (4 each) and category counts."""
    on = events.where(dates.is_ongoing("start", "end", F.lit(today)))
    return {
        "counts": events.agg(F.count("*").alias("events"), F.count_distinct(F.when(F.coalesce("venue", F.lit("")) != "", F.col("venue"))).alias("venues")),
        "featured": listing.featured(_if_any(on, events), today, 9),
        "upcoming": soonest(events, "upcoming", today),
        "ending": soonest(events, "ending", today),
        "categories": facets.label_counts(events),
    }


def _if_any(some: DataFrame, every: DataFrame) -> DataFrame:
    """The first frame if it has rows, else the second: one plan, decided by a scalar subquery."""
    has = some.agg((F.count("*") > 0).alias("has")).scalar()
    keys = some.select("key").withColumn("_in", F.lit(True))
    return every.join(keys, "key", "left").where(F.col("_in").isNotNull() | ~has).drop("_in")


def home_results(events: DataFrame, q: ListingQuery, k: int = 14) -> tuple[DataFrame, str]:
    """The featured of the filtered events, and the link to all of them; a query without date and status has none."""
    found = listing.filtered(events, q) if q.date or q.status else events.limit(0)
    return listing.featured(found, q.today, k), "?" + dataclasses.replace(q, view="all").to_params()


def related_top(events: DataFrame, seeds: DataFrame, today: datetime.date, k: int = 6) -> DataFrame:
    """seed, key and place: of the events that share a seed's region or a label, the k best by score.

    Per region and per label only k + 1 events can be among any seed's k best, so each is cut to these before seeds meet them: what is
    shuffled grows with seeds, not with seeds times events.
    """
    scored = events.select("key", "region", "categories", listing.score(F.lit(today)).alias("score"))

    def best(df: DataFrame, by: str) -> DataFrame:
        w = Window.partitionBy(by).orderBy(F.desc("score"), "key")
        return df.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k + 1).select(by, "key", "score")

    s = seeds.select(F.col("key").alias("seed"), "region", "categories")
    by_region = s.join(best(scored, "region"), "region").select("seed", "key", "score")
    labels = scored.select("key", "score", F.explode("categories").alias("label"))
    by_label = s.select("seed", F.explode("categories").alias("label")).join(best(labels, "label"), "label").select("seed", "key", "score")
    pairs = by_region.union(by_label).where("seed <> key").distinct()
    w = Window.partitionBy("seed").orderBy(F.desc("score"), "key")
    return pairs.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select("seed", "key", "place")


def detail(events: DataFrame, key, today: datetime.date) -> dict[str, DataFrame]:
    """event (one row with badges and dates as text) and its six related events."""
    one = events.where(F.col("key") == F.lit(key))
    shown = one.withColumns({"badges": listing.badges(F.lit(today)), "dates": dates.date_range("start", "end"), "link": event_link(F.col("key").cast("string"))})
    return {"event": shown, "related": related_top(events, one, today)}


def hero_tickets(events: DataFrame, today: datetime.date, seed: int, seen: DataFrame | None = None, k: int = 3, pool: int = 48) -> DataFrame:
    """k events in a seeded order from the featured of those that are on or upcoming (of all, if there are none), unseen ones first."""
    t = F.lit(today)
    base = _if_any(events.where(dates.is_ongoing("start", "end", t) | dates.is_upcoming("start", t)), events)
    return recommend.shuffled_pick(listing.featured(base, today, pool), k, seed, seen)


def month(events: DataFrame, q: ListingQuery, first: datetime.date) -> DataFrame:
    """day, n, cell, selected and today of a month's calendar: what the query without its date has on each day, and the day's cell in a grid of weeks that begin on Sunday."""
    last = (first.replace(day=28) + datetime.timedelta(4)).replace(day=1) - datetime.timedelta(1)
    before = first.replace(day=1).isoweekday() % 7
    days = facets.calendar(listing.filtered(events, dataclasses.replace(q, date=None)), first.replace(day=1), last)
    return days.select("day", "n", (F.dayofmonth("day") - 1 + before).alias("cell"), F.lit(q.date).cast("date").eqNullSafe(F.col("day")).alias("selected"), (F.col("day") == F.lit(q.today)).alias("today"))


def listing_page(events: DataFrame, q: ListingQuery, first: datetime.date, categories: list[str], regions: list[str], k: int = 200) -> dict[str, DataFrame]:
    """The listing of a query: results (the first k), found (one row: how many in all), calendar, and the sidebar's categories and regions, which count all events."""
    found = listing.filtered(events, q)
    return {
        "results": listing.listing(events, q, k), "found": found.agg(F.count("*").alias("n")), "calendar": month(events, q, first),
        "categories": facets.category_strip(events.where(F.exists("categories", lambda c: c.isin(*categories))), categories, len(categories)).where(F.col("category").isin(*categories)),
        "regions": facets.region_facets(events, regions),
    }


def venue_grid(events: DataFrame, pictures: DataFrame, today: datetime.date, k: int = 36, most: int = 8) -> DataFrame:
    """place, venue, n, images and category of the k venues with most events: the venue's own picture (venue, image) first, then its events' pictures, those that are on and score best before others; the category of its best event.

    Pictures are combined before they are gathered, and `most` of a venue's are kept before the shuffle, so a venue with many events is no single task's load.
    """
    named = events.where((F.coalesce("venue", F.lit("")) != "") & ~F.col("venue").rlike("資料整理中|地點待確認"))
    top = facets.top_counts(named, "venue", k).select("venue", "n", F.row_number().over(Window.orderBy(F.desc("n"), "venue")).alias("place"))
    rank = F.struct((~dates.is_ongoing("start", "end", F.lit(today))).alias("off"), (-listing.score(F.lit(today))).alias("s"), F.col("key").alias("k"))
    own = named.join(F.broadcast(top.select("venue")), "venue", "left_semi").withColumn("rank", rank)
    listed = F.when(F.size("images") > 0, F.col("images")).otherwise(F.array("image")) if "images" in events.columns else F.array("image")
    every = own.select("venue", "rank", F.posexplode(listed).alias("at", "url")).withColumn("url", urls.normalize_url("url"))
    shown = pictures.select("venue", F.lit(None).cast(own.schema["rank"].dataType).alias("rank"), F.lit(0).alias("at"), urls.normalize_url("image").alias("url")).join(F.broadcast(top.select("venue")), "venue", "left_semi").unionByName(every)
    usable = shown.where((F.col("url") != "") & urls.shows_content(F.col("url"), "app"))
    first = usable.groupBy("venue", "url").agg(F.min(F.struct("rank", "at")).alias("f"))
    kept = first.withColumn("_p", F.row_number().over(Window.partitionBy("venue").orderBy("f", "url"))).where(F.col("_p") <= most)
    images = kept.groupBy("venue").agg(F.array_sort(F.collect_list(F.struct("_p", "url"))).alias("i")).select("venue", F.transform("i", lambda x: x["url"]).alias("images"))
    label = F.get("categories", F.lit(0))
    best = own.groupBy("venue").agg(F.min_by(label, F.when(label.isNotNull(), F.col("rank"))).alias("category"))
    out = top.join(images, "venue", "left").join(best, "venue", "left")
    return out.select("place", "venue", "n", F.coalesce("images", F.array().cast("array<string>")).alias("images"), F.coalesce("category", F.lit(UNLABELLED)).alias("category"))
