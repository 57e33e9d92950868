"""Listing queries over a catalogue: facets, status, order, score and top-k.

A catalogue has key, title, categories (array), region, venue, description, start, end (dates), price (text), hits and
image; columns a query doesn't name aren't read.
"""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field
from urllib.parse import urlencode

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showbill.functions import dates
from showbill.functions.text import checksum

FREE = r"(?i)免費|免票|自由入場|free"
SEARCHED = ("title", "description", "venue", "region", "address", "organiser")
ENDING_IN_LIST, ENDING_IN_SCORE = 30, 14


@dataclass(frozen=True)
class ListingQuery:
    """The state of a listing page; today is always given, never read from a clock."""

    today: datetime.date
    text: str = ""
    categories: frozenset[str] = field(default_factory=frozenset)
    region: str = ""
    venue: str = ""
    status: str = ""
    date: datetime.date | None = None
    sort: str = "recommended"
    view: str = "home"

    @classmethod
    def from_params(cls, params: Mapping[str, list[str]], today: datetime.date, allowed: frozenset[str] | None = None) -> ListingQuery:
        """From URL parameters; `category` may repeat or hold a list with commas, and unknown categories are dropped."""
        one = lambda k: (params.get(k) or [""])[0].strip()
        named = {c.strip() for v in params.get("category", []) for c in v.split(",") if c.strip()}
        try:
            day = datetime.date.fromisoformat(one("date"))
        except ValueError:
            day = None
        return cls(today, one("q"), frozenset(named & allowed if allowed is not None else named), one("region"), one("venue"), one("status"), day, view=one("view") or "home")

    def to_params(self) -> str:
        pairs = [("view", self.view), ("q", self.text), *(("category", c) for c in sorted(self.categories)), ("region", self.region), ("venue", self.venue), ("status", self.status), ("date", self.date.isoformat() if self.date else "")]
        return urlencode([(k, v) for k, v in pairs if v])


def status_is(status: str, today: Column) -> Column:
    return {
        "ongoing": dates.is_ongoing("start", "end", today),
        "upcoming": dates.is_upcoming("start", today),
        "ending": dates.is_ending("start", "end", today, ENDING_IN_LIST),
        "free": is_free(),
        "recent": dates.recently("first_seen", today),
    }[status]


def is_free() -> Column:
    return F.coalesce(F.col("price").rlike(FREE), F.lit(False))


def filtered(events: DataFrame, q: ListingQuery, with_date: bool = True) -> DataFrame:
    """All facets must hold; of several categories, one."""
    today = F.lit(q.today)
    if q.text:
        searched = [c for c in SEARCHED if c in events.columns]
        events = events.where(F.contains(F.lower(F.concat_ws(" ", *searched, F.array_join("categories", " "))), F.lit(q.text.lower())))
    if q.categories:
        events = events.where(F.arrays_overlap("categories", F.array(*map(F.lit, sorted(q.categories)))))
    for name in ("region", "venue"):
        if value := getattr(q, name):
            events = events.where(F.col(name) == value)
    if q.status:
        events = events.where(status_is(q.status, today))
    if q.date and with_date:
        events = events.where(dates.occurs_on("start", "end", F.lit(q.date)))
    return events


def score(today: Column) -> Column:
    """Popularity, an image, being on, ending soon and a full description, with a checksum of the key to part ties."""
    yes = lambda c, n: F.when(c, float(n)).otherwise(0.0)
    return (
        F.least(F.coalesce(F.col("hits"), F.lit(0)), F.lit(50000)) / 500.0
        + yes(F.coalesce(F.col("image"), F.lit("")) != "", 20)
        + yes(dates.is_ongoing("start", "end", today), 18)
        + yes(dates.is_ending("start", "end", today, ENDING_IN_SCORE), 8)
        + yes(F.length(F.coalesce("description", F.lit(""))) > 80, 5)
        + checksum(F.col("key").cast("string")) / 1e6
    )


def order_of(sort: str, today: Column) -> list[Column]:
    """The key parts all ties, so that an order is total."""
    first = {"newest": F.col("start").desc_nulls_last(), "ending": F.col("end").asc_nulls_last(), "title": F.collate("title", "zh_Hant"), "recommended": score(today).desc()}[sort]
    return [first, F.col("key").asc()]


def listing(events: DataFrame, q: ListingQuery, k: int) -> DataFrame:
    """The first k of the filtered events in the query's order: one scan with pushed filters and a top-k, no full sort."""
    return filtered(events, q).orderBy(*order_of(q.sort, F.lit(q.today))).limit(k)


def featured(events: DataFrame, today: datetime.date, k: int = 8, by: str = "key") -> DataFrame:
    """The k best by image and score, one for each value of `by`, of equals the smaller key; the best per value is an aggregate, not a window, so a frequent value isn't one task's load."""
    ranked = events.withColumn("score", score(F.lit(today))).withColumn("has_image", (F.coalesce(F.col("image"), F.lit("")) != "").cast("int"))
    best = ranked.groupBy(by).agg(F.min(F.struct((-F.col("has_image")).alias("i"), (-F.col("score")).alias("s"), F.col("key").alias("k"))).alias("m"))
    return best.select(by, *([] if by == "key" else [F.col("m.k").alias("key")]), (-F.col("m.i")).alias("has_image"), (-F.col("m.s")).alias("score")).orderBy(F.desc("has_image"), F.desc("score"), "key").limit(k)


def badges(today: Column) -> Column:
    """At most two of new, upcoming, ending and free, in that order; `curated` if there is none."""
    some = F.array_compact(F.array(
        F.when(dates.recently("first_seen", today), "new"),
        F.when(dates.is_upcoming("start", today), "upcoming"),
        F.when(dates.is_ending("start", "end", today, ENDING_IN_SCORE), "ending"),
        F.when(is_free(), "free"),
    ))
    return F.when(F.size(some) == 0, F.array(F.lit("curated"))).otherwise(F.slice(some, 1, 2))


def best_per_group(events: DataFrame, group: str, today: datetime.date) -> DataFrame:
    """One event per group: being on before upcoming before others, then the later start, more hits, the smaller key."""
    t = F.lit(today)
    rank = F.when(dates.is_ongoing("start", "end", t), 2).otherwise(0) + F.when(dates.is_upcoming("start", t), 1).otherwise(0)
    last = F.lit(1 << 62)
    order = F.struct((-rank).alias("r"), F.coalesce(-F.unix_date("start"), last).alias("s"), F.coalesce(-F.col("hits"), last).alias("h"), F.col("key").alias("k"))
    return events.groupBy(group).agg(F.min(order).alias("m")).select(group, F.col("m.k").alias("key"), (-F.col("m.r")).alias("rank"))


def ranked_in_group(events: DataFrame, group: str, today: datetime.date, k: int) -> DataFrame:
    """The first k events of each group, those that are on first, then by score. Spark keeps k rows a group before the shuffle."""
    t = F.lit(today)
    w = Window.partitionBy(group).orderBy(F.desc("ongoing"), F.desc("score"), "key")
    marked = events.withColumn("ongoing", dates.is_ongoing("start", "end", t).cast("int")).withColumn("score", score(t))
    return marked.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k).select(group, "key", "ongoing", "place")
