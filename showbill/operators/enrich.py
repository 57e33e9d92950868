"""Enrichment of records by joins: details of the feeds, metadata of pages, checks of coordinates, pictures of venues.

What a crawler would fetch is a table here (details by id, pages by URL); which records ask for it, in what order and how often,
and what they take from it, are the rules of this module.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from showbill.functions import dates, geo, urls
from showbill.functions.text import clean_place, clean_text, let, title_score, unescape_all
from showbill.operators import extract, records, rules
from showbill.sources.shared import spread, written

TICKET_SITE = "opentix.life"
#: Lists of ids up to this length are broadcast; longer ones are joined as Spark sees fit.
MOST_SENT = 100_000


def _lacks(description_chars: int) -> Column:
    """Whether a record lacks an image, a place, an address, a venue or a description of some length."""
    return (F.size("images") == 0) | F.col("lat").isNull() | F.col("lon").isNull() | (clean_place("address") == "") | rules.poor_venue("venue") | (F.length(clean_text("description")) < description_chars)


def detail_candidates(events: DataFrame, most: int = 250) -> DataFrame:
    """The records that details are asked for, the most popular first: a top-k, no full sort."""
    return events.where((F.col("id") != "") & _lacks(60)).orderBy(F.desc("hits"), "id").limit(most)


def with_details(events: DataFrame, details: DataFrame, most: int = 250) -> DataFrame:
    """events with the records of `details` (typed records, by id) merged over those that ask for them; other records stay as they are."""
    asked = detail_candidates(events, most).select("id")
    extra = details.join(asked, "id", "left_semi").withColumn("ord", F.lit(1 << 60).cast("long") + F.col("ord"))
    # Of all records only those with details are merged; both parts are semi-joins on a list of at most `most` ids, which goes to every task only where that is few.
    ids = extra.select("id").distinct()
    ids = F.broadcast(ids) if most <= MOST_SENT else ids
    both = events.join(ids, "id", "left_semi").unionByName(extra.select(events.columns))
    merged = records.merged(both.withColumn("_id", F.col("id")), "_id").drop("_id", "_n")
    return events.join(ids, "id", "left_anti").unionByName(merged.select(events.columns))


def page_candidates(events: DataFrame, today: Column, most: int = 450) -> DataFrame:
    """The records whose page is read again: something is missing or unverified and the last check is old enough (4 days, else 21)."""
    url = urls.normalize_url("source_url")
    host = urls.host_of(F.col("_url"))
    short = F.length(clean_text("description")) < 120
    e = events.withColumn("_url", url).where("_url <> ''").withColumns({"_site": F.contains(host, F.lit(TICKET_SITE)) & short, "_check": host.rlike(urls.TICKET_HOST) | host.rlike(urls.SOCIAL_HOST)})
    unsure = ~F.coalesce(F.col("verified"), F.lit(False)) | F.col("_check")
    days = F.when((F.size("images") == 0) | unsure, 4).otherwise(21)
    checked = dates.parse_date("checked_at")
    recent = ~F.col("_site") & F.coalesce(checked >= F.date_sub(today, days), F.lit(False))
    rank = [F.col("_site"), F.col("_check"), ~F.coalesce(F.col("verified"), F.lit(False)), F.size("images") == 0, short, rules.poor_venue("venue"), F.col("hits")]
    return e.where((_lacks(120) | unsure) & ~recent).orderBy(*[c.desc() for c in rank], "id").limit(most).select("id", F.col("_url").alias("url"), "title")


def page_metadata(pages: DataFrame) -> DataFrame:
    """page_id, url and what each page (page_id, url, html) says: page_title, page_images (all), page_description, page_venue, page_address, page_lat, page_lon and page_text.

    JSON-LD comes before what patterns find in the text. page_text is what titles are looked for in.
    """
    html = extract.head("html")
    pages = spread(pages.select("page_id", "url", "html"), "page_id")
    rows = pages.join(extract.json_ld(pages), "page_id", "left").withColumns({"_plain": clean_text(html, unescape_all), "page_title": extract.page_title(html), "_at": F.coalesce(F.col("ld_at"), extract.page_point(html))})
    told = lambda c, other: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(other)
    return rows.select(
        "page_id", "url", "page_title", extract.page_images(html, "url", None, F.col("ld_images")).alias("page_images"),
        extract.page_description(html, linked=F.col("ld_descriptions"), host=urls.host_of(F.col("url"))).alias("page_description"),
        told("ld_venue", extract.plain_venue("_plain")).alias("page_venue"), told("ld_address", extract.plain_address("_plain")).alias("page_address"),
        F.col("_at.lat").alias("page_lat"), F.col("_at.lon").alias("page_lon"), F.lower(F.concat_ws(" ", "page_title", clean_text(F.substring("html", 1, 180_000)))).alias("page_text"),
    )


def probed_images(reads: DataFrame, probes: DataFrame, key: list[str], first: int = 24, most: int = 18) -> DataFrame:
    """reads with page_images cut to `most`, those of the first `first` that answered a probe before all others, in order.

    reads: key and page_images (ranked); probes: url and ok, one row per URL. Only the first images of each row are looked up, by a
    semi-join, and gathered again: `first` at most per row.
    """
    asked = reads.select(*key, F.posexplode(F.slice("page_images", 1, first)).alias("_at", "_image"))
    answered = asked.join(probes.where("ok").select(F.col("url").alias("_image")), "_image", "left_semi").groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_at", "_image"))).alias("_ok"))
    joined = reads.join(answered, key, "left")
    ok = F.coalesce(F.transform("_ok", lambda x: x["_image"]), F.array().cast("array<string>"))
    return joined.withColumn("page_images", F.slice(F.array_distinct(F.concat(ok, "page_images")), 1, most)).drop("_ok")


def discovered(asked: DataFrame, pages: DataFrame, follow: int = 4, least: float = 0.42, probes: DataFrame | None = None) -> DataFrame:
    """One row per asked record (id, url, title) whose page is in `pages`: verified, match_score, rejected_url, best_url, and what the accepted pages say.

    A record's page and its `follow` best links are read; a page is accepted if its title matches the record's. Accepted pages are
    ordered by their host, whether they are the record's own page, and their score; their images by the record's title and, where `probes` (url, ok) are given, by those.
    """
    own = asked.join(pages.select("page_id", "url"), "url").select("id", "title", F.col("url").alias("own_url"), "page_id")
    # Links and facts are large expressions: what they give is written, so that later steps are planned over small tables.
    linked = written(extract.related_pages(spread(pages.join(own.select("page_id").distinct(), "page_id", "left_semi"), "page_id"), follow))
    reads = own.select("id", "title", "own_url", F.col("own_url").alias("url"), F.lit(0).alias("step")).unionByName(
        own.join(linked, "page_id").select("id", "title", "own_url", F.col("target").alias("url"), F.col("place").alias("step"))
    )
    # Only pages that are read are searched, and what rides on is their metadata.
    found = written(page_metadata(pages.join(reads.select("url").distinct(), "url", "left_semi")))
    read = reads.join(found, "url").withColumn("score", title_score("title", "page_title", "page_text")).drop("page_text")
    read = read.withColumn("page_images", extract.ranked_images("page_images", "title"))
    read = read.withColumn("page_images", F.slice("page_images", 1, 18)) if probes is None else probed_images(read, probes, ["id", "step", "url"])
    host = urls.host_of(F.col("url"))
    bare = lambda c: F.regexp_replace(c, "/+$", "")
    bonus = F.when(F.contains(host, F.lit(TICKET_SITE)), 55).when(host.rlike(urls.TICKET_HOST), 38).otherwise(0) + F.when(host.rlike(urls.PUBLIC_HOST), 30).otherwise(0) + F.when(bare("url") == bare("own_url"), 12).otherwise(0)
    ranked = read.withColumns({"ok": F.col("score") >= least, "rank": F.struct((-bonus).alias("b"), (-F.col("score")).alias("s"), "step")})
    first = lambda c, there: F.min_by(c, F.when(F.col("ok") & there, F.col("rank"))).alias(c)
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    # A record reads `follow` + 1 pages at most, so gathering their images is bounded.
    images = F.array_sort(F.collect_list(F.when(F.col("ok"), F.struct("rank", "page_images"))))
    out = ranked.groupBy("id", "own_url").agg(
        F.max(F.when(F.col("step") == 0, F.col("ok"))).alias("verified"), F.max(F.when(F.col("step") == 0, F.col("score"))).alias("match_score"),
        F.min_by("url", F.when(F.col("ok"), F.col("rank"))).alias("best_url"), F.slice(F.array_distinct(F.flatten(F.transform(images, lambda x: x["page_images"]))), 1, 20).alias("page_images"),
        F.max_by("page_description", F.when(F.col("ok"), F.length("page_description"))).alias("page_description"), *[first(c, filled(c)) for c in ("page_venue", "page_address", "page_lat", "page_lon")],
    )
    return out.withColumn("rejected_url", F.when(F.col("verified"), "").otherwise(F.col("own_url"))).drop("own_url")


def with_pages(events: DataFrame, pages: DataFrame, today: Column, now: Column, profiles=(), most: int = 450, probes: DataFrame | None = None) -> DataFrame:
    """events with what their pages say: verification, a better page, more images, a longer description, a missing address, venue or place."""
    asked = written(page_candidates(events, today, most))
    found = written(discovered(asked, pages, probes=probes)).select("id", *[F.col(c).alias(f"_{c}") for c in ("verified", "match_score", "rejected_url", "best_url", "page_images", "page_description", "page_venue", "page_address", "page_lat", "page_lon")])
    e = events.join(F.broadcast(asked.select("id", F.lit(True).alias("_asked"))), "id", "left").join(F.broadcast(found), "id", "left")
    got = F.col("_verified").isNotNull()
    best, rejected = F.coalesce("_best_url", F.lit("")), F.coalesce("_rejected_url", F.lit("")) != ""
    images = F.slice(F.array_distinct(F.concat("images", F.coalesce("_page_images", F.array().cast("array<string>")))), 1, 18)
    new_address = F.when((clean_place("address") == "") & (F.coalesce("_page_address", F.lit("")) != ""), F.col("_page_address")).otherwise(F.col("address"))
    new_venue = got & (F.coalesce("_page_venue", F.lit("")) != "") & rules.poor_venue("venue")
    e = e.withColumns({
        "checked_at": F.when(F.col("_asked"), now).otherwise(F.col("checked_at")), "match_score": F.when(got, F.col("_match_score")).otherwise(F.col("match_score")),
        "source_url": F.when(got & rejected, best).when(got & (best != ""), best).otherwise(F.col("source_url")), "verified": F.when(got, F.col("_verified") | (best != "")).otherwise(F.col("verified")),
        "rejected_url": F.when(got & rejected, F.col("_rejected_url")).otherwise(F.col("rejected_url")), "images": F.when(got, images).otherwise(F.col("images")),
        "description": F.when(F.length(F.coalesce("_page_description", F.lit(""))) > F.length(clean_text("description")), F.col("_page_description")).otherwise(F.col("description")),
        "address": new_address, "_named": F.when(new_venue, records.venue_name(F.coalesce("_page_venue", F.lit("")), F.coalesce("_page_address", "address"), profiles)),
    })
    e = e.withColumns({"venue": F.coalesce("_named.group", "venue"), "venue_detail": F.coalesce("_named.detail", "venue_detail")})
    e = e.withColumn("region", F.when(F.col("_named").isNotNull(), rules.detect_region("address", "venue")).otherwise(F.col("region")))
    fits = F.col("_page_lat").isNotNull() & F.col("_page_lon").isNotNull() & in_region("region", "_page_lat", "_page_lon")
    fill = fits & (F.col("lat").isNull() | F.col("lon").isNull())
    e = e.withColumns({"place_source": F.when(fill, "source_page").otherwise(F.col("place_source")), "lat": F.when(fill, F.coalesce("lat", "_page_lat")).otherwise(F.col("lat")), "lon": F.when(fill, F.coalesce("lon", "_page_lon")).otherwise(F.col("lon"))})
    return e.withColumn("image", F.coalesce(F.get("images", F.lit(0)), F.lit(""))).select(events.columns)


def in_region(region: Column | str, lat: Column | str, lon: Column | str) -> Column:
    """Whether a point lies in the box and in its region's circle; unknown regions have the box alone. The circles are fixed values, so no join is needed."""
    circle = F.create_map(*[F.lit(x) if isinstance(x, str) else F.struct(*map(F.lit, map(float, x))) for kv in rules.REGION_CIRCLES.items() for x in kv])
    r = F.col(region) if isinstance(region, str) else region
    near = let(F.try_element_at(circle, r), lambda c: F.coalesce(geo.haversine_km(c["col1"], c["col2"], lat, lon) <= c["col3"], F.lit(True)))
    return F.coalesce(geo.within_box(lat, lon) & near, F.lit(False))


def checked_places(events: DataFrame) -> DataFrame:
    """Coordinates that can't be right are cleared and kept in place_rejected (lat, lon, reason)."""
    bad = F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~in_region("region", "lat", "lon")
    told = F.struct("lat", "lon", F.lit("region_mismatch").alias("reason"))
    return events.withColumn("place_rejected", F.when(bad, told)).withColumns({"place_source": F.when(bad, "").otherwise(F.col("place_source")), "lat": F.when(~bad, F.col("lat")), "lon": F.when(~bad, F.col("lon"))})


def venue_images(events: DataFrame, official: DataFrame, today: Column) -> DataFrame:
    """venue and image: an official picture (venue, image) of venues that have events; else the first content image of the venue's best
    event: being on before upcoming before others, then the later start, then more hits."""
    v = clean_place("venue")
    image = F.get(F.filter(urls.unique_urls(F.concat(F.coalesce("images", F.array().cast("array<string>")), F.array("image"))), lambda u: urls.shows_content(u)), F.lit(0))
    start = F.coalesce(dates.parse_date("start_date"), F.lit("9999-12-31").cast("date"))
    end = F.coalesce(dates.parse_date("end_date"), start)
    rank = F.struct((F.when((start <= today) & (today <= end), 2).otherwise(0) + F.when(start > today, 1).otherwise(0)).alias("on"), start.alias("s"), F.coalesce("hits", F.lit(0)).alias("h"), image.alias("i"))
    shown = events.select(v.alias("venue"), F.when(image.isNotNull() & ~rules.poor_venue("venue"), rank).alias("rank")).groupBy("venue").agg(F.max("rank").alias("m"))
    own = official.select(v.alias("venue"), urls.normalize_url("image").alias("_own")).where((F.col("_own") != "") & ~urls.is_blocked("_own") & urls.shows_content(F.col("_own"))).groupBy("venue").agg(F.min("_own").alias("_own"))
    return shown.join(own, "venue", "left").select("venue", F.coalesce("_own", "m.i").alias("image")).where("image is not null and venue <> ''")
