"""Metadata of HTML pages: titles, links, images, descriptions, places and JSON-LD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from showbill.functions import geo, urls
from showbill.functions.text import clean_place, clean_text, col, first_value, let, strip, title_score, unescape_all
from showbill.operators import records, trees

#: Longer pages are read up to here by the extraction rules.
PAGE_CHARS = 1_600_000
# Fixed patterns: where pages keep their metadata.
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
META = r"""(?is)<meta[^>]+(?:property|name)=["'](?:{names})["'][^>]+content=["']([^"']+)"""
META_SWAPPED = r"""(?is)<meta[^>]+content=["']([^"']+)["'][^>]+(?:property|name)=["'](?:{names})["']"""
ANCHOR = r"""(?is)<a[^>]+href=["']([^"']+)["'][^>]*>(.*?)</a>"""
CANONICAL = r"""(?is)<link[^>]+rel=["'](?:canonical|alternate)["'][^>]+href=["']([^"']+)"""
IMG = r"""(?is)<img[^>]+(?:src|data-src|data-original|data-lazy-src|data-original-src|data-flickity-lazyload|data-echo)=["']([^"']+)"""
SOURCE_SET = r"""(?is)<(?:img|source)[^>]+(?:srcset|data-srcset)=["']([^"']+)"""
IMAGE_LINK = r"""(?is)<link[^>]+rel=["']image_src["'][^>]+href=["']([^"']+)"""
JSON_IMAGE = r"""(?i)["'](?:image|imageUrl|imageURL|images|thumbnailUrl|contentUrl|bannerUrl|bannerURL|coverImage|coverUrl|mainImage|posterUrl|originalImage)["']\s*:\s*["']([^"']+)"""
BACKGROUND = r"""(?i)background(?:-image)?\s*:\s*url\(["']?([^"')]+)"""
ABSOLUTE_IMAGE = r"""(?i)(https?://[^\s"'<>]+?\.(?:jpe?g|png|webp|avif)(?:\?[^\s"'<>]*)?)"""
JSON_TEXT = r"""(?is)["'](?:description|eventDescription|introduction|summary)["']\s*:\s*["'](.+?)(?<!\\)(?:\\\\)*["']"""
JSON_LD = r"""(?is)<script[^>]+type=["']application/ld\+json["'][^>]*>(.*?)</script>"""
POINT = [r"@(-?\d{2}\.\d+),(-?\d{2,3}\.\d+)", r"(?:query|q|destination)=(-?\d{2}\.\d+)%?2[Cc](-?\d{2,3}\.\d+)", r"""(?is)["']latitude["']\s*:\s*["']?(-?\d{2}\.\d+).*?["']longitude["']\s*:\s*["']?(-?\d{2,3}\.\d+)"""]
ADDRESS = r"((?:\d{3,6}\s*)?(?:臺|台|新北|桃園|新竹|苗栗|彰化|南投|雲林|嘉義|高雄|屏東|宜蘭|花蓮|臺東|台東|澎湖|金門|連江)[^<\n]{0,55}?(?:路|街|大道|巷|弄)[^<\n]{0,28}?號(?:之\d+)?(?:\d+樓)?)"
VENUE_LABEL = r"(?i)(?:活動地點|展演地點|展覽地點|場地|地點)\s*[：:]\s*([^<\n]{2,80})"
# Headings around a programme's text, and the site that has them.
PROGRAMME, AFTER_PROGRAMME, PROGRAMME_SITE = "節目介紹|活動介紹|展演介紹|作品介紹", "折扣方案|異動公告|展演須知|購取票須知|退換須知|注意事項", "opentix.life"
# Types of JSON-LD objects that have or are places, and the parts of an address in order.
PLACES, WITH_PLACE = ("place", "civicstructure", "performingartstheater", "museum"), "event"
ADDRESS_PARTS = ("postalCode", "addressRegion", "addressLocality", "streetAddress")
LINK_LABEL = r"(?i)官方|活動官網|詳細資訊|活動頁|售票|購票|主辦|instagram|event|detail|ticket"
LEFT_OUT = r"/share|/sharer|/login|/dialog/"


def head(html: Column | str) -> Column:
    return F.substring(col(html), 1, PAGE_CHARS)


def found(html: Column | str, pattern: str, group: int = 1) -> Column:
    """The first match's group, or null."""
    m = F.regexp_extract(col(html), pattern, group)
    return F.when(m != "", m)


def page_title(html: Column | str) -> Column:
    """The social title, else the title element, cleaned; empty without either."""
    names = "og:title|twitter:title"
    return clean_text(F.coalesce(found(html, META.format(names=names)), found(html, TITLE), F.lit("")))


def all_of(html: Column | str, *patterns: str) -> Column:
    return F.concat(*[F.regexp_extract_all(col(html), F.lit(p), 1) for p in patterns])


def page_images(html: Column | str, base: Column | str | None = None, most: int | None = 18, linked: Column | None = None) -> Column:
    """Image URLs in the order social metadata, JSON-LD (`linked`), img, source sets, JSON members, style backgrounds and plain URLs; each once,
    without interface images; against the page's URL if given."""
    social, card = "og:image(?::secure_url)?", "twitter:image(?::src)?"
    meta = all_of(html, META.format(names=social), META_SWAPPED.format(names=social), META.format(names=card), META_SWAPPED.format(names=card), IMAGE_LINK)
    sets = F.flatten(F.transform(all_of(html, SOURCE_SET), lambda v: F.transform(F.split(v, ","), lambda part: F.split_part(F.trim(part), F.lit(" "), F.lit(1)))))
    every = F.concat(meta, *([] if linked is None else [F.coalesce(linked, F.array().cast("array<string>"))]), all_of(html, IMG), sets, all_of(html, JSON_IMAGE, BACKGROUND, ABSOLUTE_IMAGE))
    absolute = every if base is None else F.transform(every, lambda u: urls.joined(base, unescape_all(F.replace(u, F.lit("\\/"), F.lit("/")))))
    shown = F.filter(urls.unique_urls(absolute), lambda u: urls.shows_content(u))
    return shown if most is None else F.slice(shown, 1, most)


def image_rank(image: Column, at: Column, tokens: Column) -> Column:
    """What orders a page's images for an event: struct(-points, place). Words of the event's title and names of key art count for an image, names of thumbnails against it."""
    name = F.lower(F.coalesce(F.try_url_decode(image), image))
    yes = lambda c, n: F.when(c, n).otherwise(0)
    points = yes(F.exists(tokens, lambda t: F.contains(name, t)), 80) + yes(name.rlike("poster|banner|cover|event|activity|exhibition|主視覺|海報"), 30) + yes(F.contains(name, F.lit("cloudfront.net")), 12) - yes(name.rlike("thumb|thumbnail|small|avatar|profile"), 25)
    return F.struct((-points).alias("p"), at.alias("at"))


def ranked_images(images: Column | str, title: Column | str) -> Column:
    """A page's images in the order of image_rank for an event's title; of equals the one found first."""
    tokens = F.transform(F.filter(F.split(F.coalesce(col(title), F.lit("")), r"(?U)[\s：:、,，/|()（）【】]+"), lambda t: F.length(t) >= 2), lambda t: F.lower(t))
    ranked = let(tokens, lambda ts: F.array_sort(F.transform(col(images), lambda u, i: F.struct(image_rank(u, i, ts).alias("r"), u.alias("u")))))
    return F.transform(ranked, lambda x: x["u"])


def descriptions(html: Column | str, linked: Column | None = None, host: Column | None = None) -> Column:
    """The cleaned descriptions of a page: of its metadata, its JSON-LD (`linked`), members of its scripts, and, on the programme site, its own section."""
    names, none = "og:description|twitter:description|description", F.array().cast("array<string>")
    meta = all_of(html, META.format(names=names), META_SWAPPED.format(names=names))
    plain = lambda t: F.replace(F.replace(t, F.lit("\\n"), F.lit("\n")), F.lit('\\"'), F.lit('"'))
    decoded = F.transform(all_of(html, JSON_TEXT), lambda t: F.coalesce(F.get(F.from_json(F.concat(F.lit('["'), t, F.lit('"]')), "array<string>"), F.lit(0)), plain(t)))
    own = none if host is None else F.when(F.contains(host, F.lit(PROGRAMME_SITE)), F.array(programme(html))).otherwise(none)
    cleaned = lambda texts: F.transform(texts, lambda x: clean_text(x, unescape_all))
    return F.concat(cleaned(meta), none if linked is None else F.coalesce(linked, none), cleaned(decoded), own)


def longest_text(texts: Column, least: int = 24, most: int = 5000) -> Column:
    """The longest of the texts with `least` characters, of equals the first; empty without any."""
    ranked = F.array_min(F.transform(F.filter(texts, lambda d: F.length(d) >= least), lambda d, i: F.struct((-F.length(d)).alias("n"), i.alias("i"), d.alias("d"))))
    return F.substring(F.coalesce(ranked["d"], F.lit("")), 1, most)


def page_description(html: Column | str, least: int = 24, most: int = 5000, linked: Column | None = None, host: Column | None = None) -> Column:
    """The longest description of a page; of equals the first."""
    return longest_text(descriptions(html, linked, host), least, most)


def json_ld(pages: DataFrame) -> DataFrame:
    """What the JSON-LD of each page (page_id, html) says: page_id, ld_venue, ld_address, ld_at (lat and lon, or null), ld_images and ld_descriptions.

    All blocks are walked, in depth-first order. An event's or a place's `location`, and a place itself, give name, address (its parts joined) and
    coordinates; of each, the first found counts. Images are those of any object, descriptions those of events. Pages without a block have no row.
    """
    blocks = pages.where(F.col("html").contains("ld+json")).select("page_id", F.posexplode(F.transform(F.regexp_extract_all(head("html"), F.lit(JSON_LD), 1), lambda b: strip(unescape_all(b)))).alias("block", "json"))
    nodes = trees.objects(blocks, "json", ["page_id", "block"]).withColumn("_v", trees.parsed("json"))
    member = lambda v, n: F.try_variant_get(v, f"$.{n}", "variant")
    kind = F.lower(clean_text(F.try_variant_get("_v", '$["@type"]', "string")))
    nodes = nodes.withColumns({"_kind": kind, "_own": F.from_json("json", "map<string,string>"), "_location": member("_v", "location")})

    def said(v: Column, last: Column) -> Column:
        """What a place says; coordinates are its geo's, else those of `last`."""
        address, geo_of = member(v, "address"), member(v, "geo")
        joined = F.array_join(F.transform(F.array(*[F.coalesce(records.text_in(address, p), F.lit("")) for p in ADDRESS_PARTS]), lambda t: clean_text(t)), "")
        written = clean_place(F.when(records.is_object(address), joined).otherwise(records.text_in(v, "address")))
        return F.struct(
            clean_place(first_value(records.text_in(v, "name"), records.text_in(v, "alternateName"))).alias("venue"), written.alias("address"),
            records.point_in(F.when(records.is_object(geo_of), geo_of), last).alias("at"),
        )

    is_place = F.col("_kind").isin(*PLACES)
    outer = F.when((is_place | (F.col("_kind") == WITH_PLACE)) & records.is_object("_location"), said(F.col("_location"), F.col("_location")))
    facts = nodes.select("page_id", "block", "path", F.posexplode(F.array(outer, F.when(is_place, said(F.col("_v"), F.col("_v"))))).alias("step", "f")).where("f is not null")
    order = F.struct("block", "path", "step")
    first = lambda c, there: F.min_by(f"f.{c}", F.when(there, order)).alias(f"ld_{c}")
    places = facts.groupBy("page_id").agg(first("venue", F.col("f.venue") != ""), first("address", F.col("f.address") != ""), first("at", F.col("f.at").isNotNull()))
    image = F.when(F.map_contains_key("_own", F.lit("image")), trees.leaves(F.try_element_at("_own", F.lit("image")), records.IMAGE_MEMBERS))
    text = F.when((F.col("_kind") == WITH_PLACE) & F.map_contains_key("_own", F.lit("description")), clean_text(F.try_element_at("_own", F.lit("description")), unescape_all))
    # What is gathered for a page is a part of the page's own text.
    gathered = nodes.select("page_id", F.struct("block", "path").alias("o"), image.alias("i"), text.alias("d")).groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.when(F.size("i") > 0, F.struct("o", F.col("i").alias("x"))))).alias("i"), F.array_sort(F.collect_list(F.when(F.col("d") != "", F.struct("o", F.col("d").alias("x"))))).alias("d"),
    )
    of_both = gathered.select("page_id", F.flatten(F.transform("i", lambda x: x["x"])).alias("ld_images"), F.transform("d", lambda x: x["x"]).alias("ld_descriptions"))
    return of_both.join(places, "page_id", "left")


def page_point(html: Column | str) -> Column:
    """Coordinates written in map links or members, as struct(lat, lon), else null; of each pattern the first match, if both numbers can be coordinates."""
    numbers = lambda p: F.struct(geo.coordinate(found(html, p, 1), 90).alias("lat"), geo.coordinate(found(html, p, 2), 180).alias("lon"))
    whole = lambda s: F.when(s["lat"].isNotNull() & s["lon"].isNotNull(), s)
    return F.coalesce(*[let(numbers(p), whole) for p in POINT])


def plain_address(plain: Column | str) -> Column:
    """The first postal address in a page's plain text; empty without one."""
    return clean_place(F.coalesce(found(plain, ADDRESS), F.lit("")))


def plain_venue(plain: Column | str) -> Column:
    """What follows the first label of a place in a page's plain text; empty without one."""
    return clean_place(F.coalesce(found(plain, VENUE_LABEL), F.lit("")))


def section(text: Column | str, start: str, end: str, least: int = 40, most: int = 5000) -> Column:
    """The cleaned text between two headings, to the end if the second is missing; empty if shorter than `least`. Heading elements
    count before the same words elsewhere, as in a bar of tabs."""
    blank = r"(?:\s|<(?!/h[1-6])[^>]+>)*+"
    heading = rf"<h[1-6][^>]*>{blank}(?:{start}){blank}</h[1-6]>"
    under = found(text, rf"(?is){heading}(.*?)(?:<h[1-6][^>]*>{blank}(?:{end})|\z)")
    between = F.coalesce(found(text, rf"(?is)(?:{start})(.*?)(?:{end})"), found(text, rf"(?is)(?:{start})(.*)\z"))
    body = F.regexp_replace(clean_text(F.coalesce(F.when(F.regexp_like(col(text), F.lit(f"(?is){heading}")), under).otherwise(between), F.lit("")), unescape_all), r"^(?:[：:\s]|&nbsp;)+", "")
    return F.when(F.length(body) >= least, F.substring(body, 1, most)).otherwise("")


def programme(html: Column | str) -> Column:
    return section(html, PROGRAMME, AFTER_PROGRAMME)


def links(pages: DataFrame, telling: bool = False) -> DataFrame:
    """page_id, url, at, href, label and target of every canonical link (label null) and then every anchor; targets are resolved against the page, in the JVM.

    telling: leave out, before anything is cleaned or resolved, anchors that can't score: neither label nor address speaks of the event and nothing points to a social host.
    """
    canonical = F.transform(F.regexp_extract_all("html", F.lit(CANONICAL), 1), lambda h: F.struct(h.alias("href"), F.lit(None).cast("string").alias("label")))
    anchors = F.transform(F.arrays_zip(F.regexp_extract_all("html", F.lit(ANCHOR), 1).alias("href"), F.regexp_extract_all("html", F.lit(ANCHOR), 2).alias("label")), lambda a: F.struct(a["href"].alias("href"), a["label"].alias("label")))
    if telling:
        # Tags and entities within a label may hide a word that cleaning brings out.
        says = lambda a: F.concat_ws(" ", a["label"], a["href"]).rlike(LINK_LABEL) | a["label"].rlike("[<&]") | a["href"].rlike("(?i)instagram|&")
        anchors = F.filter(anchors, lambda a: says(a) | F.coalesce(F.col("url").rlike("(?i)instagram"), F.lit(False)))
    out = pages.select("page_id", "url", F.posexplode(F.concat(canonical, anchors)).alias("at", "a")).select("page_id", "url", "at", "a.href", F.when(F.col("a.label").isNotNull(), clean_text("a.label")).alias("label"))
    return out.withColumn("target", urls.normalize_url(urls.joined("url", unescape_all("href"))))


def link_score(target: Column | str, label: Column | str, href: Column | str) -> Column:
    """Points for a link that may lead to an event's own page: a canonical link, or an anchor whose label or address speaks of the event
    or whose host is social; more for social, ticket and public hosts. Null for all others."""
    host, path = urls.host_of(col(target)), F.lower(urls.path_of(col(target)))
    social, says = host.rlike(urls.SOCIAL_HOST), F.concat_ws(" ", col(label), col(href)).rlike(LINK_LABEL)
    base = F.when(col(label).isNull(), 65).when(col(label).rlike(LINK_LABEL), 80).when(says | social, 45)
    yes = lambda c, n: F.when(c, n).otherwise(0)
    extra = yes(social, 15) + yes(social & F.contains(path, F.lit("/events/")), 45) + yes(host.rlike(urls.TICKET_HOST), 75) + yes(F.contains(host, F.lit("opentix.life")), 35) + yes(host.rlike(urls.PUBLIC_HOST), 30)
    blocked = host.rlike(urls.BLOCKED_HOST) | urls.decoded_path(col(target)).rlike(urls.BLOCKED_PATH)
    return F.when((host != "") & ~blocked & ~path.rlike(LEFT_OUT), base + extra)


def related_pages(pages: DataFrame, most: int = 8) -> DataFrame:
    """page_id, target, score and place of each page's best links, of equals the one found first; Spark keeps `most` rows a page before the shuffle."""
    scored = links(pages, telling=True).withColumn("score", link_score("target", "label", "href")).where("score is not null and target <> url")
    best = scored.groupBy("page_id", "target").agg(F.max("score").alias("score"), F.min("at").alias("at"))
    place = F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("score"), "at"))
    return best.withColumn("place", place).where(F.col("place") <= most).select("page_id", "target", "score", "place")


def verified(events: DataFrame, pages: DataFrame, least: float = 0.42) -> DataFrame:
    """key, score and accepted of events with a page at their url: the title gate."""
    p = pages.select("url", page_title(head("html")).alias("page_title"), F.col("html").alias("page"))
    return events.join(p, "url").withColumn("score", title_score("title", "page_title", "page")).select("key", "score", (F.col("score") >= least).alias("accepted"))
