"""Whole catalogue records: from raw JSON objects to typed rows, and rows of one event merged column by column.

A raw record is a VARIANT, so that members keep their case, may hold a text, a list or an object, and may be missing;
each column takes the first of its aliases that holds something.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from showbill.functions import dates, geo, urls
from showbill.functions.text import clean_place, clean_text, compact_title, drop_lines, first_value, let, stable_id, strip, unescape_all
from showbill.operators import resolve, rules, trees
from showbill.sources.shared import spread, written

# Members by which feeds name a column, in the order in which they are asked.
TITLE = ("title", "titile", "name", "actName")
DESCRIPTION = ("description", "descriptionFilterHtml", "comment")
LATITUDE = ("latitude", "Latitude", "lat", "Lat", "mapLat", "y")
LONGITUDE = ("longitude", "Longitude", "lng", "lon", "Lng", "mapLng", "x")
SESSIONS = ("showInfo", "showinfo", "show_info", "shows", "sessions")
IMAGES = (
    "image", "images", "imageCandidates", "imageUrl", "imageURL", "imageURLList", "imageUrls", "poster", "posterUrl",
    "picture", "pictureUrl", "photo", "photoUrl", "cover", "coverUrl", "representImage",
)
IMAGE_MEMBERS = ("url", "src", "href", "image", "imageUrl", "imageURL", "original", "large", "poster", "cover")
IMAGE_ATTRIBUTES = ("src", "data-src", "data-original", "data-lazy-src", "data-original-src", "data-flickity-lazyload", "data-echo")
LINKS = ("sourceUrl", "sourceWebPromote", "sourceWebSite", "website", "url", "webSales")
LINK_TEXTS = ("description", "descriptionFilterHtml", "comment", "transitInfo")
UNKNOWN_VENUE, UNKNOWN_PRICE, FREE, FEED = "地點待確認", "票價請見活動頁面", "免費", "文化部開放資料"
#: What relative links of feed records are relative to.
FEED_BASE = "https://cloud.culture.tw/"
UNSORTED_VENUE = "｜場館資料整理中"
PLACEHOLDERS = (UNKNOWN_VENUE, UNKNOWN_PRICE, rules.UNKNOWN_REGION, FEED)
# Fixed patterns: venues that are only a district, that are an address, and words that make an address a venue.
DISTRICT = (
    r"^(?:(?:臺|台|新北|桃園|新竹|苗栗|彰化|南投|雲林|嘉義|高雄|屏東|宜蘭|花蓮|臺東|台東|澎湖|金門|連江).{0,3}[市縣].{1,4}區(?:[（(].+[）)])?"
    r"|.{1,6}區(?:[（(](?:臺|台).+[市縣][）)])?)$"
)
STREET, HALL = r"路|街|大道|巷|弄|號|樓", r"館|園區|中心|藝廊|劇院|展場|空間|博物館|美術館|文化館|文創"
# Fixed patterns: calls for entries, and shows of what came of them.
CALL, OUTCOME = r"徵選|徵件|徵稿|招募|報名簡章|申請辦法", r"成果展|入選展|得獎作品展|展覽|展出|發表會|頒獎典禮"
SAMPLE_TEXT = "用於版面檢視"
GALLERY_HOST = r"artemperor\.tw|artgalleryapollo\.com"
SOCIAL_LINE = r"(?i)facebook|fb\.me|臉書"


def read_variants(spark: SparkSession, *paths: str) -> DataFrame:
    """raw (VARIANT), file and ord of the records of JSON files: bare arrays, or arrays named events, data or result.

    Files that are missing, broken or hold no array give no rows; records that aren't objects are left out.
    """
    kept = [p for p in paths if _exists(spark, p)]
    if not kept:
        return spark.createDataFrame([], "ord bigint, file string").select(F.try_parse_json(F.lit("{}")).alias("raw"), "file", "ord")
    whole = spark.read.text(kept, wholetext=True).select(F.try_parse_json("value").alias("v"), F.input_file_name().alias("file"))
    items = F.coalesce(*[F.try_variant_get("v", path, "array<variant>") for path in ("$", "$.events", "$.data", "$.result")])
    rows = whole.select("file", F.posexplode(items).alias("at", "raw")).where(is_object("raw"))
    order = F.array_position(F.array(*[F.lit(p.rsplit("/", 1)[-1]) for p in kept]), F.regexp_extract("file", "[^/]*$", 0))
    return rows.select("raw", "file", (order * (1 << 32) + F.col("at")).alias("ord"))


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop))


def is_object(v: Column | str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))


def text_in(v: Column | str, name: str) -> Column:
    """A member as text; a list's texts are joined."""
    listed = F.try_variant_get(v, f"$.{name}", "array<string>")
    return F.coalesce(F.array_join(F.array_remove(listed, ""), "、"), F.try_variant_get(v, f"$.{name}", "string"))


def members(v: Column | str) -> Column:
    """An object's members by name, map<string, variant>; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def member_texts(of: Column) -> Column:
    """Members as texts, read once for all who ask for them: a map of struct(text, json), where text is what text_in() gives and json a list's own text. Sessions are left out."""
    string = lambda x: F.try_variant_get(x, "$", "string")
    both = lambda _, x: F.struct(F.coalesce(F.array_join(F.array_remove(F.try_variant_get(x, "$", "array<string>"), ""), "、"), string(x)).alias("text"), string(x).alias("json"))
    return F.transform_values(F.map_filter(of, lambda k, _: ~k.isin(*SESSIONS)), both)


def text_of(m: Column | str, name: str) -> Column:
    """text_in(), of member_texts()."""
    return F.try_element_at(F.col(m) if isinstance(m, str) else m, F.lit(name))["text"]


def first_of(m: Column | str, *names: str) -> Column:
    return first_value(*[text_of(m, n) for n in names])


def clean_all(**texts: Column) -> Column:
    """An array of cleaned texts, in the order given: one expression for all."""
    return F.transform(F.array(*texts.values()), lambda t: clean_text(t))


def first_in(v: Column | str, *names: str) -> Column:
    return first_value(*[text_in(v, n) for n in names])


def session_entries(v: Column | str) -> Column:
    """The objects under all session members, each one object or a list of them."""
    return let(members(v), entries_of)


def entries_of(of: Column) -> Column:
    """session_entries(), of members()."""
    one = lambda x: F.coalesce(F.try_variant_get(x, "$", "array<variant>"), F.array_compact(F.array(x)))
    lists = F.transform(F.filter(F.array(*map(F.lit, SESSIONS)), lambda n: F.map_contains_key(of, n)), lambda n: one(F.try_element_at(of, n)))
    return F.filter(F.coalesce(F.flatten(lists), F.array().cast("array<variant>")), lambda x: is_object(x))


def point_in(*vs: Column | str, first=first_in) -> Column:
    """The first source's coordinates that are whole, as given or swapped."""
    return F.coalesce(*[geo.coordinate_pair(first(v, *LATITUDE), first(v, *LONGITUDE)) for v in vs])


def point_of(*ms: Column | str) -> Column:
    return point_in(*ms, first=first_of)


def entry_score(m: Column) -> Column:
    """What a session's member_texts() tell of its place."""
    asked = {25: ("locationName", "venue"), 20: ("location", "address"), 5: ("time", "startTime")}
    told = F.transform(F.array(*[F.struct(F.lit(n).alias("n"), first_of(m, *names).alias("t")) for n, names in asked.items()]), lambda x: F.when(clean_text(x["t"]) != "", x["n"]).otherwise(0))
    return F.when(point_of(m).isNotNull(), 100).otherwise(0) + F.aggregate(told, F.lit(0), lambda a, x: a + x)


def best_of(entries: Column | str, texts=lambda m: m) -> Column:
    """The session that tells most of its place, the first of equals; null without any. entries: member_texts(), or what `texts` makes them of."""
    def best(es: Column) -> Column:
        ranked = F.transform(es, lambda v, i: F.struct(let(texts(v), entry_score).alias("p"), (-i).alias("o")))
        return F.when(F.size(es) < 2, F.get(es, F.lit(0))).otherwise(F.get(es, -F.array_max(ranked)["o"]))

    return let(F.col(entries) if isinstance(entries, str) else entries, best)


def best_entry(entries: Column | str) -> Column:
    """best_of() of VARIANTs."""
    return best_of(entries, lambda v: member_texts(members(v)))


def typed_session(m: Column) -> Column:
    days = F.transform(F.array(first_of(m, "time", "startTime"), first_of(m, "endTime", "end")), lambda t: dates.date_or_text(t))
    texts = clean_all(venue=first_of(m, "locationName", "venue"), address=first_of(m, "location", "address"), price=first_of(m, "price", "Price"), on_sales=text_of(m, "onSales"))
    of = lambda x: F.struct(
        x["d"][0].alias("time"), x["d"][1].alias("end_time"), x["t"][0].alias("venue"), x["t"][1].alias("address"),
        x["at"]["lat"].alias("lat"), x["at"]["lon"].alias("lon"), x["t"][2].alias("price"), x["t"][3].alias("on_sales"),
    )
    return let(F.struct(days.alias("d"), texts.alias("t"), point_of(m).alias("at")), of)


def told(s: Column) -> Column:
    """Whether a session says anything."""
    return (F.concat(*[s[c] for c in ("time", "end_time", "venue", "address", "price", "on_sales")]) != "") | s["lat"].isNotNull()


def flat_texts(c: Column | str) -> Column:
    """The texts in a member that holds a text, or JSON of lists and objects nested to any depth; of an object's members those that name images, if there are any."""
    return trees.leaves(c, IMAGE_MEMBERS)


def image_values(m: Column | str) -> Column:
    """The texts in image members, of member_texts()."""
    m = F.col(m) if isinstance(m, str) else m
    return F.flatten(F.transform(F.filter(F.array(*map(F.lit, IMAGES)), lambda n: F.map_contains_key(m, n)), lambda n: flat_texts(F.try_element_at(m, n)["json"])))


def texts_of(v: Column | str, *names: str) -> Column:
    """The texts in several members, in their order; one expression for all of them."""
    return F.flatten(F.transform(F.array(*[F.try_variant_get(v, f"$.{n}", "string") for n in names]), lambda t: flat_texts(t)))


def html_images(html: Column, base: Column) -> Column:
    """The images of a piece of HTML, by any of the attributes that pages load them by."""
    sources = F.regexp_extract_all(unescape_all(F.coalesce(html, F.lit(""))), F.lit(rf"""(?is)<img[^>]+(?:{'|'.join(IMAGE_ATTRIBUTES)})=["']([^"']+)"""), 1)
    return F.transform(sources, lambda u: urls.joined(base, u))


def content_images(values: Column, base: Column, most: int) -> Column:
    absolute = F.transform(values, lambda u: F.when(base == "", u).otherwise(urls.joined(base, u)))
    return F.slice(F.filter(urls.unique_urls(absolute), lambda u: urls.shows_content(u)), 1, most)


def event_url(m: Column | str, base: str = FEED_BASE) -> Column:
    """The event's own page, against `base` where it is relative: the first link member that is neither blocked nor a ticket host's front page, else the first such URL in the texts that isn't an image."""
    usable = lambda u: (u != "") & ~urls.is_blocked(u) & ~urls.is_ticket_home(u)
    members = F.transform(F.array(*[F.coalesce(text_of(m, n), F.lit("")) for n in LINKS]), lambda u: urls.normalize_url(u, base))
    texts = F.array_join(clean_all(**{n: first_of(m, n) for n in LINK_TEXTS}), " ")
    seen = F.transform(F.regexp_extract_all(texts, F.lit(r"""(?i)(https?://[^\s<>"'）)】」]+)"""), 1), lambda u: urls.normalize_url(F.regexp_replace(u, "[。，、；;:]+$", "")))
    picture = r"(?i)\.(?:jpe?g|png|gif|webp|avif)(?:$|\?)"
    return F.coalesce(F.get(F.filter(members, usable), F.lit(0)), F.get(F.filter(seen, lambda u: usable(u) & ~u.rlike(picture)), F.lit(0)), F.lit(""))


def venue_name(venue: Column, address: Column, profiles: list[tuple[str, list[str]]] = ()) -> Column:
    """struct(group, detail): the first profile's name whose pattern the venue holds, with the rest as detail; a district or an
    address becomes its region's unsorted venues; else the venue itself. profiles: name and patterns, a fixed list."""
    def named(x: Column) -> Column:
        original, options = x["v"], []
        for name, patterns in profiles:
            for p in sorted(filter(None, patterns), key=len, reverse=True):
                at = F.locate(p.lower(), F.lower(original))
                rest = F.when(F.contains(original, F.lit(p)), F.concat(F.substring(original, F.lit(1), at - 1), F.substring(original, at + len(p), F.length(original)))).otherwise(original)
                options.append(F.when(at > 0, F.struct(F.lit(name).alias("group"), F.regexp_replace(clean_place(rest), r"^[\s、,，/\-—－]+", "").alias("detail"))))
        unsorted = original.rlike(DISTRICT) | (original.rlike(STREET) & ~original.rlike(HALL))
        region = F.concat(rules.detect_region(x["a"], original), F.lit(UNSORTED_VENUE))
        return F.coalesce(*options, F.struct(F.when(unsorted, region).otherwise(original).alias("group"), F.lit("").alias("detail")))

    return let(F.struct(clean_place(first_value(venue, address, F.lit(UNKNOWN_VENUE))).alias("v"), address.alias("a")), named)


def venue_by_rules(venue: Column, address: Column, group: Column, detail: Column, aliases: list[tuple[str, str]]) -> Column:
    """struct(group, detail) as the app shows it: a given group stays; else the alias whose pattern, longest first, matches; a district or address becomes its region's unsorted venues."""
    def named(x: Column) -> Column:
        found = [F.when(x["v"].rlike(p), F.struct(F.lit(name).alias("group"), clean_place(F.regexp_replace(x["v"], f"^(.*?)(?:{p})", "$1")).alias("detail"))) for p, name in sorted(aliases, key=lambda a: -len(a[0]))]
        return F.when(x["g"] != "", F.struct(x["g"].alias("group"), x["d"].alias("detail"))).otherwise(F.coalesce(*found, F.struct(x["v"].alias("group"), x["d"].alias("detail"))))

    def shown(b: Column) -> Column:
        unsorted = b["group"].rlike(DISTRICT) | (b["group"].rlike(STREET) & ~b["group"].rlike(HALL))
        region = F.concat(rules.detect_region(first_value(address, b["group"]), profile="app"), F.lit(UNSORTED_VENUE))
        return F.struct(F.when(unsorted, region).otherwise(b["group"]).alias("group"), b["detail"].alias("detail"))

    read = F.struct(clean_place(first_value(venue, address, F.lit(UNKNOWN_VENUE))).alias("v"), clean_place(group).alias("g"), clean_place(detail).alias("d"))
    return let(let(read, named), shown)


def displayable_venue(venue: Column | str) -> Column:
    """Venues that pages list: neither poor nor one of a region's unsorted ones."""
    return ~rules.poor_venue(venue) & ~F.contains(clean_place(venue), F.lit(UNSORTED_VENUE))


def typed(raw: DataFrame, profiles: list[tuple[str, list[str]]] = (), raw_venue: bool = False) -> DataFrame:
    """raw (VARIANT) and ord as full records; rows without a title and excluded ones are dropped before anything else is computed.

    raw_venue: keep what the feed called the venue, for a table of profiles. Texts are never null; coordinates and hits may be.
    """
    # A plain filter would be pushed below what it reads, into the joins and the parsing that made the raw records, and compute that once for every member.
    kept = lambda test, **cs: F.inline(F.filter(F.array(F.struct(*[c.alias(n) for n, c in cs.items()])), test))
    rows = spread(raw.select("raw", "ord"), "ord")
    rows = rows.select("ord", members("raw").alias("_members")).withColumn("_texts", member_texts(F.col("_members")))
    rows = rows.select("*", kept(lambda r: r["_title"] != "", _title=clean_text(first_of("_texts", *TITLE), unescape_all)))
    read = {
        "_unit": clean_text(first_of("_texts", "unit", "organizer", "showUnit", "masterUnit", "org")), "_cat": first_of("_texts", "categories", "categoryName", "category"),
        "_feed": F.coalesce(text_of("_texts", "_feedCategory"), F.lit("")), "_url": event_url("_texts"),
    }
    rows = rows.select("*", kept(lambda r: ~rules.excluded(F.col("_title"), r["_unit"], r["_cat"], r["_url"], r["_feed"]), **read))
    rows = rows.withColumn("_base", F.when(F.col("_url") != "", F.col("_url")).otherwise(FEED_BASE))
    rows = rows.withColumn("_entries", F.transform(entries_of(F.col("_members")), lambda v: member_texts(members(v)))).withColumn("_show", best_of("_entries"))
    s = "_show"
    rows = rows.withColumns({
        "_address": clean_place(first_value(text_of("_texts", "address"), text_of("_texts", "location"), text_of(s, "location"), text_of(s, "address"))),
        "_start": dates.date_or_text(first_value(first_of("_texts", "startDate", "start", "startTime"), first_of(s, "time", "startTime"))),
        "_description": clean_text(first_of("_texts", *DESCRIPTION), unescape_all), "_at": point_of(s, "_texts"),
    })
    rows = rows.withColumn("_raw_venue", clean_place(first_value(first_of("_texts", "venueGroup", "locationName", "venue"), first_of(s, "locationName", "venue"), F.col("_address"), F.lit(UNKNOWN_VENUE))))
    rows = rows.withColumn("_venue", venue_name(F.col("_raw_venue"), F.col("_address"), profiles))
    images = F.concat(image_values("_texts"), F.coalesce(image_values(s), F.array().cast("array<string>")), html_images(first_of("_texts", "descriptionFilterHtml", "description"), F.col("_base")))
    price = clean_text(first_value(first_of("_texts", "price", "Price"), text_of(s, "price"), first_of("_texts", "discountInfo", "charge")))
    unsold = first_value(text_of(s, "onSales"), text_of("_texts", "onSales")).isin("N", "n")
    score, hits = text_of("_texts", "sourceUrlMatchScore"), text_of("_texts", "hitRate")
    rows = rows.withColumns({"_images": content_images(images, F.col("_base"), 8), "_categories": rules.classify("_cat", F.col("_title"), F.col("_description"), feed="_feed")})
    group = F.col("_venue.group")
    own_id = clean_text(first_of("_texts", "id", "UID", "uid", "actId"))
    plain = {
        "place_source": ("coordinateSource",), "transit": ("transitInfo", "transit", "travellinginfo"), "parking": ("parkingInfo", "parkinginfo"), "phone": ("phone", "tel"), "comment": ("comment",),
        "source": ("source", "sourceWebName"), "first_seen": ("firstSeenAt", "first_seen_at"), "last_seen": ("lastSeenAt", "last_seen_at"), "checked_at": ("pageMetadataCheckedAt",), "rejected_url": ("sourceUrlRejected",),
    }
    rows = rows.withColumn("_plain", clean_all(**{c: first_of("_texts", *names) for c, names in plain.items()}))
    text = lambda c: F.get("_plain", F.lit(list(plain).index(c)))
    return rows.select(
        F.when(own_id != "", own_id).otherwise(stable_id("_title", "_start", group, "_url", F.col("ord").cast("string"))).alias("id"),
        F.col("_title").alias("title"), F.col("_description").alias("description"), F.col("_url").alias("source_url"),
        F.coalesce(F.get("_images", F.lit(0)), F.lit("")).alias("image"), F.col("_images").alias("images"), F.col("_categories").alias("categories"), F.get("_categories", F.lit(0)).alias("category"),
        F.col("_start").alias("start_date"), dates.date_or_text(first_value(first_of("_texts", "endDate", "end", "endTime"), text_of(s, "endTime"), F.col("_start"))).alias("end_date"),
        group.alias("venue"), clean_place(first_value(text_of("_texts", "venueDetail"), F.col("_venue.detail"))).alias("venue_detail"), F.col("_address").alias("address"),
        rules.detect_region(F.coalesce(text_of("_texts", "region"), F.lit("")), F.coalesce(text_of("_texts", "cityName"), F.lit("")), F.col("_address"), group, F.col("_raw_venue")).alias("region"),
        F.col("_at.lat").alias("lat"), F.col("_at.lon").alias("lon"),
        F.coalesce(F.nullif(text("place_source"), F.lit("")), F.when(F.col("_at").isNotNull(), "official_feed").otherwise("")).alias("place_source"),
        F.when(price != "", price).when(unsold, FREE).otherwise(UNKNOWN_PRICE).alias("price"), F.col("_unit").alias("organiser"),
        text("transit").alias("transit"), text("parking").alias("parking"), text("phone").alias("phone"), text("comment").alias("comment"),
        F.filter(F.transform("_entries", typed_session), told).alias("sessions"), F.when(hits.rlike(r"^\d{1,18}$"), hits.cast("long")).otherwise(0).alias("hits"),
        F.coalesce(F.nullif(text("source"), F.lit("")), F.lit(FEED)).alias("source"), text("first_seen").alias("first_seen"), text("last_seen").alias("last_seen"),
        text("checked_at").alias("checked_at"), F.coalesce(F.try_variant_get(F.try_element_at("_members", F.lit("sourceUrlVerified")), "$", "boolean"), F.lit(False)).alias("verified"),
        F.when(score.rlike(r"^\d+(\.\d+)?$"), score.cast("double")).otherwise(0.0).alias("match_score"), text("rejected_url").alias("rejected_url"), "ord", *([F.col("_raw_venue").alias("raw_venue")] if raw_venue else []),
    )


#: Members that hold images, in the order in which the app asks them, of the record and of its best session.
APP_IMAGES = ("images", "imageCandidates", "image", "imageURL", "imageUrl", "imageUrls", "poster", "posterUrl", "picture", "pictureUrl")
APP_SESSION_IMAGES = ("image", "imageUrl", "imageURL")
UNNAMED = "未命名展覽"


def plain_text(c: Column) -> Column:
    """A text as a browser shows it: tags dropped, entities decoded, wide gaps as an empty line."""
    return strip(F.regexp_replace(unescape_all(F.regexp_replace(c, r"<[^>]*>", "")), r"(?U)\s{3,}", "\n\n"))


def app_events(raw: DataFrame, aliases: list[tuple[str, str]] = ()) -> DataFrame:
    """raw (VARIANT) and ord as the query app reads them: every record stays, with a name and a price of its own where it has none.

    Unlike typed(), dates are as written, members are asked in the app's order, a region comes from the first of region, address and venue that is told,
    and images are all that show content by the app's rule. aliases: patterns and names of venues, as venue_by_rules() takes them.
    """
    s = "_show"
    lines = lambda c: drop_lines(F.coalesce(c, F.lit("")), SOCIAL_LINE)
    first = lambda *cs: first_value(*cs, profile="app")
    of = lambda v, *names: [text_in(v, n) for n in names]
    rows = raw.select("raw", "ord").withColumn("_show", best_entry(session_entries("raw")))
    rows = rows.withColumns({
        "_title": strip(first(*of("raw", "title", "titile", "name"), F.lit(UNNAMED))), "_text": lines(first(*of("raw", "description", "descriptionFilterHtml", "comment"))),
        "_address": clean_place(first(*of("raw", "address", "location"), *of(s, "location", "address"))), "_link": first(*of("raw", "sourceUrl", "sourceWebPromote", "webSales", "sourceWebSite", "url", "website")),
        "_cat": first(*of("raw", "categories", "categoryName", "category")), "_at": point_in(s, "raw"),
    })
    rows = rows.withColumn("_raw_venue", clean_place(first(*of("raw", "locationName", "venue"), *of(s, "locationName", "venue"), F.col("_address"))))
    none = F.lit("")
    rows = rows.withColumn("_venue", venue_by_rules(F.col("_raw_venue"), F.col("_address"), F.coalesce(text_in("raw", "venueGroup"), none), F.coalesce(text_in("raw", "venueDetail"), none), list(aliases)))
    found = F.concat(texts_of("raw", *APP_IMAGES), texts_of(s, *APP_SESSION_IMAGES))
    free = F.when(first(*of(s, "onSales"), *of("raw", "onSales")) == "N", FREE)
    price = lines(first(*of("raw", "price", "Price"), *of(s, "price"), *of("raw", "discountInfo"), free))
    rows = rows.withColumns({"_images": F.filter(urls.unique_urls(found), lambda u: urls.shows_content(u, "app")), "_categories": rules.classify("_cat", F.col("_title"), F.col("_text"), rules=rules.APP_KEYWORDS)})
    venue = F.when(F.col("_venue.group") != "", F.col("_venue.group")).otherwise(UNKNOWN_VENUE)
    link = urls.normalize_url("_link")
    id = first(*of("raw", "id", "UID", "uid"), F.col("_link"), F.concat_ws("-", "_title", F.col("ord").cast("string")))
    return rows.select(
        id.alias("id"), F.col("_title").alias("title"), plain_text(F.col("_text")).alias("description"), F.when(urls.is_blocked("_link"), "").otherwise(link).alias("source_url"),
        F.coalesce(F.get("_images", F.lit(0)), none).alias("image"), F.col("_images").alias("images"), F.col("_categories").alias("categories"), F.get("_categories", F.lit(0)).alias("category"),
        first(*of("raw", "startDate", "start"), *of(s, "time", "startTime")).alias("start_date"), first(*of("raw", "endDate", "end", "endTime"), *of(s, "endTime"), *of("raw", "startDate")).alias("end_date"),
        venue.alias("venue"), F.col("_venue.detail").alias("venue_detail"), F.col("_address").alias("address"),
        rules.detect_region(first(*of("raw", "region"), F.col("_address"), F.col("_venue.group"), F.col("_raw_venue")), profile="app").alias("region"),
        F.col("_at.lat").alias("lat"), F.col("_at.lon").alias("lon"), first(*of("raw", "coordinateSource", "coordinate_source")).alias("place_source"), F.when(price != "", price).otherwise(UNKNOWN_PRICE).alias("price"),
        lines(first(*of("raw", "unit", "organizer", "showUnit", "masterUnit"))).alias("organiser"), lines(first(*of("raw", "transitInfo", "transit"))).alias("transit"),
        F.coalesce(text_in("raw", "hitRate").try_cast("double"), F.lit(0.0)).cast("long").alias("hits"), first(*of("raw", "firstSeenAt", "first_seen_at")).alias("first_seen"), first(*of("raw", "lastSeenAt", "last_seen_at")).alias("last_seen"), "ord",
    )


def is_sample(id="id", title="title", description="description", url="source_url") -> Column:
    """Records that were made up to view a layout."""
    return F.contains(F.lower(clean_text(url)), F.lit("example.com")) | F.contains(clean_text(description), F.lit(SAMPLE_TEXT)) | (clean_text(id).rlike(r"(?i)^e\d+$") & (clean_text(title) != ""))


def is_call(title="title", description="description") -> Column:
    """Calls for entries without a public outcome."""
    text = F.concat_ws(" ", clean_text(title), clean_text(description))
    return text.rlike(CALL) & ~text.rlike(OUTCOME)


def without_social(records: DataFrame) -> DataFrame:
    """Records as they are published: no social lines in texts and prices, content images only, at most ten."""
    images = F.slice(F.filter(urls.unique_urls(F.concat(F.coalesce("images", F.array().cast("array<string>")), F.array("image"))), lambda u: urls.shows_content(u)), 1, 10)
    texts = {c: drop_lines(F.coalesce(c, F.lit("")), SOCIAL_LINE) for c in ("description", "price", "organiser", "transit", "parking", "comment", "source") if c in records.columns}
    sessions = F.transform("sessions", lambda s: s.withField("price", drop_lines(F.coalesce(s["price"], F.lit("")), SOCIAL_LINE)))
    out = records.withColumns({"images": images, **texts, "sessions": sessions, "rejected_url": F.when(urls.is_blocked("rejected_url"), "").otherwise(F.col("rejected_url"))})
    return out.withColumn("image", F.coalesce(F.get("images", F.lit(0)), F.lit("")))


def record_key(id="id", url="source_url", title="title", start="start_date", venue="venue") -> Column:
    """By the id, else by the URL, else by title, start and venue."""
    named = lambda head, c: let(c, lambda x: F.when(x != "", F.concat(F.lit(head), x)))
    by_url = named("url:", F.lower(F.regexp_replace(clean_text(url), "/+$", "")))
    return F.coalesce(named("id:", F.lower(clean_text(id))), by_url, F.concat(F.lit("text:"), stable_id(title, start, venue)))


def event_semantic_key(title: Column | str = "title", start: Column | str = "start_date", end: Column | str = "end_date") -> Column:
    """Compact title, start and end, by which records of different providers meet; empty without title or start."""
    read = F.struct(compact_title(title).alias("t"), dates.date_or_text(start).alias("s"), dates.date_or_text(end).alias("e"))
    return let(read, lambda x: F.when((x["t"] != "") & (x["s"] != ""), F.concat_ws("|", x["t"], x["s"], F.when(x["e"] != "", x["e"]).otherwise(x["s"]))).otherwise(""))


def source_quality(url="source_url", verified="verified", score="match_score") -> Column:
    """struct(points, score, depth) of a record's page: how far it is from a front page, whether it was verified, and its host."""
    yes = lambda c, n: F.when(c, n).otherwise(0)

    def points(u: Column, path: Column) -> Column:
        host = urls.host_of(u)
        slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
        return 10 + yes(path != "", 14 + F.least(slashes, F.lit(5))) + yes(F.coalesce(F.col(verified), F.lit(False)), 75) + yes(host.rlike(urls.PUBLIC_HOST), 24) + yes(host.rlike(urls.TICKET_HOST), 18) + yes(host.rlike(GALLERY_HOST), 22)

    def rated(u: Column) -> Column:
        usable = (u != "") & ~urls.is_blocked(u) & ~urls.is_ticket_home(u)
        none = F.struct(F.lit(-999).alias("points"), F.lit(0.0).alias("score"), F.lit(0).alias("depth"))
        of = lambda path: F.struct(points(u, path).alias("points"), F.coalesce(F.col(score), F.lit(0.0)).alias("score"), F.length(path).alias("depth"))
        return F.when(usable, let(F.regexp_replace(urls.path_of(u), "/+$", ""), of)).otherwise(none)

    return let(urls.normalize_url(url), rated)


def first_places(records: DataFrame, key: str, column: str, descending: bool = False) -> DataFrame:
    """key and column: the distinct elements of an array column over a key's records, each at its first place (or, descending, the
    later records' first). Elements are combined before they are gathered, so what a task holds of a key is its distinct elements."""
    order = -F.col("ord") if descending else F.col("ord")
    each = records.select(key, order.alias("_o"), F.posexplode(column).alias("_p", "_v"))
    first = each.groupBy(key, "_v").agg(F.min(F.struct("_o", "_p")).alias("_first"))
    gathered = first.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_first", "_v"))).alias("_all"))
    return gathered.select(key, F.transform("_all", lambda x: x["_v"]).alias(column))


def merged(records: DataFrame, key: str) -> DataFrame:
    """One record per key, equal to folding the key's records in the order of `ord`: later values over earlier ones, but

    placeholders never replace values, descriptions don't shrink, poor venues don't replace good ones; the page's columns come
    together from the record of the best page; images and sessions are gathered in order, categories the later record's first.
    Everything but the three lists is aggregates with partial results; all four meet on the key.
    """
    newest_text = ["id", "title", "start_date", "end_date", "venue_detail", "address", "place_source", "organiser", "transit", "parking", "phone", "comment"]
    known = ["region", "price", "source"]
    page = ["source_url", "verified", "match_score", "rejected_url", "checked_at"]
    quality = source_quality()
    rows = records.withColumns({"_poor": rules.poor_venue("venue"), "_quality": quality, "_page": F.struct(*page)})
    latest = {c: resolve.newest(c) for c in newest_text + page}
    best_page = F.max_by("_page", F.struct("_quality", (-F.col("ord")).alias("o")))
    plan = {
        **{c: e.alias(c) for c, e in latest.items() if c not in page},
        **{c: resolve.newest_known(c, placeholders=PLACEHOLDERS).alias(c) for c in known},
        "description": resolve.longest("description").alias("description"), "venue": resolve.best_venue("venue", F.col("_poor"), placeholders=PLACEHOLDERS).alias("venue"),
        **{c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ord"))).alias(c) for c in ("lat", "lon", "hits")},
        "_best": best_page.alias("_best"), "_latest": F.struct(*[latest[c].alias(c) for c in page]).alias("_latest"),
        "first_seen": F.min(F.when(F.col("first_seen") != "", F.col("first_seen"))).alias("first_seen"), "last_seen": F.max("last_seen").alias("last_seen"),
        "ord": F.min("ord").alias("ord"), "_n": F.count("*").alias("_n"),
    }
    out = rows.groupBy(key).agg(*plan.values())
    for column, descending in (("images", False), ("categories", True), ("sessions", False)):
        out = out.join(first_places(records, key, column, descending), key, "left")
    usable = urls.normalize_url("_best.source_url") != ""
    empty = lambda c: F.coalesce(c, F.array().cast(dict(records.dtypes)[c]))
    images = F.slice(F.filter(urls.unique_urls(empty("images")), lambda u: urls.shows_content(u)), 1, 10)
    allowed = F.slice(F.filter(empty("categories"), lambda c: c.isin(*rules.LABELS)), 1, 3)
    out = out.withColumns({
        **{c: F.when(usable, F.col(f"_best.{c}")).otherwise(F.col(f"_latest.{c}")) for c in page}, "images": images,
        "categories": F.when(F.size(allowed) > 0, allowed).otherwise(F.array(F.lit(rules.OTHER))), "sessions": empty("sessions"),
        **{c: F.coalesce(c, F.lit("")) for c in (*newest_text, *known, "description", "venue", "first_seen", "last_seen")},
    })
    out = out.withColumns({"image": F.coalesce(F.get("images", F.lit(0)), F.lit("")), "category": F.get("categories", F.lit(0))})
    return out.select(key, "_n", *[c for c in records.columns if c != key])


def catalogue(incoming: DataFrame, existing: DataFrame, today: Column, now: Column) -> DataFrame:
    """The catalogue after an update: existing and incoming records that are wanted and still relevant, merged by their own keys,
    then by title and dates. Of existing records with one key the last one stands for all, whatever the others say; incoming ones are merged over it.
    first_seen is the earliest, last_seen is now where a record came in or two met. Ordered by start and title."""
    wanted = ~is_call() & ~rules.excluded(F.col("title"), F.col("organiser"), F.concat_ws("、", "categories"), F.col("source_url")) & dates.still_relevant(dates.parse_date("start_date"), dates.parse_date("end_date"), today)
    seen = lambda c, other: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)).otherwise(other)
    old = existing.where(wanted & ~is_sample()).withColumn("first_seen", seen("first_seen", now)).withColumn("last_seen", seen("last_seen", F.col("first_seen")))
    new = incoming.where(wanted).withColumns({"first_seen": seen("first_seen", now), "last_seen": now})
    columns = [c for c in incoming.columns if c != "ord"]
    last = old.select(record_key().alias("_k"), F.struct(*columns, "ord").alias("_r")).groupBy("_k").agg(F.max_by("_r", "_r.ord").alias("_r")).select("_r.*")
    # Each merge reads its rows once for every list that it gathers, so they are written first.
    both = written(resolve.union_ordered(last, new.select(*columns, "ord")).withColumn("_key", record_key()))
    one = written(merged(both, "_key").drop("_n"))
    keyed = one.withColumn("_same", event_semantic_key())
    keyed = keyed.withColumn("_same", F.when(F.col("_same") == "", F.concat(F.lit("row:"), "_key")).otherwise(F.col("_same"))).drop("_key")
    out = merged(keyed, "_same").withColumn("last_seen", F.when(F.col("_n") > 1, now).otherwise(F.col("last_seen")))
    return out.drop("_same", "_n").orderBy(dates.parse_date("start_date").asc_nulls_last(), "title", "ord")


def place_key(place: str, region: str = "region") -> Column:
    """Region and place with spellings folded and marks dropped; empty without a place."""
    fold = lambda c: F.replace(clean_text(c), F.lit("臺"), F.lit("台"))
    t = F.lower(F.regexp_replace(fold(place), r"(?U)[\s　,，、()（）\-]+", ""))
    return F.when(t != "", F.concat_ws("|", fold(region), t)).otherwise("")


def geocode_key(address: str = "address", venue: str = "venue", region: str = "region") -> Column:
    """What a geocoder is asked: the address, else venue and region."""
    asked = first_value(address, F.concat_ws(" ", F.coalesce(venue, F.lit("")), F.coalesce(region, F.lit(""))))
    return F.trim(F.regexp_replace(F.replace(clean_text(asked), F.lit("臺"), F.lit("台")), r"(?U)\s+", " "))


def snapshot(records: DataFrame, updated: str) -> DataFrame:
    """One row: updated and the counts that are published with the catalogue."""
    labels = records.select(F.explode("categories").alias("c")).groupBy("c").agg(F.count("*").alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("c", "n")))).alias("category_counts"))
    whole = records.agg(
        F.count("*").alias("events"), F.sum((F.size("images") > 0).cast("long")).alias("with_image"), F.sum((F.size("images") > 1).cast("long")).alias("with_images"),
        F.sum((F.col("lat").isNotNull() & F.col("lon").isNotNull()).cast("long")).alias("with_place"),
    )
    share = lambda c: F.round(F.coalesce(F.try_divide(F.col(c), F.col("events")), F.lit(0.0)), 4)
    return whole.withColumns({"updated": F.lit(updated), "image_coverage": share("with_image"), "place_coverage": share("with_place"), "category_counts": labels.scalar()})
