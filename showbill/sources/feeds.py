"""Feeds, snapshots and their schema. Network fetches stay outside: they land JSON, and these readers start from it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from showbill.functions import dates, geo, urls
from showbill.functions.text import clean_place, clean_text, first_value, stable_id
from showbill.operators import rules

_text = StringType()
SESSION = StructType([StructField(n, _text) for n in ("time", "endTime", "locationName", "location", "latitude", "longitude", "price", "onSales")])
#: A raw feed record, its aliases side by side; unknown members are dropped by the reader.
RAW = StructType(
    [StructField(n, _text) for n in ("id", "UID", "uid_lower", "actId", "title", "titile", "name", "actName", "description", "descriptionFilterHtml", "comment", "category", "categoryName", "startDate", "start", "startTime", "endDate", "end", "endTime", "venueGroup", "locationName", "venue", "location", "address", "latitude", "longitude", "lat", "lng", "price", "price_upper", "discountInfo", "charge", "onSales", "unit", "organizer", "showUnit", "masterUnit", "sourceUrl", "sourceWebPromote", "website", "url", "webSales", "imageUrl", "hitRate")]
    + [StructField("categories", ArrayType(_text)), StructField("images", ArrayType(_text)), StructField("showInfo", ArrayType(SESSION))]
)
FREE_PRICE, UNKNOWN_PRICE, UNKNOWN_VENUE = "免費", "詳見活動頁面", "地點待確認"


def read_json(spark: SparkSession, *paths: str, schema: StructType = RAW) -> DataFrame:
    """Records of JSON files, bare arrays or wrapped as events, data or result; broken files give no rows. ord follows files and positions."""
    wrapped = StructType([StructField(n, ArrayType(schema)) for n in ("events", "data", "result")])
    lines = spark.read.text(list(paths), wholetext=True).withColumn("_file", F.input_file_name())
    # Spark's columns don't differ by case alone, so the second spelling of a member gets a name of its own.
    for member, name in (("uid", "uid_lower"), ("Price", "price_upper")):
        lines = lines.withColumn("value", F.regexp_replace("value", rf'"{member}"(?=\s*:)', f'"{name}"'))
    whole, bare = F.from_json("value", wrapped), F.from_json("value", ArrayType(schema))
    items = F.when(F.ltrim("value").startswith("["), bare).otherwise(F.coalesce(whole["events"], whole["data"], whole["result"]))
    rows = lines.select("_file", F.posexplode(items).alias("_at", "_r"))
    return rows.select("_r.*", F.concat_ws("#", "_file", F.lpad(F.col("_at").cast("string"), 10, "0")).alias("_place"))


def union_feeds(*feeds: tuple[str, DataFrame]) -> DataFrame:
    """All feeds in order, each row with its feed's name and ordinal."""
    tagged = [f.withColumns({"feed": F.lit(name), "feed_ord": F.lit(i)}) for i, (name, f) in enumerate(feeds)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def session_score(s: Column) -> Column:
    points = lambda n, *names: F.when(first_value(*[s[x] for x in names]) != "", n).otherwise(0)
    return points(100, "latitude") + points(25, "locationName") + points(20, "location") + points(5, "time")


def best_session(sessions: Column) -> Column:
    """The session that tells most of its place; the earliest of equals."""
    ranked = F.transform(sessions, lambda s, i: F.struct(session_score(s).alias("p"), (-i).alias("o"), s.alias("s")))
    return F.array_max(F.filter(ranked, lambda r: r["p"] > 0))["s"]


def normalise(raw: DataFrame, profile: str = "etl") -> DataFrame:
    """Raw records as typed catalogue rows. Rows without a title are dropped in the etl profile and named in the app profile.

    Excluded records are dropped here, before costlier columns are computed.
    """
    s = best_session(F.col("showInfo"))
    title = clean_text(first_value("title", "titile", "name", "actName", profile=profile))
    organiser = clean_text(first_value("unit", "organizer", "showUnit", "masterUnit"))
    category = F.coalesce(F.when(F.size("categories") > 0, F.array_join("categories", "、")), first_value("categoryName", "category"))
    source = F.coalesce(F.try_element_at(urls.unique_urls(F.array("sourceUrl", "sourceWebPromote", "website", "url", "webSales")), F.lit(1)), F.lit(""))
    rows = raw.withColumns({"_title": title if profile == "etl" else F.when(title == "", "未命名活動").otherwise(title), "_org": organiser, "_cat": category, "_src": source})
    rows = rows.where("_title <> ''").where(~rules.excluded(F.col("_title"), F.col("_org"), F.col("_cat"), F.col("_src"), profile=profile))
    address = clean_place(first_value("address", "location", s["location"]))
    venue = clean_place(first_value("venueGroup", "locationName", "venue", s["locationName"], "address"))
    start, end = first_value("startDate", "start", "startTime", s["time"]), first_value("endDate", "end", "endTime", s["endTime"])
    images = F.slice(F.filter(urls.unique_urls(F.concat(F.coalesce("images", F.array()), F.array("imageUrl"))), lambda u: urls.is_content_image(u, profile)), 1, 8)
    at = F.coalesce(geo.coordinate_pair(F.coalesce("latitude", "lat"), F.coalesce("longitude", "lng")), geo.coordinate_pair(s["latitude"], s["longitude"]))
    price = F.when(F.col("onSales") == "N", FREE_PRICE).otherwise(F.coalesce(F.nullif(clean_text(first_value("price", "price_upper", s["price"], "discountInfo", "charge")), F.lit("")), F.lit(UNKNOWN_PRICE)))
    key = F.coalesce(F.nullif(first_value("id", "UID", "uid_lower", "actId"), F.lit("")), stable_id("_title", start, venue))
    return rows.select(
        key.alias("key"), F.col("_title").alias("title"), clean_text(first_value("description", "descriptionFilterHtml", "comment")).alias("description"), F.col("_src").alias("source_url"),
        images.alias("images"), rules.classify("_cat", F.col("_title"), clean_text("description")).alias("categories"),
        dates.parse_date(start).alias("start"), dates.parse_date(end).alias("end"), dates.date_or_text(start).alias("start_text"), dates.date_or_text(end).alias("end_text"),
        F.when(venue == "", UNKNOWN_VENUE).otherwise(venue).alias("venue"), address.alias("address"), rules.detect_region(address, venue, F.col("_title"), profile=profile).alias("region"),
        at["lat"].alias("lat"), at["lon"].alias("lon"), price.alias("price"), F.col("_org").alias("organiser"),
        F.when(F.col("hitRate").rlike(r"^\d{1,18}$"), F.col("hitRate").cast("long")).otherwise(0).alias("hits"),
        F.filter(F.col("showInfo"), lambda x: F.greatest(*[F.coalesce(x[n.name], F.lit("")) for n in SESSION.fields]) != "").alias("sessions"), *[c for c in ("ord", "feed_ord", "_place") if c in raw.columns],
    )


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """v (VARIANT) of each whole JSON file at a path; none where it is missing or broken."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop):
        return spark.range(0).select(F.try_parse_json(F.lit("{}")).alias("v"))
    return spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v")).where("v is not null")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """profile (its number), canonical, homepage, pattern and place of every pattern in a file of venue profiles: a list of objects with name and patterns, or one
    named venues. Items that aren't objects or have no name are left out."""
    listed = F.coalesce(*[F.try_variant_get("v", p, "array<variant>") for p in ("$.venues", "$")])
    text = lambda n: F.try_variant_get("x", f"$.{n}", "string")
    rows = _documents(spark, path).select(F.posexplode(listed).alias("profile", "x"))
    named = rows.select("profile", clean_place(text("name")).alias("canonical"), F.coalesce(text("homepage"), F.lit("")).alias("homepage"), F.try_variant_get("x", "$.patterns", "array<string>").alias("_p")).where("canonical <> ''")
    return named.select("profile", "canonical", "homepage", F.posexplode(F.transform("_p", lambda p: clean_place(p))).alias("place", "pattern")).where("pattern <> ''")


#: Members of a correction and the columns that they correct (fixed values of the file's format).
OVERRIDDEN = {
    "description": "description", "sourceUrl": "source_url", "venueGroup": "venue", "venueDetail": "venue_detail", "address": "address", "region": "region",
    "latitude": "lat", "longitude": "lon", "price": "price", "unit": "organiser", "startDate": "start_date", "endDate": "end_date",
}


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """title, start, end, ord and new_<column> of a file of curated corrections, as overlay.override() takes them; members of `set` that no column has are left out.

    Without a start or an end, any fits. locationName stands for venueGroup where that is missing.
    """
    listed = F.try_variant_get("v", "$.overrides", "array<variant>")
    text = lambda n: F.coalesce(F.try_variant_get("x", f"$.{n}", "string"), F.lit(""))
    day = lambda n: F.nullif(dates.date_or_text(text(n)), F.lit(""))
    given = lambda n: F.coalesce(F.try_variant_get("x", f"$.set.{n}", "string"), F.try_variant_get("x", "$.set.locationName", "string") if n == "venueGroup" else F.lit(None))
    typed = {n: given(n).try_cast("double") if c in ("lat", "lon") else given(n) for n, c in OVERRIDDEN.items()}
    rows = _documents(spark, path).select(F.posexplode(listed).alias("ord", "x")).where(text("title") != "")
    return rows.select(text("title").alias("title"), day("startDate").alias("start"), day("endDate").alias("end"), "ord", *[typed[n].alias(f"new_{c}") for n, c in OVERRIDDEN.items()])


def read_venue_images(spark: SparkSession, path: str) -> DataFrame:
    """venue and image of a file with an object named venueImages; only repaired URLs of content images that aren't blocked."""
    rows = _documents(spark, path).select(F.explode(F.try_variant_get("v", "$.venueImages", "map<string,string>")).alias("venue", "image"))
    named = rows.select(clean_place("venue").alias("venue"), urls.normalize_url("image").alias("image"))
    return named.where((F.col("venue") != "") & (F.col("image") != "") & ~urls.is_blocked("image") & urls.shows_content(F.col("image")))


def read_geocodes(spark: SparkSession, path: str) -> DataFrame:
    """asked, lat and lon of a file that maps texts to pairs of numbers, or to null where nothing was found."""
    rows = _documents(spark, path).select(F.explode(F.try_variant_get("v", "$", "map<string,array<double>>")).alias("asked", "p"))
    at = lambda i: F.when(F.size("p") == 2, F.get("p", F.lit(i)))
    return rows.select("asked", at(0).alias("lat"), at(1).alias("lon"))


def first_available(*readers) -> DataFrame:
    """The first reader's frame that has rows; an error if none has. Each reader is a function without arguments."""
    errors = []
    for read in readers:
        try:
            df = read()
            if not df.isEmpty():
                return df
        except Exception as e:  # a source that is out of order: the next one is asked, and the error is told if none works
            errors.append(e)
    raise ValueError(f"no source has rows: {errors}")


def write_snapshot(events: DataFrame, path: str) -> None:
    """Replaces the snapshot; Spark's committer publishes files only when all tasks are done."""
    events.write.mode("overwrite").parquet(path)


def event_json(today: Column | None = None) -> Column:
    """A schema.org Event as JSON text, without null members."""
    place = F.struct(F.lit("Place").alias("@type"), F.col("venue").alias("name"), F.col("address").alias("address"))
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit("Event").alias("@type"), F.col("title").alias("name"), F.col("start").cast("string").alias("startDate"), F.col("end").cast("string").alias("endDate"), place.alias("location")), {"ignoreNullFields": "true"})
