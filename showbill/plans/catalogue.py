"""Registered queries over the test tables, each with its DuckDB twin.

`catalog` makes a catalogue of dated events from orders, customers, nations and regions; `places` gives points from
embeddings. Queries take today as a fixed date.
"""

from __future__ import annotations

import datetime
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from showbill.functions import dates, geo, text, urls
from showbill.operators import enrich, extract, facets, listing, overlay, pages, recommend, records, resolve, rules
from showbill.operators.listing import ListingQuery
from showbill.sources.shared import spread, written

TODAY = datetime.date(1998, 8, 2)
QUERIES: dict = {}
ORACLES: dict[str, str] = {}

CAT = """
cat AS (
  SELECT o_orderkey AS key, c_name AS title, c_mktsegment AS category, n_name AS venue, r_name AS region,
    CAST(o_orderdate AS DATE) AS sd, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER) AS ed,
    CAST(floor(o_totalprice / 10) AS BIGINT) AS hits, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'https://img.example.org/' || o_orderkey || '.jpg' END AS image,
    CASE WHEN o_orderpriority LIKE '5%' THEN 'Free entry' ELSE 'from ' || o_orderpriority END AS price, o_orderstatus AS status
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""
ONGOING = "sd <= DATE '1998-08-02' AND ed >= DATE '1998-08-02'"
SCORE = f"""(least(hits, 50000) / 500.0::DOUBLE + CASE WHEN image <> '' THEN 20.0::DOUBLE ELSE 0 END + CASE WHEN {ONGOING} THEN 18.0::DOUBLE ELSE 0 END
  + CASE WHEN {ONGOING} AND ed - DATE '1998-08-02' BETWEEN 0 AND 14 THEN 8.0::DOUBLE ELSE 0 END
  + (list_sum(list_transform(string_split(CAST(key AS VARCHAR), ''), lambda x: unicode(x))) % 997) / 1000000.0::DOUBLE)"""


def query(oracle: str | None):
    def register(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return register


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def catalog(spark: SparkSession, d: str) -> DataFrame:
    orders, customer, nation, region = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    start = F.col("o_orderdate").cast("date")
    return joined.select(
        F.col("o_orderkey").alias("key"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("category"), F.array("c_mktsegment").alias("categories"), F.col("n_name").alias("venue"), F.col("r_name").alias("region"),
        start.alias("start"), F.date_add(start, (F.col("o_orderkey") % 60).cast("int")).alias("end"), F.floor(F.col("o_totalprice") / 10).alias("hits"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit("https://img.example.org/"), F.col("o_orderkey").cast("string"), F.lit(".jpg"))).alias("image"),
        F.when(F.col("o_orderpriority").startswith("5"), "Free entry").otherwise(F.concat(F.lit("from "), "o_orderpriority")).alias("price"),
        F.lit("").alias("description"), start.alias("first_seen"), F.col("o_orderstatus").alias("status"),
    )


def places(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("key"), (25 + F.get("embedding", F.lit(0)).cast("double")).alias("lat"), (121 + F.get("embedding", F.lit(1)).cast("double")).alias("lon"), "label")


PLACES = "places AS (SELECT vec_id AS key, 25 + CAST(embedding[1] AS DOUBLE) AS lat, 121 + CAST(embedding[2] AS DOUBLE) AS lon, label FROM embeddings)"
KM = "6371.0::DOUBLE * 2 * atan2(sqrt({a}), sqrt(greatest(0.0::DOUBLE, 1 - {a})))".format(a="(pow(sin(radians(lat - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians(lat)) * pow(sin(radians(lon - {lon}) / 2), 2))")


# Listing


@query(f"WITH {CAT} SELECT key, title, CAST(sd AS VARCHAR) AS start FROM cat WHERE category IN ('BUILDING', 'MACHINERY') AND region = 'ASIA' AND sd > DATE '1998-08-02' ORDER BY sd DESC NULLS LAST, key LIMIT 20")
def listing_filtered_topk(spark, d):
    q = ListingQuery(TODAY, categories=frozenset({"BUILDING", "MACHINERY"}), region="ASIA", status="upcoming", sort="newest")
    return listing.listing(catalog(spark, d), q, 20).select("key", "title", F.col("start").cast("string").alias("start"))


@query(f"WITH {CAT} SELECT key, title FROM cat WHERE contains(lower(concat_ws(' ', title, venue, region, category)), 'asia build')")
def listing_text_search(spark, d):
    return listing.filtered(catalog(spark, d), ListingQuery(TODAY, text="ASIA build")).select("key", "title")


@query(f"WITH {CAT} SELECT key, category FROM cat WHERE category IN ('AUTOMOBILE', 'FURNITURE')")
def listing_multi_category(spark, d):
    return listing.filtered(catalog(spark, d), ListingQuery(TODAY, categories=frozenset({"AUTOMOBILE", "FURNITURE"}))).select("key", "category")


def _status(name: str, where: str):
    def run(spark, d):
        return listing.filtered(catalog(spark, d), ListingQuery(TODAY, status=name)).select("key", F.col("start").cast("string").alias("start"), F.col("end").cast("string").alias("end"))

    run.__name__ = f"status_{name}"
    query(f'WITH {CAT} SELECT key, CAST(sd AS VARCHAR) AS start, CAST(ed AS VARCHAR) AS "end" FROM cat WHERE {where}')(run)


_status("ongoing", ONGOING)
_status("upcoming", "sd > DATE '1998-08-02'")
_status("ending", f"{ONGOING} AND ed - DATE '1998-08-02' BETWEEN 0 AND 30")
_status("free", "regexp_matches(price, '(?i)free')")
_status("recent", "DATE '1998-08-02' - sd BETWEEN 0 AND 7")


@query(f"WITH {CAT} SELECT key FROM cat WHERE {ONGOING} AND ed - DATE '1998-08-02' BETWEEN 0 AND 14")
def status_ending_14(spark, d):
    return catalog(spark, d).where(dates.is_ending("start", "end", F.lit(TODAY), 14)).select("key")


@query(f"WITH {CAT} SELECT key FROM cat WHERE sd <= DATE '1999-01-15' AND ed >= DATE '1999-01-15'")
def occurs_on_date(spark, d):
    return listing.filtered(catalog(spark, d), ListingQuery(TODAY, date=datetime.date(1999, 1, 15))).select("key")


@query(f"WITH {CAT} SELECT key FROM cat WHERE coalesce(ed, sd) >= DATE '1998-07-26' AND sd <= DATE '1998-08-02' + 550")
def still_relevant(spark, d):
    return catalog(spark, d).where(dates.still_relevant("start", "end", F.lit(TODAY))).select("key")


@query(f"WITH {CAT} SELECT key, CASE WHEN key % 7 = 0 THEN NULL ELSE CAST(ed AS VARCHAR) END AS \"end\" FROM cat ORDER BY 2 NULLS LAST, key LIMIT 25")
def sort_ending_nulls_last(spark, d):
    events = catalog(spark, d).withColumn("end", F.when(F.col("key") % 7 != 0, F.col("end")))
    return events.orderBy(*listing.order_of("ending", F.lit(TODAY))).limit(25).select("key", F.col("end").cast("string").alias("end"))


@query(f"WITH {CAT} SELECT key, round({SCORE}, 6) AS score FROM cat")
def recommendation_score(spark, d):
    return catalog(spark, d).select("key", F.round(listing.score(F.lit(TODAY)), 6).alias("score"))


@query(f"WITH {CAT} SELECT title, key, round(score, 6) AS score FROM (SELECT title, key, {SCORE} AS score, CAST(image <> '' AS INT) AS im FROM cat) QUALIFY row_number() OVER (PARTITION BY title ORDER BY im DESC, score DESC, key) = 1 ORDER BY im DESC, score DESC, key LIMIT 9")
def featured_topk_distinct(spark, d):
    return listing.featured(catalog(spark, d), TODAY, 9, by="title").select("title", "key", F.round("score", 6).alias("score"))


@query(f"""WITH {CAT} SELECT key, array_to_string(CASE WHEN len(b) = 0 THEN ['curated'] ELSE b[1:2] END, ',') AS badges FROM (SELECT key, list_filter([
  CASE WHEN DATE '1998-08-02' - sd BETWEEN 0 AND 7 THEN 'new' END, CASE WHEN sd > DATE '1998-08-02' THEN 'upcoming' END,
  CASE WHEN {ONGOING} AND ed - DATE '1998-08-02' BETWEEN 0 AND 14 THEN 'ending' END, CASE WHEN price LIKE 'Free%' THEN 'free' END], lambda x: x IS NOT NULL) AS b FROM cat)""")
def special_badges(spark, d):
    return catalog(spark, d).select("key", F.array_join(listing.badges(F.lit(TODAY)), ",").alias("badges"))


@query(f"WITH {CAT} SELECT key, CASE WHEN sd = ed THEN strftime(sd, '%Y.%m.%d') ELSE strftime(sd, '%Y.%m.%d') || ' – ' || strftime(ed, '%Y.%m.%d') END AS shown FROM cat")
def date_range_text(spark, d):
    return catalog(spark, d).select("key", dates.date_range("start", "end").alias("shown"))


# Facets and calendars


@query(f"WITH {CAT} SELECT category, count(*) AS n FROM cat GROUP BY 1")
def category_counts(spark, d):
    return facets.label_counts(catalog(spark, d))


@query(f"WITH {CAT} SELECT venue, count(*) AS n FROM cat GROUP BY 1 ORDER BY n DESC, venue LIMIT 36")
def venue_counts_top36(spark, d):
    return facets.top_counts(catalog(spark, d), "venue", 36)


@query(f"WITH {CAT} SELECT region, venue, count(*) AS n FROM cat GROUP BY GROUPING SETS ((region), (region, venue))")
def region_venue_facets(spark, d):
    return facets.region_venues(catalog(spark, d))


@query(f"WITH {CAT} SELECT count(DISTINCT venue) AS venues FROM cat")
def distinct_venues(spark, d):
    return catalog(spark, d).agg(F.count_distinct("venue").alias("venues"))


@query(f"WITH {CAT}, c AS (SELECT *, CASE WHEN key % 4 <> 0 THEN 25.0 END AS lat FROM cat) SELECT count(*) AS event_count, count(*) FILTER (image <> '') AS image_count, count(*) FILTER (lat IS NOT NULL) AS coordinate_count, round_even(count(*) FILTER (image <> '') / count(*)::DOUBLE, 4) AS image_coverage, round_even(count(*) FILTER (lat IS NOT NULL) / count(*)::DOUBLE, 4) AS coordinate_coverage FROM c")
def snapshot_stats(spark, d):
    at = F.when(F.col("key") % 4 != 0, 25.0)
    return facets.snapshot(catalog(spark, d).withColumns({"lat": at, "lon": at}))


@query(f"WITH {CAT} SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS day, count(key) AS n FROM generate_series(DATE '1998-08-01', DATE '1998-08-31', INTERVAL 1 DAY) g(day) LEFT JOIN cat ON sd <= day AND ed >= day GROUP BY 1")
def calendar_month_counts(spark, d):
    return facets.calendar(catalog(spark, d), datetime.date(1998, 8, 1), datetime.date(1998, 8, 31)).select(F.col("day").cast("string").alias("day"), F.col("n").cast("long").alias("n"))


# Text, dates and URLs


@query(r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(html, '&nbsp;', ' '), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '<br\s*/?>', chr(10), 'gi'), '<[^>]+>', '', 'g'), '[ \t\r\f\x0B]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS plain FROM pages""")
def clean_text_pages(spark, d):
    return table(spark, d, "pages").select("page_id", text.clean_text("html").alias("plain"))


@query(r"SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '' AND NOT regexp_matches(x, '(?i)licen[cs]e')), chr(10)) AS kept FROM documents")
def strip_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", text.drop_lines("text", "(?i)licen[cs]e").alias("kept"))


COMPACT = r"regexp_replace(lower(text), '[^0-9a-z\x{3400}-\x{9fff}]+', '', 'g')"


@query(f"SELECT sha256({COMPACT} || '|2026-01-0' || (length(source) % 9 + 1) || '|2026-02-01') AS key, min(doc_id) AS first_id, count(*) AS n FROM documents WHERE {COMPACT} <> '' GROUP BY 1")
def semantic_dedupe(spark, d):
    """Documents as events, by their semantic key: of a key only its digest is shuffled, not the text."""
    docs = table(spark, d, "documents").withColumn("start", F.concat(F.lit("2026/01/0"), (F.length("source") % 9 + 1).cast("string")))
    key = records.event_semantic_key("text", "start", F.lit("2026-02-01"))
    # Texts without a key are left out after the sums: a filter on the key would be pushed below them and compute it twice.
    told = F.max(F.col("key") != hashlib.sha256(b"").hexdigest()).alias("told")
    return docs.select("doc_id", F.sha2(key, 256).alias("key")).groupBy("key").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), told).where("told").drop("told")


@query("SELECT doc_id, substr(sha1(concat_ws('|', source, lang, CAST(doc_id AS VARCHAR))), 1, 18) AS id FROM documents")
def stable_ids(spark, d):
    return table(spark, d, "documents").select("doc_id", text.stable_id("source", "lang", F.col("doc_id").cast("string")).alias("id"))


@query(r"""WITH raw AS (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 1 THEN 'from ' || strftime(o_orderdate, '%Y-%m-%d') || ' on' WHEN 2 THEN '2026-02-30' ELSE 'soon' END AS raw FROM orders)
SELECT o_orderkey, try_strptime(nullif(regexp_extract(replace(raw, '/', '-'), '\d{4}-\d{1,2}-\d{1,2}'), ''), '%Y-%m-%d')::DATE::VARCHAR AS day, coalesce(strftime(try_strptime(nullif(regexp_extract(replace(raw, '/', '-'), '\d{4}-\d{1,2}-\d{1,2}'), ''), '%Y-%m-%d'), '%Y-%m-%d'), raw) AS shown FROM raw""")
def parse_date_validity(spark, d):
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.replace(day, F.lit("-"), F.lit("/"))).when(k == 1, F.concat(F.lit("from "), day, F.lit(" on"))).when(k == 2, "2026-02-30").otherwise("soon")
    return table(spark, d, "orders").withColumn("raw", raw).select("o_orderkey", dates.parse_date("raw").cast("string").alias("day"), dates.date_or_text("raw").alias("shown"))


@query(r"SELECT page_id, lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) AS host, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages")
def page_host(spark, d):
    return table(spark, d, "pages").select("page_id", urls.url_host("url").alias("host"), urls.url_path("url").alias("path"))


@query("SELECT event_id, TRY_CAST(nullif(regexp_extract(props, '\"k\":\\s*(-?\\d+)', 1), '') AS BIGINT) AS k FROM events")
def json_props_extract(spark, d):
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query(r"SELECT doc_id, CASE WHEN length(text) > 180 THEN rtrim(substr(text, 1, 180), ' ') || '…' ELSE text END AS short FROM documents")
def summary_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text.summary("text").alias("short"))


# Rules

_KEYWORDS = [("metal", r"(?i)brass|copper|nickel|steel|tin"), ("small", r"(?i)small|economy"), ("promo", r"(?i)promo"), ("plated", r"(?i)plated|polished|burnished")]


@query("SELECT p_partkey, array_to_string(list_filter([" + ", ".join(f"CASE WHEN regexp_matches(p_name || ' ' || p_type, '{p}') THEN '{n}' END" for n, p in reversed(_KEYWORDS)) + "], lambda x: x IS NOT NULL)[1:3], ',') AS labels FROM part")
def keyword_classify_topn(spark, d):
    labels = rules.keyword_labels(F.concat_ws(" ", "p_name", "p_type"), _KEYWORDS)
    return table(spark, d, "part").select("p_partkey", F.array_join(F.slice(labels, 1, 3), ",").alias("labels"))


#: Titles of every kind the rules tell apart, each joined to a part's name, and organisers.
_TITLES = ["國際攝影展", "社區志工成果展", "春季講座", "全國比賽", "比賽得獎作品展", "當代藝術 photo 展", "某某區公所音樂會", "AI 機器人科技展", "里民活動 市集", "台南市某某協會 舞蹈公演", "親子電影節", "community talk"]
_ORGANISERS = ["", "美術館", "台南市文化局", "某某區公所", "同好會"]


def _rows_of_titles(spark, d):
    at = lambda values, n: F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("p_partkey") % n + 1).cast("int"))
    return table(spark, d, "part").select("p_partkey", F.concat_ws(" ", at(_TITLES, 12), "p_name").alias("title"), at(_ORGANISERS, 5).alias("org"))


_TITLED = f"titled AS (SELECT p_partkey, {_TITLES}[CAST(p_partkey % 12 + 1 AS INTEGER)] || ' ' || p_name AS title, {_ORGANISERS}[CAST(p_partkey % 5 + 1 AS INTEGER)] AS org FROM part)"


def _says(text_sql: str, pattern: str) -> str:
    """A rule's pattern in the twin; RE2 has no looking around, so a neighbour is matched instead, which changes no verdict."""
    for java, re2 in {"(?iU)": "(?i)", r"(?<!\w)": r"(?:^|[^\pL\pN_])", r"(?!\w)": r"(?:[^\pL\pN_]|$)", "(?<!攝)": "(?:^|[^攝])"}.items():
        pattern = pattern.replace(java, re2)
    return f"regexp_matches({text_sql}, '{pattern}')"


_BOTH = "(title || ' ' || org)"
_APP_OUT = " OR ".join([
    _says("title", rules.EXCLUDED_TITLE), _says("title", rules.SMALL_ACTIVITY), f"{_says(_BOTH, rules.COMMUNITY)} AND NOT {_says(_BOTH, rules.LARGE_EVENT)}",
    f"{_says(_BOTH, rules.LOCAL_CLUB)} AND NOT {_says('title', rules.PUBLIC_SHOW)} AND NOT {_says(_BOTH, rules.LARGE_EVENT)}",
])
_ETL_OUT = " OR ".join([_APP_OUT, _says(_BOTH, rules.LOCAL_GOVERNMENT), _says(_BOTH, rules.SMALL_SHOW), f"{_says('title', rules.CONTEST)} AND NOT {_says('title', rules.CONTEST_SHOW)}"])


@query(f"WITH {_TITLED} SELECT p_partkey, {_ETL_OUT} AS etl_out, {_APP_OUT} AS app_out FROM titled")
def exclusion_policy(spark, d):
    return _rows_of_titles(spark, d).select("p_partkey", rules.excluded("title", "org").alias("etl_out"), rules.excluded("title", "org", profile="app").alias("app_out"))


_FOUND = ", ".join(f"CASE WHEN {_says('title', p)} THEN '{n}' END" for n, p in reversed(rules.KEYWORDS) if n != rules.OTHER)


@query(f"WITH {_TITLED}, found AS (SELECT p_partkey, list_filter([{_FOUND}], lambda x: x IS NOT NULL) AS l FROM titled) SELECT p_partkey, array_to_string(CASE WHEN len(l) = 0 THEN ['{rules.OTHER}'] ELSE l[1:3] END, ',') AS labels FROM found")
def catalogue_rules(spark, d):
    return _rows_of_titles(spark, d).select("p_partkey", F.array_join(rules.classify(F.lit(""), "title", F.lit("")), ",").alias("labels"))


# Places


@query(f"WITH {PLACES}, raw AS (SELECT key, CASE WHEN key % 3 = 0 THEN lon WHEN key % 11 = 1 THEN 0 ELSE lat END AS a, CASE WHEN key % 3 = 0 THEN lat ELSE lon END AS b FROM places) SELECT key, CASE WHEN a <> 0 AND a BETWEEN -90 AND 90 THEN round(round_even(a, 7), 5) WHEN a <> 0 THEN round(round_even(b, 7), 5) END AS lat, CASE WHEN a <> 0 AND a BETWEEN -90 AND 90 THEN round(round_even(b, 7), 5) WHEN a <> 0 THEN round(round_even(a, 7), 5) END AS lon FROM raw")
def coordinate_pair_swap(spark, d):
    k = F.col("key") % 3 == 0
    raw = places(spark, d).select("key", F.when(k, F.col("lon")).when(F.col("key") % 11 == 1, 0.0).otherwise(F.col("lat")).alias("a"), F.when(k, F.col("lat")).otherwise(F.col("lon")).alias("b"))
    at = geo.coordinate_pair("a", "b")
    return raw.select("key", F.round(at["lat"], 5).alias("lat"), F.round(at["lon"], 5).alias("lon"))


@query(f"WITH {PLACES} SELECT key, round({KM.format(lat='25.05::DOUBLE', lon='121.02::DOUBLE')}, 4) AS km FROM places ORDER BY {KM.format(lat='25.05::DOUBLE', lon='121.02::DOUBLE')}, key LIMIT 30")
def nearest_k(spark, d):
    return geo.nearest(places(spark, d), 25.05, 121.02, 30).select("key", F.round("distance_km", 4).alias("km"))


@query(f"WITH {PLACES} SELECT key, round({KM.format(lat='25.05::DOUBLE', lon='121.02::DOUBLE')}, 4) AS km FROM places WHERE {KM.format(lat='25.05::DOUBLE', lon='121.02::DOUBLE')} <= 10 ORDER BY 2, key LIMIT 200")
def haversine_radius(spark, d):
    return geo.nearest(places(spark, d), 25.05, 121.02, 200, most_km=10).select("key", F.round("distance_km", 4).alias("km"))


_CIRCLES = [("0", 25.0, 121.0, 12.0), ("1", 25.1, 121.1, 20.0), ("2", 24.9, 120.9, 9.0)]


@query(f"WITH {PLACES}, c(region, clat, clon, r) AS (VALUES {', '.join(f'({a!r}, {b}::DOUBLE, {c}::DOUBLE, {e}::DOUBLE)' for a, b, c, e in _CIRCLES)}) SELECT key, coalesce(lat BETWEEN 20 AND 27 AND lon BETWEEN 117.5 AND 124 AND (r IS NULL OR {KM.format(lat='clat', lon='clon')} <= r), false) AS ok FROM places LEFT JOIN c ON CAST(label AS VARCHAR) = region")
def region_circle_validation(spark, d):
    circles = spark.createDataFrame(_CIRCLES, "region string, center_lat double, center_lon double, radius_km double")
    return geo.within_region(places(spark, d).withColumn("region", F.col("label").cast("string")), circles).select("key", F.col("region_ok").alias("ok"))


@query("""WITH s AS (SELECT s_suppkey AS key, CAST(s_nationkey AS VARCHAR) AS venue, CAST(s_nationkey % 5 AS VARCHAR) || '-' || CAST(s_suppkey % 3 AS VARCHAR) AS address,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_nationkey % 4 = 0 THEN 20.0 + s_suppkey ELSE 20.0 + s_nationkey END::DOUBLE AS lat FROM supplier),
a AS (SELECT 'a' AS t, address AS k, min(lat) AS lo, max(lat) AS hi FROM s WHERE lat IS NOT NULL GROUP BY address), v AS (SELECT 'v' AS t, venue AS k, min(lat) AS lo, max(lat) AS hi FROM s WHERE lat IS NOT NULL GROUP BY venue),
bad AS (SELECT k FROM a WHERE lo <> hi UNION SELECT k FROM v WHERE lo <> hi)
SELECT key, coalesce(s.lat, a.lo, v.lo) AS lat, CASE WHEN s.lat IS NOT NULL THEN 'own' WHEN a.lo IS NOT NULL THEN 'address' WHEN v.lo IS NOT NULL THEN 'venue' END AS place_source
FROM s LEFT JOIN a ON s.address = a.k AND a.k NOT IN (SELECT k FROM bad) LEFT JOIN v ON s.venue = v.k AND v.k NOT IN (SELECT k FROM bad)""")
def place_inherit_unambiguous(spark, d):
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    lat = F.when(k % 5 != 0, F.when(n % 4 == 0, 20.0 + k).otherwise(20.0 + n)).cast("double")
    s = table(spark, d, "supplier").select(k.alias("key"), n.cast("string").alias("venue"), F.concat_ws("-", (n % 5).cast("string"), (k % 3).cast("string")).alias("address"), lat.alias("lat"), lat.alias("lon"))
    return overlay.inherit_places(s, ["address", "venue"]).select("key", "lat", "place_source")


@query("SELECT c_custkey, CASE WHEN n.k IS NULL THEN 'unknown' WHEN n.lat IS NULL THEN 'known_missing' ELSE 'hit' END AS cache_state, n.lat AS cached_lat FROM customer LEFT JOIN (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 <> 0 THEN n_nationkey + 0.5::DOUBLE END AS lat FROM nation WHERE n_nationkey < 20) n ON c_nationkey = n.k")
def cache_lookup_negative(spark, d):
    lat = F.when(F.col("n_nationkey") % 3 != 0, F.col("n_nationkey") + F.lit(0.5))
    cache = table(spark, d, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("c_nationkey"), lat.alias("lat"), lat.alias("lon"))
    return overlay.cached(table(spark, d, "customer"), cache, "c_nationkey").select("c_custkey", "cache_state", "cached_lat")


_ALIASES = [("Copper House", ["copper", "COPPER plate"]), ("Steel Hall", ["steel"]), ("Red Room", ["red", "rose"])]


@query("SELECT p_partkey, CASE WHEN contains(lower(p_type || ' ' || p_name), 'copper') THEN 'Copper House' WHEN contains(lower(p_type || ' ' || p_name), 'steel') THEN 'Steel Hall' WHEN contains(lower(p_type || ' ' || p_name), 'red') OR contains(lower(p_type || ' ' || p_name), 'rose') THEN 'Red Room' END AS venue FROM part")
def alias_substring_first_match(spark, d):
    return table(spark, d, "part").select("p_partkey", overlay.first_alias(F.concat_ws(" ", "p_type", "p_name"), _ALIASES).alias("venue"))


# Resolution


@query("""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 4 = 0 THEN '' ELSE event_type END AS v, props FROM events)
SELECT user_id, arg_max(v, event_id) FILTER (v <> '') AS latest, arg_min(v, event_id) FILTER (v <> '') AS first, arg_max(props, {'n': length(props), 'o': event_id}) AS longest, count(*) AS n FROM e GROUP BY user_id""")
def survivorship_merge(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_id").alias("ord"), F.when(F.col("event_id") % 4 == 0, "").otherwise(F.col("event_type")).alias("v"), "props")
    out = {"user_id": F.max("user_id"), "latest": resolve.newest("v"), "first": resolve.oldest("v"), "longest": resolve.longest("props"), "n": F.count("*")}
    return resolve.merge_records(e, "user_id", out)


@query("SELECT user_id, string_agg(event_type, ',' ORDER BY o) AS types FROM (SELECT user_id, event_type, min(event_id) AS o FROM events GROUP BY 1, 2) GROUP BY user_id")
def merge_ordered_distinct(spark, d):
    e = table(spark, d, "events").select("user_id", F.col("event_id").alias("ord"), F.array("event_type").alias("types"))
    return records.first_places(e, "user_id", "types").select("user_id", F.array_join("types", ",").alias("types"))


@query("""WITH o AS (SELECT user_id, event_type, ts, event_id FROM events WHERE ts < TIMESTAMP '2024-01-15'), n AS (SELECT user_id, event_type, ts, event_id FROM events WHERE ts >= TIMESTAMP '2024-01-15'),
old AS (SELECT user_id, arg_max(event_type, event_id) AS v, 1 AS f, 1 AS l FROM o GROUP BY 1), new AS (SELECT user_id, arg_max(event_type, event_id) AS v, 2 AS f, 2 AS l FROM n GROUP BY 1)
SELECT coalesce(new.user_id, old.user_id) AS user_id, coalesce(new.v, old.v) AS event_type, CAST(coalesce(old.f, new.f) AS BIGINT) AS first_seen, CAST(coalesce(new.l, old.l) AS BIGINT) AS last_seen FROM old FULL JOIN new USING (user_id)""")
def upsert_first_last_seen(spark, d):
    e = table(spark, d, "events")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    one, two = F.lit(1).cast("long"), F.lit(2).cast("long")
    old = e.where(F.col("ts") < cut).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("event_type")).withColumns({"first_seen": one, "last_seen": one})
    new = e.where(F.col("ts") >= cut).select("user_id", "event_type", F.col("event_id").alias("ord"))
    return resolve.upsert(old, new, "user_id", ["event_type"], two)


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 10 = 3 THEN 'VIP' || CAST(c_custkey AS VARCHAR) ELSE c_mktsegment END AS segment FROM customer")
def override_overlay(spark, d):
    c = table(spark, d, "customer")
    none = F.lit(None).cast("date")
    events = c.select(F.col("c_custkey").alias("key"), F.col("c_name").alias("title"), none.alias("start"), none.alias("end"), F.col("c_mktsegment").alias("segment"))
    fixed = c.where("c_custkey % 10 = 3").select(F.upper("c_name").alias("title"), none.alias("start"), none.alias("end"), F.lit(1).alias("ord"), F.concat(F.lit("VIP"), F.col("c_custkey").cast("string")).alias("new_segment"))
    return overlay.override(events, fixed, ["segment"]).select("key", "segment")


@query("SELECT user_id, count(*) AS n, string_agg(event_type, ',' ORDER BY o) AS types FROM (SELECT user_id, event_type, min({'a': CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END, 'b': event_id}) AS o FROM events GROUP BY 1, 2) GROUP BY user_id")
def union_feeds_distinct(spark, d):
    """Three feeds, one after the other: the types of each user in the order in which the feeds and their rows have them."""
    e = table(spark, d, "events").select("user_id", F.array("event_type").alias("types"), F.col("event_id").alias("ord"), "event_type")
    feeds = resolve.union_ordered(e.where("event_type = 'view'"), e.where("event_type = 'click'"), e.where("event_type not in ('view', 'click')"))
    return records.first_places(feeds, "user_id", "types").select("user_id", F.size("types").cast("long").alias("n"), F.array_join("types", ",").alias("types"))


@query("SELECT o_orderkey, arg_max(l_linenumber, {'p': (CASE WHEN l_quantity > 25 THEN 100 ELSE 0 END) + (CASE WHEN l_discount > 0.05 THEN 25 ELSE 0 END), 'o': -l_linenumber}) AS best_line FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linenumber IS NOT NULL GROUP BY 1")
def best_session_argmax(spark, d):
    """Lines as an order's sessions, some of which tell coordinates or a venue: the one that tells most, of equals the first."""
    session = F.struct(F.col("l_linenumber").alias("n"), F.when(F.col("l_quantity") > 25, "121.5").alias("longitude"), F.when(F.col("l_quantity") > 25, "25").alias("lat"), F.when(F.col("l_discount") > 0.05, "hall").alias("venue"))
    shows = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(session)).alias("shows"))).alias("j"))
    shows = shows.join(table(spark, d, "orders").select("o_orderkey"), "o_orderkey")
    best = records.best_entry(records.session_entries(F.parse_json("j")))
    return shows.select("o_orderkey", F.try_variant_get(best, "$.n", "int").alias("best_line"))


@query("SELECT source, sha256(arg_max(text, {'n': length(text), 'o': doc_id})) AS digest, max(length(text)) AS n FROM documents GROUP BY source")
def longest_text_per_group(spark, d):
    best = table(spark, d, "documents").groupBy("source").agg(resolve.longest("text", "doc_id").alias("t"))
    return best.select("source", F.sha2("t", 256).alias("digest"), F.length("t").cast("long").alias("n"))


# Favourites and related events

#: The favourites are one user's list: here, the orders of a customer.
USER = "Customer#000000007"
FAV = f"fav AS (SELECT key FROM cat WHERE title = '{USER}')"


def _favourites(spark, d):
    return catalog(spark, d).where(F.col("title") == USER).select("key")


@query(f"WITH {CAT}, {FAV} SELECT key, title FROM cat WHERE key IN (SELECT key FROM fav)")
def favourites_semi(spark, d):
    return recommend.saved(catalog(spark, d), _favourites(spark, d)).select("key", "title")


@query(f"WITH {CAT}, {FAV} SELECT key FROM cat WHERE NOT EXISTS (SELECT 1 FROM fav WHERE fav.key = cat.key)")
def favourites_anti(spark, d):
    return recommend.unsaved(catalog(spark, d), _favourites(spark, d)).select("key")


@query(f"WITH {CAT}, {FAV}, mine AS (SELECT * FROM cat WHERE key IN (SELECT key FROM fav)), lab AS (SELECT category, count(*) AS n FROM mine GROUP BY 1), reg AS (SELECT DISTINCT region FROM mine), aff AS (SELECT key, title, coalesce(n, 0) * 100.0::DOUBLE + CASE WHEN reg.region IS NOT NULL THEN 24.0::DOUBLE ELSE 0 END + {SCORE} AS a FROM (SELECT * FROM cat WHERE key NOT IN (SELECT key FROM fav)) c LEFT JOIN lab USING (category) LEFT JOIN reg ON reg.region = c.region) SELECT key, round(a, 6) AS affinity FROM aff WHERE a >= 100 ORDER BY a DESC, title, key LIMIT 14")
def favourites_recommend(spark, d):
    return recommend.recommended(catalog(spark, d), _favourites(spark, d), TODAY).select("key", F.round("affinity", 6).alias("affinity"))


@query(f"WITH {CAT}, seeds AS (SELECT * FROM cat WHERE title = '{USER}') SELECT s.key AS seed, c.key FROM seeds s JOIN cat c ON s.key <> c.key AND (s.region = c.region OR s.category = c.category)")
def related_union_equi(spark, d):
    events = catalog(spark, d)
    return recommend.related(events, events.where(F.col("title") == USER))


@query(f"WITH {CAT} SELECT venue, key FROM cat QUALIFY row_number() OVER (PARTITION BY venue ORDER BY CASE WHEN {ONGOING} THEN 2 ELSE 0 END + CASE WHEN sd > DATE '1998-08-02' THEN 1 ELSE 0 END DESC, sd DESC, hits DESC, key) = 1")
def venue_best_pick(spark, d):
    return listing.best_per_group(catalog(spark, d), "venue", TODAY).select("venue", "key")


@query(f"WITH {CAT} SELECT venue, key, place FROM (SELECT venue, key, row_number() OVER (PARTITION BY venue ORDER BY CAST({ONGOING} AS INT) DESC, {SCORE} DESC, key) AS place FROM cat) WHERE place <= 5")
def venue_top5(spark, d):
    return listing.ranked_in_group(catalog(spark, d), "venue", TODAY, 5).select("venue", "key", "place")


@query(f"WITH {CAT} SELECT key FROM cat ORDER BY CASE WHEN key % 2 = 0 THEN 1 ELSE 0 END, md5('7:' || CAST(key AS VARCHAR)), key LIMIT 3")
def hero_sample_excluding_previous(spark, d):
    events = catalog(spark, d)
    return recommend.shuffled_pick(events, 3, 7, seen=events.where("key % 2 = 0"))


# Pages


@query(r"""SELECT page_id, regexp_replace(replace(replace(replace(replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS title FROM pages""")
def page_title(spark, d):
    return table(spark, d, "pages").select("page_id", extract.page_title("html").alias("title"))


@query(r"""SELECT page_id, len(h) AS n_links, array_to_string(h, ' ') AS hrefs FROM (SELECT page_id, regexp_extract_all(html, '(?is)<a[^>]+href=["'']([^"'']+)["''][^>]*>', 1) AS h FROM pages)""")
def page_links(spark, d):
    hrefs = F.regexp_extract_all("html", F.lit(extract.ANCHOR.replace("(.*?)</a>", "")), 1)
    return table(spark, d, "pages").select("page_id", F.size(hrefs).cast("long").alias("n_links"), F.array_join(hrefs, " ").alias("hrefs"))


#: A benchmark text and a document meet where the document holds the text's rarest run of three words (of equally rare ones the first), of those that any document holds.
_RUNS = """runs(id, words) AS (SELECT {id}, list_distinct(list_transform(range(1, greatest(1, len(w) - 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM (SELECT {id}, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS w FROM {table}))"""
_PAIRS = f"""WITH q AS (WITH {_RUNS.format(id='item_id', table='benchmark')} SELECT id AS item_id, unnest(words) AS run FROM runs), d AS (WITH {_RUNS.format(id='doc_id', table='documents')} SELECT id AS doc_id, unnest(words) AS run FROM runs),
held AS (SELECT run, count(*) AS n FROM d WHERE run IN (SELECT run FROM q) GROUP BY 1), rarest AS (SELECT item_id, arg_min(run, {{'n': n, 'r': run}}) AS run FROM q JOIN held USING (run) GROUP BY 1),
pairs AS (SELECT item_id, doc_id FROM rarest JOIN d USING (run))"""


def pairs(spark, d, **told):
    """item_id, title and doc_id of every benchmark text and each document that holds its rarest run of words. Documents' runs that no item has are left where they are found.

    told: columns by name, from the document's text (body). The runs that are met, the pairs, and what is told of documents are written: documents are cut into runs once, where the
    pairs are few their texts are fetched without a shuffle of all, and a text is read once, however many items it meets."""

    def runs(df, key):
        words = F.regexp_extract_all(F.lower("text"), F.lit(r"([^\x20\x09-\x0D]+)"))
        three = text.let(words, lambda w: F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(-1)), F.lit(1)), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))
        return df.where(F.size(words) >= 3).select(key, F.explode(three).alias("run"))

    items, docs = table(spark, d, "benchmark"), table(spark, d, "documents")
    asked = runs(items, "item_id")
    met = written(runs(docs, "doc_id").join(asked.select("run").distinct(), "run", "left_semi"))
    rarest = asked.join(met.groupBy("run").agg(F.count("*").alias("n")), "run").groupBy("item_id").agg(F.min(F.struct("n", "run")).alias("r")).select("item_id", "r.run")
    found = written(rarest.join(met, "run").select("item_id", "doc_id"))
    texts = docs.select("doc_id", F.col("text").alias("body")).join(found.select("doc_id").distinct(), "doc_id", "left_semi")
    read = written(spread(texts, "doc_id").select("doc_id", *[c.alias(n) for n, c in told.items()]))
    return spread(found.join(items.select("item_id", F.col("text").alias("title")), "item_id"), "item_id", "doc_id").join(read, "doc_id")


@query(_PAIRS + r""", p AS (SELECT item_id, doc_id, regexp_replace(lower(b.text), '[^0-9a-z\x{3400}-\x{9fff}]+', '', 'g') AS e, regexp_replace(lower(split_part(t.text, chr(10), 1)), '[^0-9a-z\x{3400}-\x{9fff}]+', '', 'g') AS c FROM pairs JOIN benchmark b USING (item_id) JOIN documents t USING (doc_id)),
g AS (SELECT item_id, doc_id, list_distinct(list_transform(range(1, length(e)), lambda i: substr(e, i, 2))) AS a, list_distinct(list_transform(range(1, length(c)), lambda i: substr(c, i, 2))) AS b FROM p)
SELECT item_id, doc_id, round(len(list_intersect(a, b)) / len(a)::DOUBLE, 6) AS recall FROM g""")
def title_match_bigram(spark, d):
    p = pairs(spark, d, c=text.compact_title(F.split_part("body", F.lit("\n"), F.lit(1)))).select("item_id", "doc_id", text.compact_title("title").alias("e"), "c")
    return p.select("item_id", "doc_id", F.round(F.size(F.array_intersect(text.bigrams("e"), text.bigrams("c"))) / F.size(text.bigrams("e")), 6).alias("recall"))


@query(_PAIRS + r""", p AS (SELECT item_id, doc_id, list_filter(list_transform(string_split_regex(b.text, '[\s：:、,，/|()（）【】《》\-—]+'), lambda t: regexp_replace(lower(t), '[^0-9a-z\x{3400}-\x{9fff}]+', '', 'g')), lambda t: length(t) >= 2) AS tokens, regexp_replace(lower(t.text), '[^0-9a-z\x{3400}-\x{9fff}]+', '', 'g') AS plain FROM pairs JOIN benchmark b USING (item_id) JOIN documents t USING (doc_id))
SELECT item_id, doc_id, len(tokens) AS tokens, round(len(list_filter(tokens, lambda t: contains(plain, t))) / len(tokens)::DOUBLE, 6) AS coverage FROM p""")
def title_token_coverage(spark, d):
    p = pairs(spark, d, plain=text.compact_title("body")).select("item_id", "doc_id", text.title_tokens("title").alias("t"), text.token_coverage("title", F.col("plain")).alias("c"))
    return p.select("item_id", "doc_id", F.size("t").cast("long").alias("tokens"), F.round("c", 6).alias("coverage"))


@query(None)
def title_match_ratio(spark, d):
    p = pairs(spark, d, first=F.split_part("body", F.lit("\n"), F.lit(1)), plain=text.compact_title("body"))
    return p.select("item_id", "doc_id", text.title_score("title", "first", plain="plain").alias("score"))


@query("SELECT conv_id, count(*) AS n, string_agg(role, ',' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id")
def nested_flatten(spark, d):
    """The roles of a conversation's turns, from JSON that nests each in an object and a list."""
    turn = F.struct("turn", F.array(F.struct(F.struct("role").alias("by"))).alias("t"))
    conv = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    roles = records.flat_texts(F.to_json(F.transform("turns", lambda t: t["t"])))
    return conv.select("conv_id", F.size("turns").cast("long").alias("n"), F.array_join(roles, ",").alias("roles"))


# Page compositions and whole records


@query(f"""WITH {CAT}, seeds AS (SELECT * FROM cat WHERE title = '{USER}'),
pairs AS (SELECT s.key AS seed, c.key, {SCORE.replace("key AS VARCHAR", "c.key AS VARCHAR").replace("image", "c.image").replace("hits", "c.hits").replace("sd <=", "c.sd <=").replace("ed >=", "c.ed >=").replace("AND ed -", "AND c.ed -")} AS score FROM seeds s JOIN cat c ON s.key <> c.key AND (s.region = c.region OR s.category = c.category))
SELECT seed, key, place FROM (SELECT seed, key, row_number() OVER (PARTITION BY seed ORDER BY score DESC, key) AS place FROM pairs) WHERE place <= 6""")
def related_top6(spark, d):
    events = catalog(spark, d)
    return pages.related_top(events, events.where(F.col("title") == USER), TODAY)


@query(f"WITH {CAT} (SELECT 'upcoming' AS list, key FROM cat WHERE sd > DATE '1998-08-02' ORDER BY sd, key LIMIT 4) UNION ALL (SELECT 'ending', key FROM cat WHERE {ONGOING} AND ed - DATE '1998-08-02' BETWEEN 0 AND 30 ORDER BY ed, key LIMIT 4)")
def home_lists(spark, d):
    parts = pages.home(catalog(spark, d), TODAY)
    return parts["upcoming"].select(F.lit("upcoming").alias("list"), "key").unionByName(parts["ending"].select(F.lit("ending").alias("list"), "key"))


@query("""WITH raw AS (SELECT o_orderkey, c_name, o_orderdate, o_totalprice, o_orderpriority, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
SELECT CAST(o_orderkey AS VARCHAR) AS id, c_name AS title, strftime(o_orderdate, '%Y-%m-%d') AS start_date, n_name AS venue, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE '免費' END AS price, CAST(floor(o_totalprice) AS BIGINT) AS hits,
  25 + (o_orderkey % 100) / 100.0::DOUBLE AS lat, CASE WHEN o_orderkey % 3 = 0 THEN 'https://p.example.org/a/' || o_orderkey ELSE '' END AS source_url FROM raw""")
def record_typing(spark, d):
    orders, customer, nation = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("o_orderkey")
    show = F.struct(F.date_format("o_orderdate", "yyyy/MM/dd").alias("time"), F.col("n_name").alias("locationName"), (25 + (k % 100) / 100.0).cast("string").alias("longitude"), F.lit("121.5").alias("latitude"), F.when(k % 2 == 1, "N").alias("onSales"), F.when(k % 2 == 0, F.col("o_orderpriority")).alias("price"))
    raw = F.to_json(F.struct(k.cast("string").alias("UID"), F.col("c_name").alias("titile"), F.floor("o_totalprice").cast("string").alias("hitRate"), F.array(show).alias("showInfo"), F.when(k % 3 == 0, F.concat(F.lit("https:\\/\\/p.example.org/a/"), k.cast("string"))).alias("website")))
    return records.typed(rows.select(F.parse_json(raw).alias("raw"), k.alias("ord"))).select("id", "title", "start_date", "venue", "price", "hits", "lat", "source_url")


@query("WITH p AS (SELECT vec_id AS id, 25 + CAST(embedding[1] AS DOUBLE) AS lat, 121 + CAST(embedding[2] AS DOUBLE) AS lon FROM embeddings) SELECT id, lat BETWEEN 20 AND 27 AND lon BETWEEN 117.5 AND 124 AND " + KM.format(lat="23.0::DOUBLE", lon="120.22::DOUBLE") + " <= 73 AS kept FROM p")
def checked_places(spark, d):
    p = places(spark, d).select(F.col("key").alias("id"), "lat", "lon", F.lit("台南市").alias("region"), F.lit("feed").alias("place_source"))
    return enrich.checked_places(p).select("id", F.col("lat").isNotNull().alias("kept"))
