"""Registered queries over whole records, pages, trees and places: what catalogue.py's tables are joined, walked and merged into."""

from __future__ import annotations

from pyspark.sql import functions as F

from showbill.functions import geo
from showbill.operators import enrich, extract, facets, geocode, overlay, records, trees
from showbill.sources.shared import written
from showbill.plans.catalogue import CAT, KM, PLACES, catalog, places, query, table

_NAMED = "WITH named AS (SELECT c_custkey AS k, n_name AS nation, r_name AS region, c_mktsegment AS segment FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def named(spark, d):
    """k, nation, region and segment of each customer."""
    customer, nation, region = (table(spark, d, t) for t in ("customer", "nation", "region"))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("c_custkey").alias("k"), F.col("n_name").alias("nation"), F.col("r_name").alias("region"), F.col("c_mktsegment").alias("segment"))


def written_pages(spark, d):
    """A page per customer, whose places are told in one of five ways: by an event, a museum, a graph in a second block, a nested event, or plain text."""
    k = F.col("k")
    text = F.to_json
    s = lambda **members: F.struct(*[(v if not isinstance(v, str) else F.lit(v)).alias(n) for n, v in members.items()])
    kind = lambda of, **members: F.struct(F.lit(of).alias("@type"), *[(F.lit(v) if isinstance(v, str) else v).alias(n) for n, v in members.items()])
    address = s(streetAddress=F.col("segment"), addressLocality=F.col("nation"), addressRegion=F.col("region"), postalCode=k.cast("string"))
    point = s(latitude=23 + (k % 100) / 100.0, longitude=F.lit("120.5"))
    picture = lambda n: F.concat(F.lit(f"https://img.example.org/{n}/"), k.cast("string"), F.lit(".jpg"))
    event = text(kind("Event", name=F.concat(F.lit("Show "), k.cast("string")), location=kind("Place", name=F.col("nation"), address=address, geo=point), image=F.array(picture("a"), picture("b"))))
    museum = F.concat(F.lit('[{"@type":"WebSite","name":"Site"},'), text(kind("Museum", name=F.concat(F.col("nation"), F.lit(" Museum")), address=F.col("region"), geo=point, image=s(url=picture("m"), width="9"))), F.lit("]"))
    graph = text(s(**{"@graph": F.array(kind("Organization", name="Org", member=kind("Place", alternateName=F.col("nation"), address=address)))}))
    nested = text(kind("Event", name="Outer", location=kind("Place", address="1 Road"), subEvent=F.array(kind("Event", location=kind("Place", name=F.col("region"), address="2 Road")), kind("Event", location=kind("Place", name="Third", address="")))))
    block = lambda j: F.concat(F.lit('<script type="application/ld+json">'), j, F.lit("</script>"))
    plain = F.concat(F.lit("<p>地點：<b>"), F.col("nation"), F.lit(" Hall</b></p>\n<p>台北市中山路"), (k % 90 + 1).cast("string"), F.lit('號</p><a href="https://maps.example.org/?q=25.04%2C121.51">map</a>'))
    body = F.when(k % 5 == 0, block(event)).when(k % 5 == 1, block(museum)).when(k % 5 == 2, F.concat(block(F.lit("{broken")), block(graph))).when(k % 5 == 3, block(nested)).otherwise(plain)
    head = F.concat(F.lit('<meta property="og:title" content="Night Show '), k.cast("string"), F.lit('">'))
    return named(spark, d).select(k.alias("page_id"), F.concat(F.lit("https://p.example.org/e/"), k.cast("string")).alias("url"), F.concat(F.lit("<html>"), head, body, F.lit("</html>")).alias("html"))


_PLACE_TOLD = """CASE k % 5 WHEN 0 THEN nation WHEN 1 THEN nation || ' Museum' WHEN 2 THEN nation WHEN 3 THEN region ELSE nation || ' Hall' END AS venue,
  CASE WHEN k % 5 IN (0, 2) THEN k || region || nation || segment WHEN k % 5 = 1 THEN region WHEN k % 5 = 3 THEN '1 Road' ELSE '台北市中山路' || (k % 90 + 1) || '號' END AS address,
  CASE WHEN k % 5 < 2 THEN 23 + (k % 100) / 100.0::DOUBLE WHEN k % 5 = 4 THEN 25.04::DOUBLE END AS lat"""


@query(f"{_NAMED} SELECT k AS page_id, {_PLACE_TOLD}, CASE k % 5 WHEN 0 THEN 'https://img.example.org/a/' || k || '.jpg https://img.example.org/b/' || k || '.jpg' WHEN 1 THEN 'https://img.example.org/m/' || k || '.jpg' ELSE '' END AS images FROM named")
def jsonld_places(spark, d):
    return enrich.page_metadata(written_pages(spark, d)).select("page_id", F.col("page_venue").alias("venue"), F.col("page_address").alias("address"), F.round("page_lat", 7).alias("lat"), F.array_join("page_images", " ").alias("images"))


@query("SELECT l_orderkey AS id, 2 * count(*) + 1 AS objects, 3 AS deepest, CAST(sum(l_linenumber) AS BIGINT) AS numbers FROM lineitem GROUP BY 1")
def json_tree_walk(spark, d):
    """Every object of each order's JSON: the order, its lines, and a part within each."""
    line = F.struct(F.col("l_linenumber").alias("n"), F.struct(F.col("l_partkey").alias("key"), F.lit("{}").alias("note")).alias("part"))
    orders = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.struct(F.array_sort(F.collect_list(line)).alias("lines"))).alias("json"))
    nodes = trees.objects(orders, "json", ["l_orderkey"])
    n = F.coalesce(F.get_json_object("json", "$.n").cast("long"), F.lit(0))
    return nodes.groupBy(F.col("l_orderkey").alias("id")).agg(F.count("*").alias("objects"), F.max(F.size("path")).cast("int").alias("deepest"), F.sum(n).alias("numbers"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'u' || event_id || ' ' || event_type || ' n' WHEN 1 THEN event_type WHEN 2 THEN 's' || event_id || ' a&b' ELSE '[' || event_type END AS texts FROM events""")
def flat_values(spark, d):
    """The texts in members that hold a text, nested JSON, or JSON within JSON."""
    k, t = F.col("event_id").cast("string"), F.col("event_type")
    nested = F.concat(F.lit('[{"width":"9","url":"u'), k, F.lit('"},["'), t, F.lit('",{"note":"n","none":null}]]'))
    within = F.to_json(F.array(F.concat(F.lit('{"src":"s'), k, F.lit('"}')), F.lit("a&b"), F.lit(" ")))
    member = F.when(F.col("event_id") % 4 == 0, nested).when(F.col("event_id") % 4 == 1, t).when(F.col("event_id") % 4 == 2, within).otherwise(F.concat(F.lit("["), t))
    return table(spark, d, "events").select("event_id", F.array_join(records.flat_texts(member), " ").alias("texts"))


_ROOT = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"


@query(f"""WITH a AS (SELECT page_id, unnest([{{'at': 0, 't': {_ROOT} || '/c/' || page_id, 's': 65}}, {{'at': 1, 't': {_ROOT} || '/event/' || page_id, 's': 45}}, {{'at': 2, 't': 'https://kktix.com/e/' || page_id, 's': 155}}, {{'at': 3, 't': 'https://www.instagram.com/events/' || page_id, 's': 105}},
  {{'at': 4, 't': 'https://x.gov.tw/' || page_id, 's': 110}}, {{'at': 5, 't': CASE WHEN page_id % 3 = 0 THEN 'https://www.opentix.life/event/' || page_id END, 's': 190}}] || list_transform(range(1, page_id % 6 + 1), lambda j: {{'at': CAST(5 + j AS INT), 't': {_ROOT} || '/detail/' || j, 's': 45}})) AS x FROM pages)
SELECT page_id, x.t AS target, x.s AS score, CAST(row_number() OVER (PARTITION BY page_id ORDER BY x.s DESC, x.at) AS INT) AS place FROM a WHERE x.t IS NOT NULL QUALIFY place <= 8""")
def related_links_scored_topk(spark, d):
    """Each page's best links, after links of all kinds were added to it: canonical, ticket, social and public ones, some that are blocked, twice there, or say nothing."""
    i = F.col("page_id").cast("string")
    anchors = [
        '<link rel="canonical" href="/c/', i, '"><a href="/event/', i, '">go</a><a href="https://kktix.com/e/', i, '">go</a><a href="https://kktix.com/e/', i, '"> ticket</a><a class="x" href="https://www.instagram.com/events/', i, '#top">x</a>',
        '<a href="/login?ticket">ticket</a><a href="https://www.facebook.com/event/1">event</a><a href="https://x.gov.tw/', i, '">官<b>方</b></a><a href="/about">about</a>',
    ]
    more = F.concat_ws("", F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), (F.col("page_id") % 6).cast("int"))), lambda j: F.concat(F.lit('<a href="/detail/'), j.cast("string"), F.lit('">info</a>'))))
    last = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<a href="https://www.opentix.life/program/'), i, F.lit('">售票</a>'))).otherwise("")
    added = F.concat(*[F.lit(a) if isinstance(a, str) else a for a in anchors], last, F.when(F.col("page_id") % 6 > 0, more).otherwise(""))
    pages = table(spark, d, "pages").withColumn("html", F.concat("html", added))
    return extract.related_pages(pages).withColumn("target", F.regexp_replace("target", "#top$", ""))


# Places


@query(f"WITH {PLACES}, q AS (SELECT key AS point_key, lat AS plat, lon AS plon FROM places WHERE key % 20 = 0) SELECT point_key, key, round(km, 6) AS km FROM (SELECT point_key, key, {KM.format(lat='plat', lon='plon')} AS km FROM q, places) WHERE km <= 12")
def radius_join(spark, d):
    """Every place within 12 km of each query point; the queries are the rows whose number 20 divides."""
    p = places(spark, d)
    found = geo.within_km(p.where("key % 20 = 0").select(F.col("key").alias("point_key"), "lat", "lon"), p.select("key", "lat", "lon"), 12.0)
    return found.select("point_key", "key", F.round("distance_km", 6).alias("km"))


@query(f"WITH {PLACES}, q AS (SELECT key AS point_key, lat AS plat, lon AS plon FROM places WHERE key % 20 = 0), m AS (SELECT point_key, key, {KM.format(lat='plat', lon='plon')} AS km FROM q, places) SELECT point_key, key, round(km, 6) AS km, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY point_key ORDER BY km, key) AS INT) AS place FROM m) WHERE place <= 7")
def nearest_join(spark, d):
    p = places(spark, d)
    found = geo.nearest_places(p.where("key % 20 = 0").select(F.col("key").alias("point_key"), "lat", "lon"), p.select("key", "lat", "lon"), 7)
    return found.select("point_key", "key", F.round("distance_km", 6).alias("km"), "place")


#: Events to locate: an address per 13 customers; cached where 4 divides its number (null where 8 does), answered by the geocoder otherwise, without a find at 5 and failing at 7.
_GEO = """WITH w AS (SELECT o_orderkey AS id, o_custkey % 400 AS a, CAST(floor(o_totalprice / 1000) AS BIGINT) AS hits FROM orders),
r AS (SELECT *, row_number() OVER (ORDER BY hits DESC, id) AS o, row_number() OVER (PARTITION BY a ORDER BY hits DESC, id) AS nth FROM w),
c AS (SELECT *, CAST(a % 4 <> 0 AND (a % 7 = 0 OR nth = 1) AS INT) AS cost FROM r),
e AS (SELECT min(o) AS o FROM (SELECT o, sum(cost) OVER (ORDER BY o) AS s FROM c) WHERE s > {most}),
b AS (SELECT c.* FROM c, e WHERE e.o IS NULL OR c.o < e.o)"""
_AT = "CAST(23 + a / 100.0::DOUBLE AS DOUBLE)"


def _geocoded(spark, d, most):
    a = F.col("o_custkey") % 400
    wanted = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), a.cast("string").alias("asked"), F.lit("").alias("region"), F.floor(F.col("o_totalprice") / 1000).alias("hits"), F.col("o_orderkey").alias("ord"))
    texts = table(spark, d, "customer").select((F.col("c_custkey") % 400).alias("a")).distinct().select("a", F.col("a").cast("string").alias("asked"), (23 + F.col("a") / 100.0).alias("at"))
    cache = texts.where("a % 4 = 0").select("asked", F.when(F.col("a") % 8 != 0, F.col("at")).alias("lat"), F.when(F.col("a") % 8 != 0, F.lit(121.0)).alias("lon"))
    answers = texts.where("a % 4 <> 0").select("asked", F.when(F.col("a") % 5 != 0, F.col("at")).alias("lat"), F.when(F.col("a") % 5 != 0, F.lit(121.0)).alias("lon"), (F.col("a") % 7 == 0).alias("failed"))
    return geocode.geocoded(wanted, cache, answers, most)


@query(_GEO.format(most=60) + f" SELECT CAST(id AS VARCHAR) AS id, round({_AT}, 6) AS lat, CASE WHEN a % 4 <> 0 AND nth = 1 THEN 'nominatim' ELSE 'geocode_cache' END AS place_source FROM b WHERE {_AT} <= 27 AND CASE WHEN a % 4 = 0 THEN a % 8 <> 0 ELSE a % 5 <> 0 AND a % 7 <> 0 END")
def geocode_budget_cut(spark, d):
    """What an update with 60 requests fills, over all orders by their hits."""
    return _geocoded(spark, d, 60)[0].select("id", F.round("lat", 6).alias("lat"), "place_source")


@query(_GEO.format(most=60) + f" SELECT CAST(a AS VARCHAR) AS asked, CASE WHEN a % 5 <> 0 AND {_AT} <= 27 THEN round({_AT}, 6) END AS lat FROM b WHERE a % 4 <> 0 AND a % 7 <> 0 AND nth = 1 UNION ALL SELECT CAST(a AS VARCHAR), CASE WHEN a % 8 <> 0 THEN round({_AT}, 6) END FROM (SELECT DISTINCT c_custkey % 400 AS a FROM customer) WHERE a % 4 = 0")
def geocode_cache_written(spark, d):
    return _geocoded(spark, d, 60)[1].select("asked", F.round("lat", 6).alias("lat"))


@query("""WITH n AS (SELECT DISTINCT p_name || ' ' || p_type || ' ' || p_brand AS name FROM part),
p AS (SELECT n_nationkey AS profile, x AS pattern FROM (SELECT n_nationkey, unnest(['Brand#' || n_nationkey, 'BRAND#' || (n_nationkey + 1) || 'x', CASE WHEN n_nationkey % 5 = 0 THEN 'Blue ' WHEN n_nationkey % 5 = 1 THEN 'Large' ELSE 'ring small brand#' || n_nationkey END]) AS x FROM nation))
SELECT name, arg_min(profile, {'a': profile, 'b': -length(pattern)}) AS profile, arg_min(pattern, {'a': profile, 'b': -length(pattern)}) AS pattern FROM n, p WHERE contains(lower(name), lower(pattern)) GROUP BY name""")
def alias_pattern_table(spark, d):
    """The first profile of a table of patterns that each part's name holds, by an index of grams."""
    names = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("name"))
    k = F.col("n_nationkey")
    text = F.when(k % 5 == 0, "Blue ").when(k % 5 == 1, "Large").otherwise(F.concat(F.lit("ring small brand#"), k.cast("string")))
    every = F.array(F.concat(F.lit("Brand#"), k.cast("string")), F.concat(F.lit("BRAND#"), (k + 1).cast("string"), F.lit("x")), text)
    patterns = table(spark, d, "nation").select(k.alias("profile"), F.posexplode(every).alias("place", "pattern"))
    return overlay.pattern_matches(names, patterns)


#: An enumeration for the test regions, as the library's own has regions of one country.
_REGIONS = ["MIDDLE EAST", "ASIA", "NOWHERE", "EUROPE", "AMERICA"]
_REGION_AT = "list_position([" + ", ".join(f"'{r}'" for r in _REGIONS) + "], region) - 1"


@query(f"WITH {CAT}, v AS (SELECT region, venue, count(*) AS n FROM cat GROUP BY GROUPING SETS ((region), (region, venue))) SELECT region, venue, n, CAST({_REGION_AT} AS INT) AS region_place, CAST(row_number() OVER (PARTITION BY region ORDER BY CASE WHEN venue IS NULL THEN 0 ELSE 1 END, n DESC, venue) - 1 AS INT) AS venue_place FROM v WHERE region IN ({', '.join(f'{chr(39)}{r}{chr(39)}' for r in _REGIONS)})")
def region_facets_ordered(spark, d):
    got = facets.region_facets(catalog(spark, d), _REGIONS)
    return got.select("region", "venue", "n", F.col("region_place").cast("int").alias("region_place"), F.col("venue_place").cast("int").alias("venue_place"))


_STRIP = ["MACHINERY", "BUILDING", "AUTOMOBILE"]


@query(f"WITH {CAT}, c AS (SELECT category, count(*) AS n, coalesce(list_position(['MACHINERY', 'BUILDING', 'AUTOMOBILE'], category), 100) AS r FROM cat GROUP BY 1 ORDER BY r, category LIMIT 4) SELECT CAST(row_number() OVER (ORDER BY r, category) AS INT) AS place, category, n FROM c")
def category_strip_order(spark, d):
    return facets.category_strip(catalog(spark, d), _STRIP, 4)


# Whole records


def raw_shows(spark, d, *, source: str, of: str = "true", last: int = 0):
    """A raw record per customer that a source knows (`of`, a condition on k), from one of three sources, as JSON and typed."""
    k = F.col("k")
    text = k.cast("string")
    members = {
        "old": [F.lit("2026-03-01").alias("startDate"), F.concat(F.lit("old text of show "), text).alias("description"), F.lit("2026-01-01").alias("firstSeenAt"), F.col("nation").alias("locationName"), F.lit("100").alias("price")],
        "old_again": [F.lit("2026-03-01").alias("startDate"), F.lit("x").alias("description"), F.lit("2026-01-02").alias("firstSeenAt"), F.lit("").alias("locationName"), F.lit("").alias("price")],
        "new": [F.lit("2026/03/01").alias("startDate"), F.concat(F.lit("a longer and newer text of show "), text).alias("comment"), F.array(F.struct(F.col("region").alias("locationName"), F.lit("200").alias("price"))).alias("showInfo")],
    }[source]
    raw = F.to_json(F.struct(text.alias("UID"), F.concat(F.lit("Night Show "), text).alias("title"), F.lit("2026-04-01").alias("endDate"), *members))
    # Typing is a large plan, so what is typed is written before it is joined.
    return written(records.typed(named(spark, d).where(of).select(F.parse_json(raw).alias("raw"), (k + last).alias("ord"))))


@query(f"""{_NAMED} SELECT CAST(k AS VARCHAR) AS id, CASE WHEN k % 3 = 0 THEN 'a longer and newer text of show ' || k WHEN k % 6 = 2 THEN 'x' ELSE 'old text of show ' || k END AS description,
CASE WHEN k % 3 = 0 THEN region WHEN k % 6 = 2 THEN '地點待確認' ELSE nation END AS venue, CASE WHEN k % 3 = 0 THEN '200' WHEN k % 6 = 2 THEN '票價請見活動頁面' ELSE '100' END AS price,
CASE WHEN k % 6 IN (2) THEN '2026-01-02' WHEN k % 2 = 0 THEN '2026-01-01' ELSE '2026-03-10' END AS first_seen, CASE WHEN k % 3 = 0 THEN '2026-03-10' WHEN k % 6 = 2 THEN '2026-01-02' ELSE '2026-01-01' END AS last_seen FROM named WHERE k % 2 = 0 OR k % 3 = 0""")
def catalogue_update(spark, d):
    """An update end to end: typed records, existing ones of which the last of an id holds, incoming ones merged over them, then by title and dates."""
    old = raw_shows(spark, d, source="old", of="k % 2 = 0").unionByName(raw_shows(spark, d, source="old_again", of="k % 6 = 2", last=1 << 30))
    new = raw_shows(spark, d, source="new", of="k % 3 = 0")
    out = records.catalogue(new, old, F.lit("2026-03-10").cast("date"), F.lit("2026-03-10"))
    return out.select("id", "description", "venue", "price", "first_seen", "last_seen")


@query(f"{_NAMED} SELECT CAST(k AS VARCHAR) AS id, CASE WHEN k % 7 = 0 THEN region ELSE nation END AS venue, CASE WHEN k % 7 = 0 THEN '200' ELSE '100' END AS price, CASE WHEN k % 7 = 0 THEN 'a longer and newer text of show ' || k ELSE 'old text of show ' || k END AS description FROM named")
def details_merged(spark, d):
    """Records with the details of those that have some, merged over them."""
    events = raw_shows(spark, d, source="old")
    details = raw_shows(spark, d, source="new", of="k % 7 = 0")
    return enrich.with_details(events, details, 1 << 30).select("id", "venue", "price", "description")


@query(f"{_NAMED}, told AS (SELECT k, nation, region, segment, {_PLACE_TOLD} FROM named WHERE k % 2 = 0) SELECT CAST(n.k AS VARCHAR) AS id, t.k IS NOT NULL AS verified, CASE WHEN n.k % 4 = 0 THEN t.venue ELSE n.nation END AS venue, coalesce(t.address, '') AS address, CASE WHEN t.lat BETWEEN 20 AND 27 AND (t.address <> '') THEN 'source_page' ELSE '' END AS place_source FROM named n LEFT JOIN told t USING (k) WHERE n.k % 4 <> 1")
def pages_enriched(spark, d):
    """Records with what their pages say: a missing address and place, a poor venue's name; half of the pages are there."""
    events = raw_shows(spark, d, source="old", of="k % 4 <> 1")
    k = F.col("id").cast("long")
    events = events.withColumns({"source_url": F.concat(F.lit("https://p.example.org/e/"), "id"), "venue": F.when(k % 4 == 0, records.UNKNOWN_VENUE).otherwise(F.col("venue"))})
    out = enrich.with_pages(events, written_pages(spark, d).where("page_id % 2 = 0"), F.lit("2026-03-10").cast("date"), F.lit("2026-03-10"), most=1 << 30)
    return out.select("id", "verified", "venue", "address", "place_source")
