"""Links, pages, enrichment and compositions."""

import datetime
import json

from pyspark.sql import functions as F

from showbill.functions import text, urls
from showbill.operators import enrich, extract, listing, pages
from showbill.operators import records as R
from showbill.operators.listing import ListingQuery

DAY = datetime.date(2026, 3, 10)


def events(spark, n=40):
    rows = [(f"k{i}", f"t{i}", ["a", "b", "c"][i % 3 : i % 3 + 1], f"v{i % 5}", f"r{i % 4}", DAY + datetime.timedelta(i - 20), DAY + datetime.timedelta(i - 10), i * 100, "" if i % 4 else "https://i.example.org/x.jpg") for i in range(n)]
    return spark.createDataFrame(rows, "key string, title string, categories array<string>, venue string, region string, start date, end date, hits bigint, image string").withColumns({"category": F.col("categories")[0], "price": F.lit("free"), "description": F.lit(""), "first_seen": F.col("start")})


def test_text_keys_and_compositions(spark):
    e = events(spark)
    assert [r["key"] for r in listing.featured(e, DAY, 3).collect()] == ["k20", "k16", "k12"]
    assert {r["venue"]: r["key"] for r in listing.best_per_group(e, "venue", DAY).collect()} == {f"v{i}": f"k{k}" for i, k in zip(range(5), (20, 16, 17, 18, 19))}
    home = pages.home(e, DAY)
    assert [r["key"] for r in home["upcoming"].collect()] == ["k21", "k22", "k23", "k24"] and [r["key"] for r in home["ending"].collect()] == ["k10", "k11", "k12", "k13"]
    assert tuple(home["counts"].first()) == (40, 5) and home["featured"].count() == 9
    assert listing.featured(pages._if_any(e.where("false"), e), DAY, 50).count() == 40
    found, link = pages.home_results(e, ListingQuery(DAY, status="upcoming", categories=frozenset({"a"})))
    assert found.count() == 7 and link == "?view=all&category=a&status=upcoming" and pages.home_results(e, ListingQuery(DAY))[0].count() == 0
    seed = e.where("key = 'k7'")
    got = [r["key"] for r in pages.detail(e, "k7", DAY)["related"].orderBy("place").collect()]
    score = {r["key"]: r["s"] for r in e.select("key", listing.score(F.lit(DAY)).alias("s")).collect()}
    want = sorted((f"k{i}" for i in range(40) if i != 7 and (i % 4 == 3 or i % 3 == 1)), key=lambda k: (-score[k], k))[:6]
    assert got == want and pages.related_top(e, seed, DAY, 50).count() == len([i for i in range(40) if i != 7 and (i % 4 == 3 or i % 3 == 1)])
    assert pages.hero_tickets(e, DAY, 5).count() == 3
    q = ListingQuery(DAY, text="r1")
    assert pages.redirected(q, frozenset(), frozenset({"r1"}), frozenset()).region == "r1" and pages.redirected(q, frozenset(), frozenset(), frozenset()) == q
    assert e.where("key = 'k1'").select(pages.facet_link("venue", F.lit("甲 館")).alias("u"), pages.map_link(F.lit(None), F.lit(None), F.lit("館"), F.lit("路1號 館")).alias("m")).first()["u"] == "?view=all&venue=%E7%94%B2%20%E9%A4%A8"


def test_listing_page_and_venue_grid(spark):
    e = events(spark).withColumn("images", F.when(F.col("hits") % 300 == 0, F.array(F.concat(F.lit("https://i.example.org/"), "key", F.lit(".jpg")), F.lit("https://i.example.org/all.jpg"))).otherwise(F.array().cast("array<string>")))
    q = ListingQuery(DAY, region="r1", date=DAY)
    page = pages.listing_page(e, q, DAY, ["c", "a"], ["r2", "r1", "none"])
    rows = {r["key"]: r for r in e.collect()}
    on = lambda r, d: r["start"] <= d <= r["end"]
    r1 = [r for r in rows.values() if r["region"] == "r1"]
    assert page["found"].first()["n"] == page["results"].count() == sum(on(r, DAY) for r in r1)
    days = {r["day"]: r for r in page["calendar"].collect()}
    assert len(days) == 31 and all(days[d]["n"] == sum(on(r, d) for r in r1) for d in days)
    assert [d.day for d in days if days[d]["selected"]] == [10] and [d.day for d in days if days[d]["today"]] == [10] and days[datetime.date(2026, 3, 1)]["cell"] == 0  # a Sunday
    assert [r["category"] for r in page["categories"].orderBy("place").collect()] == ["c", "a"]
    assert [(r["region"], r["venue"]) for r in page["regions"].orderBy("region_place", "venue_place").collect()][0] == ("r2", None)
    pictures = spark.createDataFrame([("v1", "https://i.example.org/v1.jpg"), ("v2", "https://i.example.org/spinner.gif")], "venue string, image string")
    score = {r["key"]: r["s"] for r in e.select("key", listing.score(F.lit(DAY)).alias("s")).collect()}
    grid = {r["venue"]: r for r in pages.venue_grid(e, pictures, DAY, 4, 3).collect()}
    assert sorted(grid) == ["v0", "v1", "v2", "v3"] and all(r["n"] == 8 for r in grid.values())
    for v, r in grid.items():
        ranked = sorted((x for x in rows.values() if x["venue"] == v), key=lambda x: (not on(x, DAY), -score[x["key"]], x["key"]))
        want = ["https://i.example.org/v1.jpg"] * (v == "v1") + [u for x in ranked for u in (x["images"] or [x["image"]]) if u]
        assert r["images"] == list(dict.fromkeys(want))[:3] and r["category"] == ranked[0]["categories"][0]


HTML = """<title>X</title><link rel="canonical" href="/ev/1"><a href="/login?x">ticket</a><a href="https://kktix.com/e/2">go</a><a href='https://kktix.com/e/2'>ticket</a>
<a href="detail/3">info</a><a href="about">about</a><a href="https://www.instagram.com/events/9">ig</a><a href="https://www.facebook.com/x">event</a><a href="https://x.gov.tw/a">官方</a>"""


def test_related_links(spark):
    p = spark.createDataFrame([(1, "https://h.example.org/a/b.html", HTML), (2, "https://h.example.org/", ""), (3, None, None)], "page_id bigint, url string, html string")
    got = [(r["target"], r["score"]) for r in extract.related_pages(p).orderBy("page_id", "place").collect()]
    assert got == [("https://kktix.com/e/2", 155), ("https://x.gov.tw/a", 110), ("https://www.instagram.com/events/9", 105), ("https://h.example.org/ev/1", 65), ("https://h.example.org/a/detail/3", 45)]


def test_urls_and_entities(spark):
    import html
    from urllib.parse import urljoin

    texts = ["a &amp; b &lt;x&gt; &eacute; &#233; &#x4e2d; &hellip; &amp;lt; &bogus; &copy 2024", "plain", "&nbsp;x&#0;&#128512;", "&AMP;quot", "&amp;amp;lt;", "&euro 1"]
    for t, r in zip(texts, spark.createDataFrame([(t,) for t in texts], "t string").select(text.unescape_all("t")).collect(), strict=True):
        assert r[0] == html.unescape(t)
    refs = ["http://a.b/c", "//h/x", "/root/p?q", "rel/x.html", "?q=1", "#f", "../up", "../../../x", "./same", "mailto:x@y", "a/../b"]
    for r in spark.createDataFrame([("https://h.example/d1/d2/page.html?x=1#z", r) for r in refs], "b string, r string").select("b", "r", urls.joined("b", "r").alias("j")).collect():
        assert r["j"] == urljoin(r["b"], r["r"])
    bad = ["https://a.b/x.svg", "https://a.b/default.png", "https://a.b/img-32x32.png", "https://a.b/logo.png"]
    df = spark.createDataFrame([(u,) for u in [*bad, "https://a.b/photo.jpg"]], "u string")
    assert [r[0] for r in df.select(urls.is_content_image("u")).collect()] == [False] * 4 + [True]
    nested = 'https://x.y/a&quot; href=\\"https://good.org/p.jpg\\" z'
    assert spark.createDataFrame([(nested,)], "u string").select(urls.normalize_url("u")).first()[0] == "https://good.org/p.jpg"


def test_enrichment(spark, tmp_path):
    raw = [
        {"id": "a", "title": "春之山水特展", "sourceUrl": "https://p.example.org/a", "hitRate": "5"}, {"id": "b", "title": "秋之靜物展", "sourceUrl": "https://p.example.org/b"},
        {"id": "c", "title": "冬之雕塑展", "address": "台北市一路1號", "latitude": "10", "longitude": "10", "images": ["https://i.example.org/c.jpg"], "locationName": "丙館", "startDate": "2026-03-01", "endDate": "2026-04-01"},
    ]
    (tmp_path / "r.json").write_text(json.dumps(raw))
    R.typed(R.read_variants(spark, f"{tmp_path}/r.json")).write.parquet(f"{tmp_path}/typed")
    e = spark.read.parquet(f"{tmp_path}/typed")
    place = json.dumps({"@type": "Event", "location": {"name": "甲美術館", "address": "台北市二路2號", "geo": {"latitude": 25.05, "longitude": 121.54}}}, ensure_ascii=False)
    body = f'<meta property="og:title" content="春之山水特展"><meta property="og:description" content="{"長" * 60}"><meta property="og:image" content="/a.jpg"><script type="application/ld+json">{place}</script>'
    html = spark.createDataFrame([(1, "https://p.example.org/a", body), (2, "https://p.example.org/b", "<title>別的</title>")], "page_id bigint, url string, html string")
    day, now = F.lit("2026-03-10").cast("date"), F.lit("2026-03-10T00:00:00")
    assert {r["id"] for r in enrich.page_candidates(e, day).collect()} == {"a", "b"} and {r["id"] for r in enrich.detail_candidates(e).collect()} == {"a", "b", "c"}
    got = {r["id"]: r for r in enrich.with_pages(e, html, day, now).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert (a["verified"], a["images"], a["venue"], a["address"], a["region"], a["lat"], a["place_source"]) == (True, ["https://p.example.org/a.jpg"], "甲美術館", "台北市二路2號", "台北市", 25.05, "source_page")
    assert (b["verified"], b["source_url"], b["rejected_url"]) == (False, "", "https://p.example.org/b") and c["checked_at"] == ""
    ok = {r["id"]: (r["lat"], r["place_rejected"]) for r in enrich.checked_places(e).select("id", "lat", "place_rejected").collect()}
    assert ok["c"][0] is None and ok["c"][1]["lat"] == 10 and ok["a"] == (None, None)
    official = spark.createDataFrame([("丙館", "https://o.example.org/logo.png")], "venue string, image string")
    assert {r["venue"]: r["image"] for r in enrich.venue_images(e, official, day).collect()} == {"丙館": "https://i.example.org/c.jpg"}
    more = e.where("id = 'b'").withColumns({"description": F.lit("a longer text"), "ord": F.lit(0).cast("long")})
    assert {r["id"]: r["description"] for r in enrich.with_details(e, more).select("id", "description").collect()} == {"a": "", "b": "a longer text", "c": ""}
