"""Trees, page facts, geocodes, grids, patterns, feeds, snapshots and retention against plain second implementations."""

import datetime as D
import difflib
import json
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from showbill.functions import geo, text
from showbill.operators import enrich, extract, facets, geocode, overlay, records, trees
from showbill.sources import feeds, harvest, published
from showbill.streaming import retention


def tree(rnd, depth):
    kind = rnd.random()
    if depth == 0 or kind < 0.3:
        return rnd.choice([1, 2.5, "text", "", None, True, '{"looks":"like"}', "[1]", "quo\"te", "日本"])
    if kind < 0.65:
        return {rnd.choice("zyxbca") + str(i): tree(rnd, depth - 1) for i in range(rnd.randrange(4))}
    return [tree(rnd, depth - 1) for _ in range(rnd.randrange(4))]


def walked(value):
    if isinstance(value, dict):
        yield value
    for child in value.values() if isinstance(value, dict) else value if isinstance(value, list) else ():
        yield from walked(child)


def test_objects_equal_a_walk(spark):
    rnd = random.Random(5)
    rows = [(i, json.dumps(tree(rnd, 6), ensure_ascii=bool(i % 2))) for i in range(60)] + [(100, None), (101, ""), (102, "{broken"), (103, "[" * 40 + '{"deep":1}' + "]" * 40)]
    got = {}
    for r in trees.objects(spark.createDataFrame(rows, "id int, j string"), "j", ["id"]).orderBy("id", "path").collect():
        got.setdefault(r["id"], []).append(json.loads(r["json"]))
    want = {}
    for i, j in rows:
        try:
            found = list(walked(json.loads(j)))
        except (TypeError, ValueError):
            found = []
        if found:
            want[i] = found
    assert got == want
    assert trees.objects(spark.createDataFrame([], "id int, j string"), "j", ["id"]).count() == 0


def flattened(value):
    if isinstance(value, list):
        return [x for v in value for x in flattened(v)]
    if isinstance(value, dict):
        return flattened([value[k] for k in records.IMAGE_MEMBERS if k in value] or list(value.values()))
    if isinstance(value, str):
        s = value.strip()
        if (s[:1], s[-1:]) in (("[", "]"), ("{", "}")):
            try:
                return flattened(json.loads(s))
            except ValueError:
                pass
        return [value] if s else []
    return []


def test_flat_texts_equal_a_walk(spark):
    rnd = random.Random(6)

    def value(depth):
        if depth == 0 or rnd.random() < 0.4:
            return rnd.choice(["a", "", "b&c", "[x]", '["in",{"src":"s"}]', None, "{x", "\\u0026"])
        if rnd.random() < 0.5:
            return {rnd.choice(["url", "src", "large", "note", "cover", "w"]): value(depth - 1) for _ in range(3)}
        return [value(depth - 1) for _ in range(rnd.randrange(4))]

    texts = [json.dumps(value(5)) if i % 3 else value(0) for i in range(150)] + ['{"note":"n","sizes":{"large":"L","w":"x"}}', '[{"url":"a"},{"foo":"b"}]', "[" * 30 + '"deep"' + "]" * 30]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", records.flat_texts("t").alias("x")).collect()
    assert {r["i"]: r["x"] for r in rows} == {i: flattened(t) for i, t in enumerate(texts)}


def block(*values):
    return "".join(f'<script type="application/ld+json">{v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)}</script>' for v in values)


PLACE = {"@type": "Place", "name": "甲館", "address": {"streetAddress": "一路1號", "addressLocality": "中區", "addressRegion": "台中市", "postalCode": "400"}, "geo": {"latitude": "24.1", "longitude": 120.6}}
PAGES = {
    "https://p.org/event": block({"@type": "Event", "name": "The Show", "location": PLACE, "image": [{"url": "https://i.org/1.jpg", "w": "x"}, "/2.jpg"], "description": "d" * 30}),
    "https://p.org/site": block({"@type": "WebSite", "name": "Site", "image": "https://i.org/s.jpg"}),
    "https://p.org/graph": block("{broken", {"@graph": [{"@type": "Organization", "name": "Org"}, {"@type": "Museum", "alternateName": "乙館", "address": "二路2號", "lat": "23.5", "lng": "120.5"}]}),
    "https://p.org/first": block({"@type": "Event", "subEvent": {"@type": "Event", "location": {"address": "三路3號"}}, "location": {"name": " ", "alternateName": "丙館"}}, {"@type": "Place", "name": "丁館", "address": "x", "geo": {"latitude": 25, "longitude": 121}}),
    "https://p.org/plain": "<p>展覽地點：<b>戊館</b></p>\n<p>404台中市北區三民路一段5號3樓</p>{\"latitude\": \"24.15\", \"longitude\": \"120.68\"}<script>x={\"description\": \"say \\\"hi\\\" " + "y" * 30 + "\"}</script>",
    "https://p.org/none": "",
    "https://www.opentix.life/event/1": "<div>節目介紹 異動公告</div><h2><span>節目介紹</span></h2><p>" + "好" * 60 + "</p><h2>注意事項</h2><p>no</p>",
}


def test_page_facts(spark):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(PAGES.items())], "page_id int, url string, html string")
    got = {r["url"].rsplit("/", 1)[-1]: r for r in enrich.page_metadata(df).collect()}
    facts = {k: (r["page_venue"], r["page_address"], r["page_lat"], r["page_lon"]) for k, r in got.items()}
    assert facts == {
        "event": ("甲館", "400台中市中區一路1號", 24.1, 120.6), "site": ("", "", None, None), "graph": ("乙館", "二路2號", 23.5, 120.5), "first": ("丙館", "三路3號", 25.0, 121.0),
        "plain": ("戊館", "404台中市北區三民路一段5號3樓", 24.15, 120.68), "none": ("", "", None, None), "1": ("", "", None, None),
    }
    assert got["event"]["page_images"] == ["https://i.org/1.jpg", "https://p.org/2.jpg"] and got["site"]["page_images"] == ["https://i.org/s.jpg"]
    assert got["event"]["page_description"] == "d" * 30 and got["plain"]["page_description"] == 'say "hi" ' + "y" * 30 and got["1"]["page_description"] == "好" * 60


def test_image_sources_and_order(spark):
    html = """<link rel="image_src" href="https://i.org/link.jpg"><img data-src="https://i.org/lazy.jpg"><source data-srcset="https://i.org/s1.jpg 1x,https://i.org/s2.jpg 2x">
    <a style="background-image: url('https://i.org/bg.jpg')"> "posterUrl":"https:\\/\\/i.org\\/json.jpg" https://i.org/plain.webp?x=1 <img src="https://i.org/icon.png">"""
    df = spark.createDataFrame([(html, "夜展 海報 2026", ["https://i.org/a.jpg", "https://i.org/thumb.jpg", "https://i.org/event.jpg", "https://i.org/%E5%A4%9C%E5%B1%95.jpg", "https://c.cloudfront.net/b.jpg", "https://i.org/poster-thumb.jpg"])], "h string, t string, u array<string>")
    r = df.select(extract.page_images("h", F.lit("https://p.org/")).alias("i"), extract.ranked_images("u", "t").alias("o")).first()
    assert r["i"] == [f"https://i.org/{x}" for x in ("link.jpg", "lazy.jpg", "s1.jpg", "s2.jpg", "json.jpg", "bg.jpg", "plain.webp?x=1")]

    def points(u):
        from urllib.parse import unquote

        n = unquote(u).lower()
        p = 80 * any(t in n for t in ("夜展", "海報", "2026")) + 30 * bool(re.search("poster|banner|cover|event|activity|exhibition|主視覺|海報", n)) + 12 * ("cloudfront.net" in n) - 25 * bool(re.search("thumb|small|avatar|profile", n))
        return -p

    assert r["o"] == sorted(df.first()["u"], key=points)
    reads = spark.createDataFrame([(1, [f"u{i}" for i in range(30)]), (2, []), (3, ["u1", "x"])], "id int, page_images array<string>")
    probes = spark.createDataFrame([("u3", True), ("u9", True), ("u2", False), ("u25", True), ("x", True)], "url string, ok boolean")
    got = {r["id"]: r["page_images"] for r in enrich.probed_images(reads, probes, ["id"]).collect()}
    assert got == {1: ["u3", "u9", *[f"u{i}" for i in range(30) if i not in (3, 9)]][:18], 2: [], 3: ["x", "u1"]}


def test_token_coverage(spark):
    """The score of a page's text: the share of a title's telling tokens, 0.82 at most; the best of all measures counts."""
    cases = [("春之聲 音樂會：台北場", "別的", "這裡有春之聲，也有台北場"), ("春之聲 展覽", "x", "春 之 聲"), ("展覽 活動", "y", "展覽"), ("Night/Day (live)", "z", "night and LIVE"), ("一 二", "q", "一二"), ("", "a", "b"), ("only", "", "")]

    def compact(t):
        return re.sub(r"[^0-9a-z㐀-鿿]+", "", t.lower())

    def want(title, page_title, page):
        e, c, plain = compact(title), compact(page_title), compact(page)
        if not e:
            return 0.0
        scores = [0.0]
        if c:
            scores += [difflib.SequenceMatcher(None, e, c).ratio(), 0.98 * (e in c), 0.88 * (len(c) >= 6 and c in e)]
            pairs = lambda s: {s[i : i + 2] for i in range(len(s) - 1)}
            if pairs(e):
                scores.append(len(pairs(e) & pairs(c)) / len(pairs(e)))
        if plain:
            tokens = [compact(t) for t in re.split(r"[\s：:、,，/|()（）【】《》\-—]+", title)]
            tokens = [t for t in tokens if len(t) >= 2 and t not in text.COMMON_TOKENS]
            scores += [0.92 * (e in plain), 0.82 * sum(t in plain for t in tokens) / len(tokens) if tokens else 0.0]
        return round(max(scores), 4)

    got = spark.createDataFrame(cases, "t string, p string, b string").select(text.title_score("t", "p", "b").alias("s")).collect()
    assert [r["s"] for r in got] == [want(*c) for c in cases]


def looped(wanted, cache, answers, most):
    """The update as a loop over events."""
    cache, filled, used = dict(cache), {}, 0
    inside = lambda p: 20 <= p[0] <= 27 and 117.5 <= p[1] <= 124
    for i, asked, hits, o in sorted(wanted, key=lambda w: (-w[2], w[3])):
        if asked in cache:
            if cache[asked] and inside(cache[asked]):
                filled[i] = (*cache[asked], "geocode_cache")
            continue
        if used >= most:
            break
        used += 1
        at, failed = answers.get(asked, (None, True))
        if failed:
            continue
        cache[asked] = at if at and inside(at) else None
        if cache[asked]:
            filled[i] = (*at, "nominatim")
    return filled, cache


@pytest.mark.parametrize("most", [0, 1, 25, 10_000])
def test_geocodes_equal_a_loop(spark, most):
    rnd = random.Random(most)
    wanted = [(f"e{i}", f"a{min(rnd.randrange(120), rnd.randrange(120))}", rnd.randrange(40), i) for i in range(600)]
    cache = {f"a{k}": None if k % 6 == 0 else (23.0 + k / 100, 121.0) for k in range(0, 120, 3)}
    answers = {f"a{k}": ((24.0 if k % 5 else 60.0, 120.0) if k % 4 else None, k % 7 == 0) for k in range(120) if k % 11}
    w = spark.createDataFrame([(i, a, "", h, o) for i, a, h, o in wanted], "id string, asked string, region string, hits long, ord long").repartition(5)
    c = spark.createDataFrame([(a, *(p or (None, None))) for a, p in cache.items()], "asked string, lat double, lon double")
    a = spark.createDataFrame([(k, *(p or (None, None)), f) for k, (p, f) in answers.items()], "asked string, lat double, lon double, failed boolean")
    found, remembered = geocode.geocoded(w, c, a, most)
    filled, new = looped(wanted, cache, answers, most)
    assert {r["id"]: (r["lat"], r["lon"], r["place_source"]) for r in found.collect()} == filled
    assert {r["asked"]: (r["lat"], r["lon"]) if r["lat"] is not None else None for r in remembered.collect()} == new


def test_positions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7 % 1000).alias("o")).repartition(7)
    assert {r["id"]: r["position"] for r in geocode.positions(df, F.col("o")).collect()} == {i: i * 7 % 1000 + 1 for i in range(1000)}


def km(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


@pytest.fixture(scope="module")
def spots():
    rnd = random.Random(9)
    near = [(25 + rnd.gauss(0, 0.3), 121 + rnd.gauss(0, 0.3)) for _ in range(300)]
    line = [(rnd.uniform(-20, 20), rnd.choice([-1, 1]) * rnd.uniform(179.2, 180)) for _ in range(80)]
    poles = [(rnd.choice([-1, 1]) * rnd.uniform(78, 90), rnd.uniform(-180, 180)) for _ in range(80)]
    return [*near, *line, *poles, (25.0, 121.0), (25.0, 121.0), (80.0, 10.0), (-79.99, -179.99)]


@pytest.mark.parametrize("radius", [3.0, 60.0, 900.0, 25_000.0])
def test_radius_join_equals_brute_force(spark, spots, radius):
    places = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)] + [(9001, None, 1.0), (9002, 0.0, 5.0)], "key int, lat double, lon double")
    points = places.where("key % 7 = 0").withColumnRenamed("key", "point_key")
    joined = geo.within_km(points, places, radius)
    got = {(r["point_key"], r["key"]) for r in joined.collect()}
    assert got == {(i, j) for i in range(0, len(spots), 7) for j in range(len(spots)) if km(spots[i], spots[j]) <= radius}
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_nearest_join_equals_brute_force(spark, spots):
    places = spark.createDataFrame([(i, *s) for i, s in enumerate(spots)], "key int, lat double, lon double")
    points = spark.createDataFrame([(i, *s) for i, s in enumerate(spots) if i % 29 == 0] + [(5000, -33.0, 18.0)], "point_key int, lat double, lon double")
    got = {}
    for r in geo.nearest_places(points, places, 4, 2.0).collect():
        got.setdefault(r["point_key"], []).append((r["place"], r["key"]))
    at = {i: s for i, s in enumerate(spots) if i % 29 == 0} | {5000: (-33.0, 18.0)}
    for i, p in at.items():
        best = sorted(range(len(spots)), key=lambda j: (round(km(p, spots[j]), 9), j))[:4]
        assert [k for _, k in sorted(got[i])] == best
    few = geo.nearest_places(points, places.where("key < 2"), 4)
    assert few.groupBy("point_key").count().where("count <> 2").count() == 0


def test_hot_cells_are_split(spark):
    places = spark.range(4000).select(F.col("id").alias("key"), F.lit(25.0).alias("lat"), (121 + F.col("id") * 1e-7).alias("lon"))
    points = spark.createDataFrame([(1, 25.0, 121.0)], "point_key int, lat double, lon double")
    assert geo.within_km(points, places, 5.0).count() == 4000


def test_patterns_equal_the_expression(spark, tmp_path):
    profiles = [("甲館", ["甲美術館", "甲館", "JIA"]), ("乙", ["乙", "Hall B"]), ("never", ["qqqq"]), ("", ["x"]), ("丙", ["hall", "HALL BB"])]
    (tmp_path / "v.json").write_text(json.dumps({"venues": [{"name": n, "patterns": p, "homepage": "h"} for n, p in profiles] + ["junk", {"name": "no patterns"}]}, ensure_ascii=False))
    table = feeds.read_profiles(spark, f"{tmp_path}/v.json")
    assert feeds.read_profiles(spark, f"{tmp_path}/missing.json").count() == 0
    names = ["甲美術館 三樓", "在甲館、二樓", "jia gallery", "the HALL BB", "Hall b room", "乙", "nothing", "", None, "hall", "ha ll", "x"]
    df = spark.createDataFrame([(i, n, "kept") for i, n in enumerate(names)], "i int, venue string, venue_detail string")
    got = {r["i"]: (r["venue"], r["venue_detail"]) for r in overlay.venue_names(df, table).collect()}
    named = [p for p in profiles if p[0]]
    for r in df.select("i", "venue", overlay.first_alias(F.col("venue"), named).alias("a"), records.venue_name(F.coalesce("venue", F.lit("")), F.lit(""), named).alias("v")).collect():
        assert got[r["i"]] == ((r["a"], r["v"]["detail"]) if r["a"] else (r["venue"], "kept"))


def flaky(log):
    """Responses by method and feed; feed `b` fails twice and then answers, `c` answers by the second method only, `d` never. A function of its own goes to the tasks by value."""
    first = harvest.METHODS[0]

    def fetch(method, feed):
        with open(f"{log}/{feed}", "a") as f:
            f.write(method + "\n")
        asked = len(open(f"{log}/{feed}").readlines())
        if feed == "b" and asked < 3 or feed == "d" or feed == "c" and method == first:
            raise OSError("out of order")
        return json.dumps([{"id": f"{feed}1", "title": "t"}, "junk", {"id": f"{feed}2", "_feedCategory": "own"}] if feed != "e" else {"events": []})

    return fetch


def test_harvest(spark, tmp_path):
    harvest.register(spark, flaky(str(tmp_path)), "flaky_feeds")
    got, failed = harvest.harvested(spark, ["a", "b", "c", "d", "e"], 3, "flaky_feeds")
    rows = got.orderBy("ord").select(F.variant_get("raw", "$.id", "string").alias("id"), F.variant_get("raw", "$._feedCategory", "string").alias("f"), "file").collect()
    assert [tuple(r) for r in rows] == [(f"{x}{i}", x if i == 1 else "own", x) for x in "abc" for i in (1, 2)]
    assert {r["feed"] for r in failed.collect()} == {"d", "e"} and "attempt 3/3" in failed.first()["error"]
    calls = {x: (tmp_path / x).read_text().split() for x in "abcde"}
    assert {x: len(c) for x, c in calls.items()} == {"a": 1, "b": 3, "c": 4, "d": 6, "e": 6}
    (tmp_path / harvest.METHODS[0]).mkdir()
    (tmp_path / harvest.METHODS[0] / "z.json").write_text('{"result": [{"id": "z"}]}')
    harvest.register(spark, harvest.recorded(f"file://{tmp_path}"), "kept_feeds")
    assert harvest.harvested(spark, ["z", "zz"], 1, "kept_feeds")[0].count() == 1


def test_published_snapshots(spark, tmp_path):
    base = f"{tmp_path}/snapshot"
    rows = lambda n: spark.createDataFrame([(f"e{i}", "https://i.org/a.jpg" if i % 2 else "", ["a", "b"], ["美術"], "美術", 25.0, 121.0 if i else None) for i in range(n)], "id string, image string, images array<string>, categories array<string>, category string, lat double, lon double")
    with pytest.raises(ValueError):
        published.read(spark, base)
    first = published.publish(rows(4), base, "day 1")
    held = published.read(spark, base)
    broken = rows(9).withColumn("id", F.when(F.col("id") == "e7", F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        published.publish(broken, base, "day 2")
    assert published.current(spark, base) == first and published.read(spark, base).count() == 4
    second = published.publish(rows(6), base, "day 3")
    assert held.count() == 4 and published.read(spark, base).count() == 6 and published.current(spark, base) == second != first
    s = published.read_stats(spark, base).first()
    assert (s["updatedAt"], s["eventCount"], s["imageCount"], s["multiImageCount"], s["coordinateCount"], s["imageCoverage"], s["coordinateCoverage"], s["categoryCounts"]["美術"]) == ("day 3", 6, 3, 6, 5, 0.5, 0.8333, 6)
    assert len(published.prune(spark, base)) == 2 and published.read(spark, base).count() == 6
    assert published.publish(rows(0), base, "day 4") and published.read_stats(spark, base).first()["imageCoverage"] == 0


def test_facet_orders(spark):
    rows = [("乙市", "b館"), ("乙市", "B館"), ("乙市", "a館"), ("乙市", "a館"), ("乙市", ""), ("甲市", None), ("丙市", "x"), ("無", "y"), ("乙市", "一館"), ("乙市", "丁館")]
    df = spark.createDataFrame(rows, "region string, venue string")
    got = [(r["region"], r["venue"], r["n"]) for r in facets.region_facets(df, ["丙市", "甲市", "乙市"]).orderBy("region_place", "venue_place").collect()]
    assert got[:3] == [("丙市", None, 1), ("丙市", "x", 1), ("甲市", None, 1)] and got[3:5] == [("乙市", None, 7), ("乙市", "a館", 2)]
    assert [v for _, v, _ in got[5:]] == ["一館", "丁館", "b館", "B館"] or [v for _, v, _ in got[5:]] == ["b館", "B館", "一館", "丁館"]
    e = spark.createDataFrame([(["z", "b"], "z"), ([], "a"), (["b"], "b"), (["q"], "q")], "categories array<string>, category string")
    assert [tuple(r) for r in facets.category_strip(e, ["a", "b"], 3).orderBy("place").collect()] == [(1, "a", 1), (2, "b", 2), (3, "q", 1)]


def test_venue_images_stand_in(spark):
    e = spark.createDataFrame([("1", "v", ["https://i.org/a.jpg"], ""), ("2", "v", [], ""), ("3", "w", [], ""), ("4", "v", [], "https://i.org/loading.gif"), ("5", None, [], "")], "id string, venue string, images array<string>, image string")
    pictures = spark.createDataFrame([("v", "https://i.org/v.jpg"), ("w", "https://i.org/placeholder.png")], "venue string, image string")
    got = {r["id"]: (r["media"], r["shown_images"]) for r in overlay.with_venue_images(e, pictures).collect()}
    assert got == {"1": ("event", ["https://i.org/a.jpg"]), "2": ("venue", ["https://i.org/v.jpg"]), "3": ("placeholder", []), "4": ("venue", ["https://i.org/v.jpg"]), "5": ("placeholder", [])}


def test_retention_stream_equals_replay(spark, tmp_path):
    rnd = random.Random(4)
    day = D.datetime(2026, 1, 1)
    schema = "key string, title string, venue string, description string, start_date date, end_date date, seen timestamp, ord long"
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows, last = [], None
    for b in range(5):
        batch = []
        for i in range(30):
            k = rnd.randrange(25)
            seen = day + D.timedelta(days=4 * b + rnd.randrange(2), hours=rnd.randrange(24))
            dates = rnd.choice([(None, None), (D.date(2026, 1, 1) + D.timedelta(k), D.date(2026, 1, 1) + D.timedelta(k + 2)), (D.date(2026, 1, 1) + D.timedelta(k), None)]) if k % 5 else (D.date(2028, 1, 1), None)
            batch.append((f"k{k}", rnd.choice(["", f"T{b}{i}"]), rnd.choice([None, "", f"V{i}"]), "d" * rnd.randrange(5) + rnd.choice("ab"), *dates, seen, b * 100 + 7 * i % 30))
        rows += batch
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        changes = retention.retained(source).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").outputMode("append").trigger(availableNow=True).start()
        changes.awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    newest = max(r[6] for r in rows) - D.timedelta(2)
    assert out.where("change = 'expired'").count() > 0
    columns = ["key", "title", "venue", "description", "start_date", "end_date", "first_seen", "last_seen"]
    got = sorted(map(tuple, retention.catalogue(out).select(columns).collect()))
    gone = {r["key"] for r in out.where("change = 'expired'").collect()}
    want = retention.replayed(spark.createDataFrame(rows, schema), F.lit(newest.date())).select(columns).collect()
    assert [r for r in got if r[0] not in gone] == sorted(tuple(r) for r in want if r["key"] not in gone) and len(got) > 5
    assert "k5" not in {r[0] for r in got} and not any(r["start_date"] == D.date(2028, 1, 1) for r in out.collect())
    for r in out.where("change = 'expired'").collect():
        assert (r["at"].date() - (r["end_date"] or r["start_date"])).days == retention.AFTER + 1


def test_app_projection(spark):
    raw = [
        {"titile": " 夜展 ", "description": "好 &amp; <b>真</b>\n臉書 粉專", "address": "臺北市一路1號", "showInfo": [{"time": "2026/03/01"}, {"locationName": "甲館", "latitude": "25", "longitude": "121.5", "onSales": "N", "imageUrl": "https://i.org/s.jpg"}], "images": '["https://i.org/a.jpg",{"src":"https://i.org/icon/logo.png"}]', "poster": "https://i.org/avatar.png", "webSales": "https://t.org/1", "masterUnit": ["甲", "乙"], "hitRate": "12", "categoryName": "6"},
        {}, {"id": 7, "title": "t", "price": "100", "sourceUrl": "https://www.facebook.com/x", "venueGroup": "乙館", "venueDetail": "3F", "region": "臺中市", "startDate": "2026-01-02"},
    ]
    df = spark.createDataFrame([(json.dumps(r, ensure_ascii=False), i) for i, r in enumerate(raw)], "j string, ord long").select(F.parse_json("j").alias("raw"), "ord")
    a, b, c = records.app_events(df).orderBy("ord").collect()
    assert (a["id"], a["title"], a["description"], a["source_url"], a["images"], a["venue"], a["address"], a["region"], a["lat"], a["price"], a["organiser"], a["hits"], a["category"], a["start_date"]) == (
        "https://t.org/1", "夜展", "好 & 真", "https://t.org/1", ["https://i.org/a.jpg", "https://i.org/icon/logo.png", "https://i.org/s.jpg"], "甲館", "臺北市一路1號", "台北市", 25.0, "免費", "甲、乙", 12, "美術", "")
    assert (b["id"], b["title"], b["venue"], b["price"], b["images"], b["region"], b["hits"]) == ("未命名展覽-1", "未命名展覽", "地點待確認", "票價請見活動頁面", [], "其他地區", 0)
    assert (c["id"], c["source_url"], c["venue"], c["venue_detail"], c["region"], c["price"], c["start_date"], c["end_date"]) == ("7", "", "乙館", "3F", "台中市", "100", "2026-01-02", "2026-01-02")


def test_urls_against_a_base(spark):
    from showbill.functions import urls

    cases = {"/a/b": "https://h.org/a/b", "x.html": "https://h.org/d/x.html", "": "", None: "", "javascript:x": "", "https://o.org/y": "https://o.org/y", "//c.org/z": "https://c.org/z", "data:image/png;base64,x": "", "?q": "https://h.org/d/?q"}
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert [r[0] for r in df.select(urls.normalize_url("u", "https://h.org/d/")).collect()] == list(cases.values())
    groups = spark.createDataFrame([("https://www.facebook.com/Groups/1",), ("https://fb.me/x",), ("https://h.org/groups/1",), (None,)], "u string")
    assert [r[0] for r in groups.select(urls.is_blocked_group("u")).collect()] == [True, False, False, False]
    raw = spark.createDataFrame([('{"title":"t","website":"/e/1","imageUrl":"/p/1.jpg"}', 0), ('{"title":"u","imageUrl":"/p/2.jpg","note":1}', 1)], "j string, ord long").select(F.parse_json("j").alias("raw"), "ord")
    got = [(r["source_url"], r["images"]) for r in records.typed(raw).orderBy("ord").collect()]
    assert got == [(f"{records.FEED_BASE}e/1", [f"{records.FEED_BASE}p/1.jpg"]), ("", [f"{records.FEED_BASE}p/2.jpg"])]


def test_moments(spark):
    from showbill.functions import dates

    texts = ["2026-03-0110:00", "2026/03/01 09:30:15", "2026-3-1", "2026-03-01T08:00", "soon", "", None, "2026-02-30"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(dates.parse_moment("t")).collect()]
    assert got == [D.datetime(2026, 3, 1, 10), D.datetime(2026, 3, 1, 9, 30, 15), D.datetime(2026, 3, 1), D.datetime(2026, 3, 1, 8), None, None, None, None]


def test_small_readers(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": [25.0, 121.0], "b": null, "c": [1]}')
    assert {r["asked"]: r["lat"] for r in feeds.read_geocodes(spark, f"{tmp_path}/c.json").collect()} == {"a": 25.0, "b": None, "c": None}
    (tmp_path / "v.json").write_text('{"venueImages": {" 甲館 ": "https://i.org/v.jpg", "乙": "https://www.facebook.com/p.jpg", "丙": "not a url", "": "https://i.org/x.jpg"}}')
    assert [tuple(r) for r in feeds.read_venue_images(spark, f"{tmp_path}/v.json").collect()] == [("甲館", "https://i.org/v.jpg")]
    (tmp_path / "broken.json").write_text("{")
    assert feeds.read_venue_images(spark, f"{tmp_path}/broken.json").count() == feeds.read_overrides(spark, f"{tmp_path}/none.json").count() == 0
