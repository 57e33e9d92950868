"""Whole records: aliases and nesting, the merge against a left-to-right fold, keys and predicates."""

import json
import random

import pytest
from pyspark.sql import functions as F

from showbill.operators import records as R
from showbill.operators import rules

RAW = [
    {"UID": "A1", "title": "山水 &amp; 特展", "showInfo": [{"time": "2026/03/01 10:00", "locationName": "某某美術館", "location": "台北市中山路1號", "latitude": "25.05", "longitude": "121.54", "onSales": "N"}, {"time": "2026/04/01"}],
     "category": "6", "descriptionFilterHtml": "<p>畫<br>與 https://museum.example.org/show?id=3。</p><img src='/k.jpg'>", "hitRate": "12", "imageUrl": "https://a.example.org/p1.jpg", "startDate": "2026/03/01", "endDate": "2026/05/01", "masterUnit": ["甲館", "乙館"]},
    {"name": "音樂會 live", "images": [{"url": "https://a.example.org/x.jpg", "note": "n"}, ["https://a.example.org/y.png"]], "cover": "{\"src\": \"https://a.example.org/z.jpg\"}", "sourceUrl": "https://hall.example.org/e/1", "sessions": {"startTime": "2026-06-01", "venue": "大廳"}, "Latitude": "121.5", "Longitude": "25,1", "Price": "300"},
    {"title": "春季講座", "startDate": "2026-01-01"}, {"title": "  "}, {"actName": "雕塑展", "address": "高雄市三民路2號", "tel": "07-1", "onSales": "n"},
]


@pytest.fixture(scope="module")
def typed(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("feeds")
    (d / "a.json").write_text(json.dumps(RAW[:2]))
    (d / "b.json").write_text(json.dumps({"events": [*RAW[2:], "no object", None]}))
    (d / "broken.json").write_text("{")
    raw = R.read_variants(spark, f"{d}/a.json", f"{d}/b.json", f"{d}/broken.json", f"{d}/missing.json")
    R.typed(raw, [("某某館", ["某某美術館"])]).write.parquet(f"{d}/typed")
    return spark.read.parquet(f"{d}/typed")


def test_typed_records(typed, spark):
    got = sorted(typed.collect(), key=lambda r: r["ord"])
    assert [r["title"] for r in got] == ["山水 & 特展", "音樂會 live", "雕塑展"]
    a, b, c = got
    assert (a["id"], a["start_date"], a["end_date"], a["venue"], a["region"], a["lat"], a["price"], a["hits"], a["organiser"]) == ("A1", "2026-03-01", "2026-05-01", "某某館", "台北市", 25.05, "免費", 12, "甲館、乙館")
    assert a["source_url"] == "https://museum.example.org/show?id=3" and a["images"] == ["https://a.example.org/p1.jpg", "https://museum.example.org/k.jpg"] and a["categories"] == ["美術"]
    assert [s["time"] for s in a["sessions"]] == ["2026-03-01", "2026-04-01"] and a["sessions"][1]["lat"] is None
    assert b["images"] == ["https://a.example.org/x.jpg", "https://a.example.org/y.png", "https://a.example.org/z.jpg"] and (b["lat"], b["lon"]) == (25.1, 121.5)
    assert (b["start_date"], b["venue"], b["price"], b["image"], len(b["id"])) == ("2026-06-01", "大廳", "300", "https://a.example.org/x.jpg", 18)
    assert (c["venue"], c["region"], c["price"], c["phone"], c["place_source"]) == ("高雄市｜場館資料整理中", "高雄市", "免費", "07-1", "")
    assert R.typed(R.read_variants(spark, "/nowhere/x.json")).count() == 0


TEXTS = ["id", "title", "start_date", "end_date", "venue_detail", "address", "place_source", "organiser", "transit", "parking", "phone", "comment"]
PAGE = ["source_url", "verified", "match_score", "rejected_url", "checked_at"]


def fold(old, new, quality, poor):
    """One step of the merge, as its docstring says it."""
    out = dict(old)
    for k, v in new.items():
        if v in (None, "", []) or (isinstance(v, str) and v in R.PLACEHOLDERS and old[k] not in (None, "", v)):
            continue
        if (k == "description" and len(v) < len(old[k])) or (k == "venue" and poor[v] and not poor.get(old[k], True)):
            continue
        out[k] = v
    best = old if quality[old["_who"]] >= quality[new["_who"]] else new
    out["_who"] = best["_who"]
    if best["source_url"]:
        out.update({k: best[k] for k in PAGE})
    ordered = lambda x, y: list(dict.fromkeys([*x, *y]))
    out["images"] = ordered(old["images"], new["images"])[:10]
    out["image"] = out["images"][0] if out["images"] else ""
    out["_cats"] = ordered(new["categories"], old["_cats"])
    return out


def test_merge_equals_fold(spark, typed):
    rnd = random.Random(3)
    schema = typed.schema
    pick = lambda *xs: rnd.choice(xs)
    rows = []
    for i in range(240):
        base = {f.name: "" for f in schema.fields}
        base |= {c: pick("", f"{c}{i % 7}", f"{c}-{i}") for c in TEXTS} | {"region": pick("", "台北市", R.rules.UNKNOWN_REGION), "price": pick("", R.UNKNOWN_PRICE, f"{i}"), "source": pick(R.FEED, "x", "")}
        base |= {"description": "d" * rnd.randrange(6), "venue": pick("", R.UNKNOWN_VENUE, "中正區", f"館{i}"), "images": [f"https://i.example.org/{rnd.randrange(6)}.jpg" for _ in range(rnd.randrange(3))], "categories": rnd.sample(["美術", "音樂", "電影", "親子"], rnd.randrange(1, 3)), "sessions": []}
        base |= {"source_url": pick("", f"https://p.example.org/{'a/' * rnd.randrange(4)}{i % 5}"), "verified": pick(True, False), "match_score": float(rnd.randrange(3)), "lat": pick(None, 25.0 + i / 1000), "lon": pick(None, 121.0), "hits": i, "ord": i, "image": "", "category": "", "first_seen": "2026", "last_seen": "2026"}
        rows.append(base)
    df = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema).withColumn("k", F.pmod(F.col("ord") * 7, F.lit(23)).cast("string"))
    quality = {r["ord"]: tuple(r["q"]) for r in df.select("ord", R.source_quality().alias("q")).collect()}
    poor = {r["venue"]: r["p"] for r in df.select("venue", rules.poor_venue("venue").alias("p")).distinct().collect()}
    got = {r["k"]: r for r in R.merged(df.repartition(5), "k").collect()}
    for k in got:
        group = [r for r in rows if str(r["ord"] * 7 % 23) == k]
        acc = group[0] | {"_who": group[0]["ord"], "_cats": group[0]["categories"]}
        acc["image"] = (acc["images"] or [""])[0]
        acc["images"] = list(dict.fromkeys(acc["images"]))
        for r in group[1:]:
            acc = fold(acc, r | {"_who": r["ord"]}, quality, poor)
        for c in [*TEXTS, *PAGE, "description", "price", "region", "source", "lat", "lon", "hits", "images", "image"]:
            assert got[k][c] == acc[c], (k, c)
        assert got[k]["categories"] == acc["_cats"][:3] and got[k]["_n"] == len(group)
        assert poor[got[k]["venue"]] == poor[acc["venue"]]


def test_catalogue_update(typed):
    day, now = F.lit("2026-03-10").cast("date"), F.lit("2026-03-10T08:00:00")
    old = typed.withColumns({"first_seen": F.lit("2026-01-01"), "last_seen": F.lit("2026-01-01")})
    other = typed.where("id = 'A1'").withColumns({"id": F.lit("B9"), "description": F.lit("much longer description of the show " * 3), "first_seen": F.lit("2025-12-01")})
    got = R.catalogue(other, old, day, now).collect()
    assert [r["title"] for r in got] == ["山水 & 特展", "音樂會 live", "雕塑展"]
    assert (got[0]["first_seen"], got[0]["last_seen"], got[0]["id"]) == ("2025-12-01", "2026-03-10T08:00:00", "B9") and got[1]["last_seen"] == "2026-01-01"
    assert got[0]["description"].startswith("much longer")
    counts = R.snapshot(typed, "now").first()
    assert (counts["events"], counts["with_image"], counts["with_place"]) == (3, 2, 2) and counts["category_counts"]["美術"] == 2


def test_keys_and_predicates(spark):
    df = spark.createDataFrame([("e12", "x", "", "", "", "臺北市"), ("", "徵件比賽", "得獎作品展", "https://A.b/c/", "臺北 館（二）", "臺北市"), ("", "徵件", "", "", "", ""), ("", "t", "", "https://www.example.com/1", "", None)], "id string, title string, description string, source_url string, venue string, region string")
    rows = df.withColumn("start_date", F.lit("2026-01-01")).withColumn("address", F.lit("")).select(R.is_sample().alias("s"), R.is_call().alias("c"), R.record_key().alias("k"), R.place_key("venue").alias("p"), R.geocode_key().alias("g"), R.displayable_venue("venue").alias("d")).collect()
    assert [r["s"] for r in rows] == [True, False, False, True] and [r["c"] for r in rows] == [False, False, True, False]
    assert rows[0]["k"] == "id:e12" and rows[1]["k"] == "url:https://a.b/c" and rows[2]["k"].startswith("text:")
    assert rows[1]["p"] == "台北市|台北館二" and rows[0]["p"] == "" and rows[1]["g"] == "台北 館（二） 台北市" and rows[1]["d"] and not rows[0]["d"]


def test_venues(spark):
    df = spark.createDataFrame([("某某美術館 三樓", "", "", ""), ("台北市中正區", "", "", ""), ("中山路5號", "高雄市", "", ""), ("小廳", "", "大館", "")], "v string, a string, g string, d string")
    c = F.col
    etl = [tuple(r[0]) for r in df.select(R.venue_name(c("v"), c("a"), [("某某館", ["某某", "某某美術館"])])).collect()]
    assert etl == [("某某館", "三樓"), ("台北市｜場館資料整理中", ""), ("高雄市｜場館資料整理中", ""), ("小廳", "")]
    app = [tuple(r[0]) for r in df.select(R.venue_by_rules(c("v"), c("a"), c("g"), c("d"), [("某某(?:美術)?館", "某某館")])).collect()]
    assert app == [("某某館", "三樓"), ("台北市｜場館資料整理中", ""), ("高雄市｜場館資料整理中", ""), ("大館", "")]
