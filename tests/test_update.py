"""The update end to end, twice, from files and tables as a run would have them."""

import datetime as D
import json

import pytest

from showbill import update
from showbill.sources import harvest, published


def show(i, **more):
    return {"id": f"s{i}", "title": f"夜展{i}號", "startDate": "2026-03-01", "endDate": "2026-04-01", "locationName": f"館{i}", "address": f"台北市一路{i}號", "description": "說明" * 10, "hitRate": str(i), "sourceUrl": f"https://p.example.org/e/{i}"} | more


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("update")
    write = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}")
    first = [show(1, latitude="25.05", longitude="121.5"), show(2, address="台北市一路1號"), show(3, latitude="10", longitude="10"), show(4, title="講座：夜談"), show(5, locationName="中正區"), show(6, address="台北市三路6號"), show(7, endDate="2026-02-01")]
    (d / "first.json").write_text(json.dumps(first, ensure_ascii=False))
    (d / "second.json").write_text(json.dumps({"events": [show(1, description="更長的說明" * 10, locationName="小館 三樓"), show(8)]}, ensure_ascii=False))
    (d / "profiles.json").write_text(json.dumps({"venues": [{"name": "大館", "patterns": ["小館", "館"]}]}, ensure_ascii=False))
    (d / "overrides.json").write_text(json.dumps({"overrides": [{"title": "夜展 2號", "startDate": "2026/03/01", "set": {"price": "免費", "latitude": 25.01, "nothing": "x"}}, {"title": "夜展2號", "endDate": "2020-01-01", "set": {"price": "wrong"}}, "junk"]}, ensure_ascii=False))
    (d / "venues.json").write_text(json.dumps({"venueImages": {"館6": "https://i.example.org/v6.jpg", "館1": "https://i.example.org/logo.png"}}, ensure_ascii=False))
    place = {"@type": "Event", "location": {"@type": "Museum", "name": "真館", "geo": {"latitude": 25.04, "longitude": 121.52}}}
    html = f'<meta property="og:title" content="夜展5號"><meta property="og:image" content="/slow.jpg"><img src="/poster.jpg"><script type="application/ld+json">{json.dumps(place, ensure_ascii=False)}</script>'
    write("pages", [(1, "https://p.example.org/e/5", html)], "page_id int, url string, html string")
    write("probes", [("https://p.example.org/slow.jpg", True), ("https://p.example.org/poster.jpg", False)], "url string, ok boolean")
    write("answers", [("台北市三路6號", 25.06, 121.56, False), ("台北市一路3號", None, None, False)], "asked string, lat double, lon double, failed boolean")
    return str(d)


def test_update_twice(spark, tables):
    more = dict(output=f"{tables}/out", geocode_cache=f"{tables}/cache", overrides=f"{tables}/overrides.json", venue_images=f"{tables}/venues.json", pages=f"{tables}/pages", probes=f"{tables}/probes", answers=f"{tables}/answers", today=D.date(2026, 3, 10))
    update.run(spark, update.Config(input_files=(f"{tables}/first.json",), now="t1", **more))
    got = {r["id"]: r for r in published.read(spark, f"{tables}/out").collect()}
    assert set(got) == {"s1", "s2", "s3", "s5", "s6"}
    at = {i: (r["lat"], r["lon"], r["place_source"]) for i, r in got.items()}
    assert at == {"s1": (25.05, 121.5, "official_feed"), "s2": (25.05, 121.5, "matched_place"), "s3": (None, None, ""), "s5": (25.04, 121.52, "source_page"), "s6": (25.06, 121.56, "nominatim")}
    assert got["s2"]["price"] == "免費" and got["s5"]["venue"] == "真館" and got["s5"]["verified"] and got["s5"]["images"] == ["https://p.example.org/slow.jpg", "https://p.example.org/poster.jpg"]
    cache = {r["asked"]: r["lat"] for r in published.read(spark, f"{tables}/cache", "table").collect()}
    assert cache == {"台北市三路6號": 25.06, "台北市一路3號": None}
    venues = {r["venue"]: r["image"] for r in published.read(spark, f"{tables}/out", "venues").collect()}
    assert venues == {"館6": "https://i.example.org/v6.jpg", "真館": "https://p.example.org/slow.jpg"}
    stats = published.read_stats(spark, f"{tables}/out").first()
    assert (stats["updatedAt"], stats["eventCount"], stats["imageCount"], stats["coordinateCount"]) == ("t1", 5, 1, 4)

    later = more | dict(pages=None, probes=None, answers=None)
    update.run(spark, update.Config(input_files=(f"{tables}/second.json",), profiles=f"{tables}/profiles.json", now="t2", **later))
    got = {r["id"]: r for r in published.read(spark, f"{tables}/out").collect()}
    assert set(got) == {"s1", "s2", "s3", "s5", "s6", "s8"}
    assert (got["s1"]["venue"], got["s1"]["venue_detail"], got["s1"]["description"], got["s1"]["first_seen"], got["s1"]["last_seen"]) == ("大館", "三樓", "更長的說明" * 10, "t1", "t2")
    assert (got["s8"]["venue"], got["s8"]["first_seen"]) == ("大館", "t2") and got["s6"]["last_seen"] == "t1" and got["s6"]["lat"] == 25.06


def test_update_from_feeds(spark, tables):
    harvest.register(spark, lambda method, feed: open(f"{tables}/{feed}.json").read(), "test_feeds")
    config = lambda *names: update.Config(output=f"{tables}/fed", feeds=names, feed_source="test_feeds", retries=1, today=D.date(2026, 3, 10), now="t")
    with pytest.raises(RuntimeError, match="no feed"):
        update.run(spark, config("gone"))
    published.put(spark.range(1), f"{tables}/fed")
    assert update.incoming(spark, config("gone")).count() == 0  # feeds that all fail leave what is published
    assert update.incoming(spark, config("first", "gone")).count() == 7


def test_command_line(monkeypatch):
    monkeypatch.setenv("MAX_GEOCODES", "3")
    c = update.config_of(["--output", "o", "--feeds", "all,1", "--max-pages", "7", "--no-preserve-existing", "--today", "2026-01-02", "--recorded", "file:///r"])
    assert (c.feeds, c.max_geocodes, c.max_pages, c.max_details, c.preserve, c.today, c.recorded, c.feed_source) == (("all", "1"), 3, 7, 250, False, D.date(2026, 1, 2), "file:///r", "recorded_feeds")
    with pytest.raises(SystemExit):
        update.config_of(["--output", "o"])
