"""Expressions on invented values, and the merge rules against a left-to-right fold."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from showbill.functions import dates, geo, text, urls
from showbill.operators import extract, listing, recommend, resolve, rules
from showbill.operators.listing import ListingQuery
from showbill.sources import feeds
from showbill.streaming import upsert as streaming


def values(spark, expr, rows, schema="a string"):
    df = spark.createDataFrame([(i, *(r if isinstance(r, tuple) else (r,))) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_clean_text(spark):
    got = values(spark, text.clean_text("a"), [None, "  a<br>b<BR/>c ", "<p>x &amp; y</p>\t\tz", "a\n\n\n\nb", "　全形　", "&amp;lt;"])
    assert got == ["", "a\nb\nc", "x & y z", "a\n\nb", "全形", "&lt;"]


def test_text_pieces(spark):
    assert values(spark, text.clean_place("a"), ["＝台北：", "a   b"]) == ["台北", "a b"]
    assert values(spark, text.compact_title("a"), ["《夏夜》 Opentix Live! https://x.org/a", "ABC-12"]) == ["夏夜live", "abc12"]
    assert values(spark, text.split_values("a"), ["美術、音樂,  設計;;x"]) == [["美術", "音樂", "設計", "x"]]
    assert values(spark, text.drop_lines("a", "(?i)blocked"), [" a \n Blocked line\n\nb"]) == ["a\nb"]
    assert values(spark, text.bigrams("a"), ["abab", "a", ""]) == [["ab", "ba"], [], []]
    assert values(spark, text.first_value("a", "b"), [(" ", "x"), ("0", "x"), (None, None)], "a string, b string") == ["x", "0", ""]
    assert values(spark, text.first_value("a", "b", profile="app"), [("0", "x")], "a string, b string") == ["x"]


def test_title_score(spark):
    score = text.title_score("a", "b")
    got = values(spark, score, [("夏夜音樂會", "夏夜音樂會 | 售票"), ("夏夜音樂會", "完全無關的頁面"), ("", "x")], "a string, b string")
    assert got[0] >= 0.8 and got[1] < 0.42 and got[2] == 0


def test_dates(spark):
    assert values(spark, dates.date_or_text("a"), ["on 2026/7/1 at", "2026-02-30", "soon"]) == ["2026-07-01", "2026-02-30", "soon"]
    today = F.lit(datetime.date(2026, 1, 10))
    day = lambda n: datetime.date(2026, 1, n)
    rows = [(None, None), (day(1), None), (None, day(9)), (day(11), day(12)), (day(5), day(20))]
    assert values(spark, dates.is_ongoing("s", "e", today), rows, "s date, e date") == [True, True, False, False, True]
    assert values(spark, dates.occurs_on("s", "e", today), rows, "s date, e date") == [False, False, False, False, True]
    assert values(spark, dates.is_ending("s", "e", today, 14), rows, "s date, e date") == [False, False, False, False, True]


def test_coordinates(spark):
    at = geo.coordinate_pair("a", "b")
    got = values(spark, at, [("25,05", "121.5"), ("121.5", "25.05"), ("0", "121"), ("x", None)], "a string, b string")
    assert [tuple(g) if g else None for g in got] == [(25.05, 121.5), (25.05, 121.5), None, None]


def test_urls(spark):
    raw = ["https://a.twhttps://a.tw/p.jpg", "https%3A%2F%2Fx.org%2Fa", "//x.org/b", "https://lib.gov.tw網站查詢", "mailto:x", "https://www.opentix.life/program/123", None, "https:\\/\\/x.org\\/c"]
    assert values(spark, urls.normalize_url("a"), raw) == ["https://a.tw/p.jpg", "https://x.org/a", "https://x.org/b", "https://lib.gov.tw", "", "https://www.opentix.life/event/123", "", "https://x.org/c"]
    assert values(spark, urls.is_blocked("a"), ["https://m.facebook.com/x", "https://x.org/facebook-page", "https://x.org/"]) == [True, True, False]
    assert values(spark, urls.is_ticket_home("a"), ["https://kktix.com/", "https://kktix.com/e/1", "https://x.org/"]) == [True, False, False]
    assert values(spark, urls.is_content_image("a"), ["https://x.org/loading.gif", "https://x.org/art.jpg", ""]) == [False, True, False]


def test_exclusions(spark):
    rows = [("春季講座", ""), ("社區志工成果展", ""), ("全國比賽", ""), ("比賽得獎作品展", ""), ("某鎮公所活動", ""), ("社區發展協會茶會", ""), ("社區發展協會 國際展", ""), ("當代攝影展", "台北市攝影學會"), ("茶會", "台北市攝影學會")]
    assert values(spark, rules.excluded("t", "o"), rows, "t string, o string") == [True, True, True, False, True, True, False, False, True]
    assert values(spark, rules.excluded("t", "o", profile="app"), rows, "t string, o string") == [True, False, False, False, False, True, False, False, True]


def test_classification(spark):
    got = values(spark, rules.classify("c", "t", F.lit("")), [("6", "photo"), ("", "AI 展"), ("", "painting"), ("徵選", ""), ("音樂、表演、舞蹈、電影", "")], "c string, t string")
    assert got == [["攝影", "美術"], ["科技"], ["其他"], ["其他"], ["音樂", "表演", "舞蹈"]]
    assert values(spark, rules.classify("c", "t", F.lit(""), rules=rules.APP_KEYWORDS), [("", "painting")], "c string, t string") == [["科技"]]
    assert values(spark, rules.detect_region("a"), ["臺北市大安區", "nowhere"]) == ["台北市", "其他地區"]


def test_query_parameters():
    today = datetime.date(2026, 1, 1)
    q = ListingQuery.from_params({"category": ["美術,x", "音樂"], "q": [" a "], "date": ["bad"], "view": ["list"]}, today, frozenset({"美術", "音樂"}))
    assert q.categories == {"美術", "音樂"} and q.text == "a" and q.date is None
    assert "view=list" in q.to_params() and "q=a" in q.to_params()


def fold(records):
    """The merge, record by record."""
    kept = {"v": None, "d": None, "venue": None}
    for r in records:
        if r["v"] and not (r["v"] in resolve.PLACEHOLDERS and kept["v"] and kept["v"] != r["v"]):
            kept["v"] = r["v"]
        if r["d"] and len(r["d"]) >= len(kept["d"] or ""):
            kept["d"] = r["d"]
        if r["venue"]:
            stub = r["venue"] in resolve.PLACEHOLDERS and kept["venue"] and kept["venue"] != r["venue"]
            worse = r["venue"].endswith("=") and kept["venue"] and not kept["venue"].endswith("=")
            if not stub and not worse:
                kept["venue"] = r["venue"]
    return kept


def test_merge_equals_fold(spark):
    rng, rows, want = random.Random(5), [], {}
    for key in range(400):
        records = [{"v": rng.choice([None, "", "a", "b", *resolve.PLACEHOLDERS[:2]]), "d": rng.choice([None, "", "x", "yy", "zz"]), "venue": rng.choice([None, "", "A", "B", "poor=", "bad=", resolve.PLACEHOLDERS[0]])} for _ in range(rng.randint(1, 6))]
        rows += [(key, i, r["v"], r["d"], r["venue"]) for i, r in enumerate(records)]
        want[key] = fold(records)
    df = spark.createDataFrame(rows, "key int, ord long, v string, d string, venue string").repartition(5)
    poor = F.col("venue").endswith("=")
    got = resolve.merge_records(df, "key", {"key": F.max("key"), "v": resolve.newest_known("v"), "d": resolve.longest("d"), "venue": resolve.best_venue("venue", poor)})
    assert {r["key"]: (r["v"], r["d"], r["venue"]) for r in got.collect()} == {k: (w["v"], w["d"], w["venue"]) for k, w in want.items()}


def test_page_metadata(spark):
    html = """<head><meta property="og:title" content="Night &amp; Day"><title>t</title><meta name="description" content="A long description of the show, with details.">
    <meta property="og:image" content="https://x.org/a.jpg"></head>
    <img src="https://x.org/logo.png"><img src="/b.jpg"><a href="https://maps.example.org/?q=25.04%2C121.51">map</a>"""
    df = spark.createDataFrame([(1, "https://x.org/p/", html)], "page_id int, url string, html string")
    r = df.select(extract.page_title("html"), extract.page_images("html"), extract.page_description("html"), extract.page_point("html")["lat"]).first()
    assert tuple(r) == ("Night & Day", ["https://x.org/a.jpg"], "A long description of the show, with details.", 25.04)
    assert values(spark, extract.section("a", "節目介紹", "注意事項", least=3), ["前 節目介紹 內容文字 注意事項 後", "沒有"]) == ["內容文字", ""]


def test_feed_to_catalogue(spark, tmp_path):
    (tmp_path / "f.json").write_text('{"data":[{"UID":"u1","titile":" 攝影展 ","startDate":"2026/1/2","showInfo":[{"location":"台北市路1號","latitude":"121.5","longitude":"25.0"}],"onSales":"N","hitRate":"12"},{"title":"春季講座"},{"title":""}]}', encoding="utf-8")
    rows = feeds.normalise(feeds.read_json(spark, str(tmp_path / "f.json"))).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["key"], r["title"], str(r["start"]), r["lat"], r["lon"], r["region"], r["price"], r["hits"], r["categories"]) == ("u1", "攝影展", "2026-01-02", 25.0, 121.5, "台北市", "免費", 12, ["攝影"])
    with pytest.raises(ValueError):
        feeds.first_available(lambda: spark.read.json("/nowhere"))


def test_toggled_favourites(spark):
    fav = spark.createDataFrame([(1,), (2,)], "key long")
    assert sorted(r[0] for r in recommend.toggled(fav, 2).collect()) == [1] and sorted(r[0] for r in recommend.toggled(fav, 3).collect()) == [1, 2, 3]


def test_stream_keeps_a_snapshot(spark, tmp_path):
    src, base = f"{tmp_path}/in", f"{tmp_path}/snap"
    df = lambda rows: spark.createDataFrame(rows, "id long, v string, at long")
    for k, rows in enumerate([[(1, "a", 1), (2, "b", 1)], [(1, "c", 2), (3, "d", 2)]]):
        df(rows).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("id long, v string, at long").parquet(src)
        streaming.keep_snapshot(stream, base, f"{tmp_path}/cp", "id", ["v"], "at").awaitTermination()
    got = {r["id"]: (r["v"], r["first_seen"], r["last_seen"]) for r in spark.read.parquet(streaming.version(base, 1)).collect()}
    assert got == {1: ("c", 0, 1), 2: ("b", 0, 0), 3: ("d", 1, 1)}


def test_sorting_by_title_follows_strokes(spark):
    df = spark.createDataFrame([(1, "三"), (2, "一"), (3, "二")], "key int, title string")
    assert [r["title"] for r in df.orderBy(*listing.order_of("title", F.lit(datetime.date(2026, 1, 1)))).collect()] == ["一", "二", "三"]


def test_rules_of_titles(spark):
    rows = [("國際攝影展", "美術館", False, "攝影"), ("社區志工成果展", "", True, "其他"), ("春季講座", "", True, "其他"), ("全國比賽", "", True, "競賽"), ("比賽得獎作品展", "", False, "競賽"), ("當代藝術 photo 展", "台南市文化局", False, "美術,攝影"), ("某某區公所音樂會", "", True, "音樂"), ("AI 機器人科技展", "", False, "科技"), (None, None, False, "其他"), ("", "", False, "其他")]
    df = spark.createDataFrame(rows, "title string, org string, out boolean, labels string")
    got = df.select("out", "labels", rules.excluded("title", "org").alias("o"), F.array_join(rules.classify(F.lit(""), "title", F.lit("")), ",").alias("l")).collect()
    assert all((r.out, r.labels) == (r.o, r.l) for r in got)
